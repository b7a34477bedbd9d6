"""Ground-truth framings (S27) and schema dump.

Ground truth is a multi-line JSON file of events, each with a list of
framings by country/outlet; it is flattened to one row per framing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAMING = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("outlet", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("framing_axis", T.ArrayType(T.StringType())),
    T.StructField("sentiment", T.DoubleType()),
    T.StructField("notes", T.StringType()),
])
GROUND_TRUTH = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_description", T.StringType()),
    T.StructField("canonical_date", T.DateType()),
    T.StructField("framings", T.ArrayType(FRAMING)),
])


def load_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """One row per (event, framing) with the event columns repeated."""
    events = spark.read.schema(GROUND_TRUTH).option("multiLine", True).json(path)
    return events.select("event_id", "event_description", "canonical_date",
                         F.posexplode("framings").alias("framing_pos", "f")).select(
        "event_id", "event_description", "canonical_date", "framing_pos", "f.*")


def schema_dump(tables: dict[str, DataFrame]) -> list[tuple[str, int, str, str, bool]]:
    """(table, position, column, type, nullable) for every column: metadata
    only, no data is read."""
    out = []
    for name, df in sorted(tables.items()):
        for i, field in enumerate(df.schema.fields):
            out.append((name, i, field.name, field.dataType.simpleString(), field.nullable))
    return out
