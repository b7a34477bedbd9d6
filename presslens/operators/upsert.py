"""Write dispositions on plain parquet.

* ``merge_latest``: a keyed table and a batch become the next version of the
  table, one row per key; the batch wins, then the order columns.
* ``append``: plain append (duplicates kept); ``latest_by_key`` on read gives
  the newest row per key.
* snapshots: ``partitionBy('snapshot')`` and latest-snapshot selection with a
  literal partition filter (static partition pruning).
* ``append_unseen``: append of rows whose key is new; ``incremental_load``:
  append past a high-water mark.

Callers choose where a version is written; a table format with MERGE INTO would
take the place of ``merge_latest`` plus a write.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.dedup import latest_by_key


def merge_latest(target: DataFrame, batch: DataFrame, key: str = "url",
                 order: tuple[str, ...] = ("extracted_at", "seq")) -> DataFrame:
    t = target.withColumn("_side", F.lit(0))
    b = batch.withColumn("_side", F.lit(1))
    both = t.unionByName(b, allowMissingColumns=True)
    return latest_by_key(both, key, ["_side", *order]).drop("_side")


def append(batch: DataFrame, path: str) -> None:
    batch.write.mode("append").parquet(path)


def write_snapshots(df: DataFrame, path: str, snapshot_col: str = "snapshot") -> None:
    """One folder per snapshot; rows come clustered by snapshot, so a task writes few files
    (AQE splits a snapshot that is too large for one task)."""
    df.hint("rebalance", snapshot_col).write.mode("overwrite").partitionBy(snapshot_col).parquet(path)


def latest_snapshot_name(df: DataFrame, prefix: str, snapshot_col: str = "snapshot") -> str:
    """Greatest snapshot name with ``prefix`` that is not a staging snapshot
    (LIKE '%_staging', so '_' matches any character); error when none. Only
    the one scalar name reaches the driver."""
    cand = df.filter(F.col(snapshot_col).startswith(prefix) & ~F.col(snapshot_col).like("%_staging"))
    name = cand.agg(F.max(snapshot_col).alias("m")).first()["m"]
    if name is None:
        raise RuntimeError(f"no dataset matching {prefix}%")
    return name


def read_latest_snapshot(spark: SparkSession, path: str, prefix: str, snapshot_col: str = "snapshot") -> DataFrame:
    df = spark.read.parquet(path)
    name = latest_snapshot_name(df.select(snapshot_col), prefix, snapshot_col)
    # literal predicate on the partition column: pruned at file listing
    return df.filter(F.col(snapshot_col) == F.lit(name))


def _loaded(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_unseen(spark: SparkSession, path: str, rows: DataFrame, key: str = "url") -> DataFrame:
    """Append the rows (one per key) whose key the table at ``path`` does not have yet and return the table.

    A run repeated after a failure adds nothing twice. Columns that later runs
    bring along are NULL in earlier rows.
    """
    known = _loaded(spark, path)
    fresh = rows if known is None else rows.join(known.select(key), key, "left_anti").select(*rows.columns)
    fresh.write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def incremental_load(spark: SparkSession, path: str, source: DataFrame, cursor: str = "extracted_at", key: str | None = None):
    """Append the rows of ``source`` newer than the loaded high-water mark
    (one scalar read back to the driver); returns the mark used. With ``key``,
    rows at or below the mark whose key is not loaded yet (late rows) come too."""
    mark = None
    loaded = _loaded(spark, path)
    if loaded is not None:
        # the mark travels as text in the column's own type: a Python datetime
        # literal would be re-read in the session time zone
        dtype = dict(source.dtypes)[cursor]
        mark = loaded.agg(F.max(cursor).cast("string").alias("m")).first()["m"]
    new = source if mark is None else source.filter(F.col(cursor) > F.lit(mark).cast(dtype))
    if mark is not None and key:
        late = source.filter(F.col(cursor) <= F.lit(mark).cast(dtype)).join(loaded.select(key), key, "left_anti")
        new = new.unionByName(late.select(*source.columns))
    new.write.mode("append").parquet(path)
    return mark
