"""Helpers shared by the operators: intermediate tables and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.session import scratch_path


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage on storage that every executor reads, so a lost executor
    costs only its own tasks and repeated use does not recompute anything.
    ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more; what was made of them has been written."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    sums: dict[str, str] | None = None,
    rank: str = "rank",
    name: str = "running",
) -> DataFrame:
    """Position and prefix sums of every row within its group, for groups of any size.

    ``rank`` is the number of rows before this one (from 0); ``sums`` maps a
    new column to the column whose values before this row it adds up. Rows are
    dealt by range of (group, order), so one hot group spreads over many tasks;
    only one row per (range, group) is ever put in sequence. Nulls sort first
    and form a group of their own. ``order`` should end in a key that settles
    ties wherever the outcome depends on them.
    """
    sums = sums or {}
    keys = [F.col(c) for c in group]
    placed = df.repartitionByRange(width(df.sparkSession), *keys, *order).withColumn("_range", F.spark_partition_id())
    placed = materialise(placed, name)
    per_range = placed.groupBy("_range", *group).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(f"_sum_{k}") for k, v in sums.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    # a group goes on into the next range at most once per range, so few rows have an offset
    offsets = per_range.select(
        F.col("_range").alias("_o_range"),
        *[F.col(c).alias(f"_o_{c}") for c in group],
        before("_rows").alias("_rows_before"),
        *[before(f"_sum_{k}").alias(f"_before_{k}") for k in sums],
    ).filter("_rows_before > 0")
    on = F.col("_range") == F.col("_o_range")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_o_{c}"))

    def offset(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    local = Window.partitionBy("_range", *keys).orderBy(*order)
    so_far = local.rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(F.broadcast(offsets), on, "left")
    out = out.withColumn(rank, offset("_rows_before") + F.row_number().over(local) - 1)
    for k, v in sums.items():
        out = out.withColumn(k, offset(f"_before_{k}") + F.coalesce(F.sum(v).over(so_far), F.lit(0)))
    return out.select(*df.columns, rank, *sums)


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
