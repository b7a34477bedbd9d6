"""Top-k per group and limit-by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k within each group by ``order`` (ties broken by the
    caller's order list). ``row_number() <= k`` lets Catalyst plan a partial
    WindowGroupLimit before the shuffle, so at most k rows per group and
    input partition cross the network even for a hot group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
    if rank_col:
        return ranked.withColumnRenamed("_rk", rank_col)
    return ranked.drop("_rk")
