"""Running (prefix) counts over a huge ordered group without one task per group.

A window ``partitionBy(g).orderBy(seq)`` puts every row of a group into one
task, in order. Here the group is cut into blocks of consecutive ``seq``
values: per-block totals (one row per block) get an ordered prefix sum, and
each row adds its block offset to a running count inside its block. No task
holds more than one block of one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, group: str, seq: str, values: dict[str, Column],
                 block_size: int = 100_000) -> DataFrame:
    """Adds, for every name in ``values``, the running sum of that column
    expression over the rows of ``group`` with seq <= this row's seq
    (rows ordered by ``seq``, ties impossible: seq is unique per group)."""
    d = df.withColumn("_blk", F.floor(F.col(seq) / F.lit(block_size)))
    for name, expr in values.items():
        d = d.withColumn(f"_v_{name}", expr)
    per_block = d.groupBy(group, "_blk").agg(*[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in values])
    w_blocks = Window.partitionBy(group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(group, "_blk", *[F.coalesce(F.sum(f"_b_{n}").over(w_blocks), F.lit(0))
                                                .alias(f"_o_{n}") for n in values])
    w_rows = Window.partitionBy(group, "_blk").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(offsets, [group, "_blk"])
    for name in values:
        d = d.withColumn(name, F.col(f"_o_{name}") + F.sum(f"_v_{name}").over(w_rows))
    return d.drop("_blk", *[f"_v_{n}" for n in values], *[f"_o_{n}" for n in values])
