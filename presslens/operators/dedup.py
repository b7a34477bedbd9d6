"""Key-based deduplication: first-wins (cleaner) and newest-wins (FINAL read).

Both are one aggregation on the key with ``min_by``/``max_by`` over a struct of
the row. Its buffer holds strings, so Spark plans a sort aggregation: map tasks
sort their rows by key and collapse them before the shuffle. A key holding a
third of all rows thus costs one row per map task on the network, not a third
of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: str | list[str], order: list[str | Column], fn) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ordering = F.struct(*order_cols) if len(order_cols) > 1 else order_cols[0]
    picked = df.groupBy(*keys).agg(fn(F.struct(*payload), ordering).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload]).select(*df.columns)


def first_by_key(df: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    """Keep, per key, the row that comes first in ``order`` (explicit input order)."""
    return _pick(df, key, order, F.min_by)


def latest_by_key(df: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    """Keep, per key, the newest row by ``order`` (e.g. extracted_at, seq): the
    replacing-table FINAL read."""
    return _pick(df, key, order, F.max_by)
