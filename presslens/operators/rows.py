"""Row filters that must stay where they are written.

Catalyst pushes a Filter below a Project by substituting the projected
expression into the predicate. When the projection is an expensive parse
(from_json, from_xml, a long regex chain), the parse then runs twice: once
for the predicate and once for the output. ``keep_rows`` expresses the same
row filter as a generator (``inline`` of a one- or zero-element array), which
is evaluated once on the parsed row and is not pushed below the parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.inline(F.when(cond, F.array(row))))
