"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries find the digests that make up a large share of the
rows. Their exact sizes and winners are few by construction and are broadcast,
so rows of the largest groups are settled where they lie. Every other digest
goes through an ordinary shuffle, in which no group is large.

Defined results: a null text counts as empty; a null id ranks below every id;
of rows that agree in id and text exactly one stays; an empty table gives an
empty result; texts of any length are hashed whole; other columns are carried
along by ``survivors`` unchanged, names that clash with helpers included.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.shared import materialise, unused

#: A digest with more than 1/HEAVY of all rows is settled by broadcast.
HEAVY = 512


def digest(column: str):
    return F.unhex(F.sha2(F.coalesce(F.col(column), F.lit("")), 256))


def misra_gries(slots: int):
    """Per-task summary: at most ``slots`` counters, each short of the truth by at most rows/(slots + 1)."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits: dict[bytes, int] = {}
        for batch in batches:
            for pair in pc.value_counts(batch.column(0)).to_pylist():
                hits[pair["values"]] = hits.get(pair["values"], 0) + pair["counts"]
            if len(hits) > slots:
                cut = sorted(hits.values(), reverse=True)[slots]
                hits = {d: n - cut for d, n in hits.items() if n > cut}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(hits), pa.binary()), pa.array(list(hits.values()), pa.int64())], ["digest", "hits"]
        )

    return summarise


def frequent_digests(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Candidates (``digest``): every digest with more than 1/``heavy`` of the rows, at most 2 x ``heavy`` in all.

    Summaries keep 2 x ``heavy`` counters, so the summed counters miss at most
    half the threshold; as they add up to no more than the number of rows, at
    most 2 x ``heavy`` digests can reach that half.
    """
    total = rows.count()
    found = rows.select("digest").mapInArrow(misra_gries(2 * heavy), "digest binary, hits bigint")
    return found.groupBy("digest").agg(F.sum("hits").alias("hits")).filter(F.col("hits") * 2 * heavy >= total).select("digest")


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest id stays; ``rid`` settles repeated ids.
    """
    rows = materialise(
        df.select(F.col(id_col).alias("doc_id"), digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("rid")),
        "digests",
    )
    top = F.struct("doc_id", "rid")
    verified = rows.join(F.broadcast(frequent_digests(rows, heavy)), "digest")
    winners = materialise(
        verified.groupBy("digest").agg(F.max(top).alias("top"), F.count(F.lit(1)).alias("group_size")), "winners"
    )
    settled = rows.join(F.broadcast(winners), "digest")
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # the groups are written before the join: a join of plain shuffles can be split where a digest is common
    groups = materialise(light.groupBy("digest").agg(F.max(top).alias("top"), F.count(F.lit(1)).alias("group_size")), "groups")
    rest = light.join(groups, "digest")
    return settled.unionByName(rest).select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """The rows that stay, with all their columns: one row for each text.

    Copies of heavy texts are dropped before any shuffle; only the winner's
    own row (and exact repeats of it, reduced map-side) goes on.
    """
    d, h, n = (unused(df, x) for x in ("_digest", "_hash", "_nth"))
    rows = df.withColumn(d, digest(text_col))
    slim = materialise(rows.select(F.col(d).alias("digest"), F.col(id_col).alias("id")), "digests")
    winners = materialise(
        slim.join(F.broadcast(frequent_digests(slim, heavy)), "digest").groupBy("digest").agg(F.max("id").alias("keep")),
        "winners",
    )
    w_digest, w_id = unused(rows, "_w_digest"), unused(rows, "_w_id")
    few = winners.select(F.col("digest").alias(w_digest), F.col("keep").alias(w_id))
    match = F.col(d) == F.col(w_digest)
    won = rows.join(F.broadcast(few), match & F.col(id_col).eqNullSafe(F.col(w_id)), "left_semi").dropDuplicates()
    rest = rows.join(F.broadcast(few), match, "left_anti")
    first = Window.partitionBy(d).orderBy(F.col(id_col).desc_nulls_last(), F.col(h))
    kept = won.unionByName(rest).withColumn(h, F.xxhash64(*df.columns)).withColumn(n, F.row_number().over(first))
    return kept.filter(F.col(n) == 1).select(*df.columns)


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
