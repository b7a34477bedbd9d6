"""SimHash near-dedup with bit-sliced comparison.

Fingerprints that differ in at most ``radius`` of 64 bits agree entirely in at
least ``bands - radius`` of ``bands`` bit ranges, so every link is found among
fingerprints that share one choice of that many ranges (a bucket). Within a
bucket the fingerprints are stored as 64 vertical bit planes: one machine word
holds one bit of 64 fingerprints. Differences are added plane by plane into
carry-save bitwise counters, 64 distances at a time, and a word is abandoned as
soon as all its distances exceed the radius.

Equal fingerprints are one node from the start. A bucket hands on a spanning
forest of its links, never its pairs; a bucket too large for a task is dealt out
as tiles of two chunks each. Components are found by star contraction on
DataFrames, with every round written to the shared folder.

Defined results: a text without words (null too) has fingerprint zero, linked
like any other; shorter texts than a shingle are one shingle; a null id ranks
above every id; of rows that agree in id and text one stays; texts of any length
are fingerprinted whole; an empty table gives an empty result; ``survivors``
carries other columns along, names that clash with helpers included.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.shared import materialise, unused, width

SHINGLE, RADIUS, BANDS, HASH_SEED = 3, 3, 5, 42
#: a larger bucket is dealt out in chunks of this many fingerprints
TILE = 4096
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        shingles = [line]
    else:
        ends = [at + i for i, at in enumerate(accumulate(map(len, words)))]
        shingles = [line[a:b] for a, b in zip([0, *[e + 1 for e in ends]], ends[shingle - 1 :])]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), dtype="<u8", count=len(shingles))
    hits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * hits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fingerprint (64 bits as a signed long) of every row."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("binary").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in rows.column(2)), dtype=np.uint64, count=len(rows))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fingerprint"]
            )

    return docs.mapInArrow(of, f"doc_id {id_type}, text_hash bigint, fingerprint bigint")


def planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of the values, 64 values to a word: shape (64, words)."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def within(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, wanted: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare words ``a_at`` of planes ``a`` with words ``b_at`` of planes ``b``.

    ``wanted`` masks the lanes that matter. Returns the words that survive (as
    positions in ``a_at``) and their lanes at distance <= ``radius``.
    """
    size = radius.bit_length()
    alive = np.arange(len(a_at))
    counters = [np.zeros(len(a_at), dtype=np.uint64) for _ in range(size)]
    for plane in range(0, 64, 2):
        one = a[plane, a_at] ^ b[plane, b_at]
        two = a[plane + 1, a_at] ^ b[plane + 1, b_at]
        # carry-save: both differences and the lowest counter bit in one step, the carry ripples up
        either = one ^ two
        carry = (one & two) | (counters[0] & either)
        counters[0] ^= either
        for k in range(1, size):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        wanted = wanted & ~carry  # counted past 2**size - 1 >= radius
        if plane % 8 == 6:
            keep = np.flatnonzero(wanted)
            if len(keep) < 0.7 * len(wanted):
                alive, a_at, b_at, wanted = alive[keep], a_at[keep], b_at[keep], wanted[keep]
                counters = [c[keep] for c in counters]
                if not len(keep):
                    break
    # lanes that ended between radius and 2**size - 1
    for distance in range(radius + 1, 1 << size):
        exact = ALL
        for k, c in enumerate(counters):
            exact = exact & (c if distance >> k & 1 else ~c)
        wanted = wanted & ~exact
    keep = np.flatnonzero(wanted)
    return alive[keep], wanted[keep]


class Forest:
    """Union of positions by vectorised hooking; the smallest position of a tree is its root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(self.root, b, a)
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _lanes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, lane) of every set bit."""
    bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.nonzero(bits)


def bucket_links(buckets: np.ndarray, values: np.ndarray, radius: int) -> np.ndarray:
    """Root position of each value: links join values of one bucket within the radius. Rows are sorted by bucket.

    Short buckets are compared all at once, each value with the one ``d`` places on; long ones by blocks of queries.
    """
    n, forest = len(values), Forest(len(values))
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    sizes = np.diff(np.r_[starts, n])
    short = np.repeat(sizes <= 64, sizes)
    left = np.repeat(sizes, sizes) - (np.arange(n) - np.repeat(starts, sizes))  # places to the bucket's end, itself included
    at = np.flatnonzero(short & (left > 1))
    for d in range(1, 64):
        at = at[left[at] > d]
        if not len(at):
            break
        for k in range(0, len(at), 1 << 16):
            here = at[k : k + (1 << 16)]
            a, b = planes(values[here]), planes(values[here + d])
            words = np.arange(a.shape[1])
            lanes = np.packbits(np.arange(len(words) * 64) < len(here), bitorder="little").view("<u8")
            word, mask = within(a, words, b, words, lanes, radius)
            row, lane = _lanes(mask)
            found = here[word[row] * 64 + lane]
            forest.link(found, found + d)
    for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        own = values[start : start + size]
        stored = planes(own)
        words = stored.shape[1]
        for q in range(0, size, 256):
            queries = own[q : q + 256]
            spread = (np.uint64(0) - ((queries[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)))
            first = q // 64  # words before hold values that were queries themselves
            a_at, b_at = np.divmod(np.arange(len(queries) * (words - first)), words - first)
            lanes = np.full(len(a_at), ALL)
            if size % 64:
                lanes[b_at == words - first - 1] = np.uint64((1 << size % 64) - 1)
            hit, mask = within(spread, a_at, stored, b_at + first, lanes, radius)
            row, lane = _lanes(mask)
            forest.link(start + q + a_at[hit[row]], start + (b_at[hit[row]] + first) * 64 + lane)
    return forest.root


def band_masks(bands: int = BANDS, radius: int = RADIUS) -> list[int]:
    """Every choice of ``bands - radius`` of ``bands`` ranges of the 64 bits, as signed masks."""
    edges = [64 * i // bands for i in range(bands + 1)]
    ranges = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(x) for x in combinations(ranges, bands - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, radius: int = RADIUS, bands: int = BANDS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all of ``distinct`` (column fingerprint, no repeats) within the radius: a forest per bucket."""
    spark = distinct.sparkSession
    value = F.col("fingerprint")
    tables = F.array(*[F.xxhash64(F.lit(i), value.bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(band_masks(bands, radius))])
    dealt = distinct.select(F.explode(tables).alias("bucket"), "fingerprint")
    large = materialise(
        dealt.groupBy("bucket").count().filter(F.col("count") > tile).select("bucket", F.ceil(F.col("count") / tile).cast("long").alias("chunks")),
        "large_buckets",
    )
    # a large bucket: each value goes to the tiles of its chunk with every chunk, so any two meet
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("chunks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    tiled = dealt.join(large, "bucket").select("bucket", "fingerprint", mine.alias("mine"), other).select(
        F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("bucket"), "fingerprint"
    )
    whole = dealt.join(large, "bucket", "left_anti").select("bucket", "fingerprint")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_v = np.empty(0, np.int64), np.empty(0, np.int64)

        def settle(b: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            root = bucket_links(b, v.view(np.uint64), radius)
            joined = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(v[joined]), pa.array(v[root[joined]])], ["a", "b"])

        for rows in batches:
            b, v = (np.concatenate(x) for x in ((held_b, rows.column(0).to_numpy()), (held_v, rows.column(1).to_numpy())))
            if len(b) < 1 << 16:
                held_b, held_v = b, v
                continue
            cut = int(np.searchsorted(b, b[-1]))  # the last bucket may go on in the next batch
            if cut:
                yield settle(b[:cut], v[:cut])
            held_b, held_v = b[cut:], v[cut:]
        if len(held_b):
            yield settle(held_b, held_v)

    parts = width(spark)
    sorted_ = whole.unionByName(tiled).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return sorted_.mapInArrow(compare, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over ``edges`` (a, b), for all nodes that have an edge.

    Alternates large-star and small-star contraction until the edges are stars.
    Each step needs one row per node and edge. The least neighbours are written
    before they are joined: a join whose sides are both plain shuffles can be
    split where a hub is hot, one on top of an aggregation cannot.
    """

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        least = materialise(e.groupBy("a").agg(F.min("b").alias("m")), "least")
        near = e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return near.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialise(current, "edges")
    before, after = None, state(current)
    while before != after:
        # large-star leaves every edge pointing down, as small-star wants it
        current = materialise(small_star(materialise(large_star(current), "down")), "edges")
        before, after = after, state(current)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_copies(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, bands: int = BANDS, tile: int = TILE
) -> DataFrame:
    """doc_id, text_hash, bits (fingerprint), component_id (smallest id reachable over links, itself included), root.

    ``root`` is one fingerprint of the component; ids may be null or repeat, roots tell components apart.
    """
    docs = materialise(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    distinct = materialise(docs.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "distinct")
    found = components(links(distinct.select("fingerprint"), radius, bands, tile))
    labelled = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least_id"
    )
    labelled = materialise(labelled, "labelled")
    least = materialise(labelled.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    ids = labelled.join(least, "root").select("fingerprint", "component_id", "root")
    return docs.join(ids, "fingerprint").select("doc_id", "text_hash", F.col("fingerprint").alias("bits"), "component_id", "root")


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The row with the smallest id of each component, with all its columns."""
    i, h, n = (unused(df, x) for x in ("_id", "_hash", "_nth"))
    kept = near_copies(df, id_col, text_col, **settings).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # rows may share the winning id: the smallest text hash decides
    kept = kept.groupBy("root", "component_id").agg(F.min("text_hash").alias("text_hash"))

    def key(c):
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))

    rows = df.withColumn(i, key(id_col)).withColumn(h, F.xxhash64(F.col(text_col)))
    winners = kept.select(key("component_id").alias(i), F.col("text_hash").alias(h))
    first = Window.partitionBy(i, h).orderBy(F.xxhash64(*df.columns))
    return rows.join(winners, [i, h]).withColumn(n, F.row_number().over(first)).filter(F.col(n) == 1).select(*df.columns)
