"""Suffix-array dedup: remove every byte that a repeated string of LENGTH bytes covers.

A suffix array needs the strings it compares side by side, so windows of LENGTH
bytes are first dealt out such that equal windows meet. A window's anchor is the
GRAM bytes in it with the smallest hash (the leftmost of equals): equal windows
have equal anchors. Consecutive windows with one anchor make a segment, and

1. the anchors of all segments are counted; only those that occur again can
   hold a repeat, and only their documents' texts are shuffled from then on;
2. segments that agree entirely are one class with a count, so a passage that
   many documents share is sorted once;
3. anchors with more bytes than one task should hold are dealt out again by the
   bytes that narrower groups of their windows have in common, down to single
   windows, whose groups are one class each;
4. each shard of classes gets its suffix array by induced sorting and its
   permuted common prefixes (``suffix_arrays``); a window repeats if its class
   has several members or it shares LENGTH bytes with a neighbour in the array;
5. each document's covered stretches are merged and cut out.

Positions are bytes of UTF-8. Defined results: a null text counts as empty and
stays so; texts shorter than LENGTH never change; repeated rows (id and text
equal) repeat each other; texts beyond BLOCK bytes are worked on in overlapping
blocks, whole; an empty table gives an empty result; other columns are carried
along by ``cleaned``, names that clash with helpers included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.shared import materialise, unused
from presslens.llm.suffix_arrays import common_prefixes, suffix_array

LENGTH = 400
#: bytes of a shard, and of one anchor's classes before it is dealt out again
SHARD, CROWDED = 2_000_000, 2_000_000
#: windows that a crowded anchor's groups hold, round by round
NARROWER = (32, 1)
#: bytes worked on at once; anchors compare hashes without the bits that hold a place in that many bytes
BLOCK, PLACE_BITS = 4_000_000, 23
#: a byte that UTF-8 never uses
SEPARATOR = b"\xff"

SEGMENT = "k1 bigint, k2 bigint, start bigint, stop bigint, anchor bigint, key bigint, content binary"


def gram_of(length: int) -> int:
    """Bytes of an anchor: the largest power of two up to a quarter of the window, at least 8."""
    return max(8, 1 << (length // 4).bit_length() - 1)


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from every position on."""
    h = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    reach = 8
    while reach < gram:
        h = h[:-reach] * np.uint64(0xD6E8FEB86659FD93) + (h[reach:] ^ (h[reach:] >> np.uint64(29)))
        reach *= 2
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    return h


def sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of x[i : i + span] for every i."""
    n = len(x)
    padded = np.full(-(-n // span) * span, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - span + 1], ahead[span - 1 : n])


def segments(data: bytes, texts: list[tuple[int, int]], length: int) -> tuple[np.ndarray, ...]:
    """(text, start, stop, anchor, key) of every segment; texts are (begin, end) in ``data``, windows start at start..stop."""
    gram = gram_of(length)
    hashes = gram_hashes(data, gram)
    marked = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (sliding_min(marked, length - gram + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    begins, ends = (np.array(x, dtype=np.int64) for x in zip(*texts))
    counts = np.maximum(ends - begins - length + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    window = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[text]
    if not len(window):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    own = anchor[window]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[new[1:], len(window)] - 1
    return text[new], window[new], window[last], own[new], hashes[own[new]].view(np.int64)


def _blocks(rows: list[tuple], length: int) -> Iterator[tuple[bytes, list[tuple], list[tuple[int, int]]]]:
    """(bytes, rows, places) of at most about BLOCK bytes; longer texts go on with LENGTH - 1 bytes of overlap."""
    data, held, places = bytearray(), [], []
    for k1, k2, text in rows:
        for begin in range(0, max(len(text) - length, 0) + 1, BLOCK):
            part = text[begin : begin + BLOCK + length - 1]
            if data and len(data) + len(part) > BLOCK + length:
                yield bytes(data) + bytes(length), held, places
                data, held, places = bytearray(), [], []
            held.append((k1, k2, begin))
            places.append((len(data), len(data) + len(part)))
            data += part
    if places:
        yield bytes(data) + bytes(length), held, places


def anchored(docs: DataFrame, length: int) -> DataFrame:
    """All segments of ``docs`` (k1, k2, text as bytes)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, held, places in _blocks(list(zip(*(c.to_pylist() for c in batch.columns))), length):
                text, start, stop, anchor, key = segments(data, places, length)
                moved = np.array([h[2] - p[0] for h, p in zip(held, places)], dtype=np.int64)[text]
                content = [xxhash.xxh3_128_digest(data[a : b + length]) for a, b in zip(start.tolist(), stop.tolist())]
                ids = [np.array([h[i] for h in held], dtype=np.int64)[text] for i in (0, 1)]
                numbers = [*ids, start + moved, stop + moved, anchor + moved, key]
                yield pa.RecordBatch.from_arrays([*map(pa.array, numbers), pa.array(content, pa.binary())], SEGMENT.replace(",", "").split()[::2])

    return docs.filter(F.octet_length("text") >= length).select("k1", "k2", "text").mapInArrow(find, SEGMENT)


def recurring(found: DataFrame) -> DataFrame:
    """Segments whose key occurs more than once.

    The keys are written first: a join whose sides are both plain shuffles can
    be split where a key is hot, one on top of an aggregation cannot.
    """
    again = materialise(found.groupBy("key").count().filter("count > 1").select("key"), "again")
    return found.join(again, "key", "left_semi").select(*found.columns)


def narrowed(members: DataFrame, docs: DataFrame, length: int, windows: int) -> DataFrame:
    """Segments cut at every ``windows`` windows from their anchor, keyed by the bytes that any such windows share."""
    wanted = members.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop", "anchor", "key")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k1, k2, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                for f in found:
                    group = (f["start"] - f["anchor"]) // windows
                    while (first := f["anchor"] + group * windows) <= f["stop"]:
                        shared = text[first + windows - 1 : first + length]
                        key = xxhash.xxh3_64_intdigest(b"%d %d %s" % (f["key"], group, shared)) - (1 << 63)
                        start, stop = max(first, f["start"]), min(first + windows - 1, f["stop"])
                        out.append((k1, k2, start, stop, f["anchor"], key, xxhash.xxh3_128_digest(text[start : stop + length])))
                        group += 1
            kinds = [pa.int64()] * 6 + [pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays(columns, SEGMENT.replace(",", "").split()[::2])

    return docs.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "found").mapInArrow(cut, SEGMENT)


def _classes(members: DataFrame) -> DataFrame:
    return members.groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("k1", "k2", "start", "stop")).alias("first")
    )


def repeats_in(length: int):
    """One shard: the stretches of repeated windows in every class, as starts from..to relative to the class's text."""

    def find(table: pa.Table) -> pa.Table:
        seen, parts = set(), []
        for row in zip(*(table.column(c).to_pylist() for c in ("key", "content", "members", "segment"))):
            if row[:2] not in seen:  # a row of repeated ids is fetched once per repeat
                seen.add(row[:2])
                parts.append(row)
        text = SEPARATOR.join(p[3] for p in parts) + SEPARATOR
        sizes = np.array([len(p[3]) for p in parts], dtype=np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        owner = np.repeat(np.arange(len(parts)), sizes + 1)
        place = np.arange(len(text)) - begins[owner]
        window = place + length <= sizes[owner]
        shared, before = common_prefixes(text, suffix_array(text, length))
        at = np.flatnonzero((shared >= length) & window)
        at = at[window[before[at]]]
        repeated = window & (np.array([p[2] for p in parts])[owner] > 1)
        repeated[at] = repeated[before[at]] = True
        edge = np.diff(np.r_[False, repeated, False].astype(np.int8))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        rows = [parts[o] for o in owner[first]]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array(place[first]), pa.array(place[last])]
        return pa.table(columns, names=["key", "content", "from", "to"])

    return find


def spans(docs: DataFrame, length: int = LENGTH, shard: int = SHARD, crowded: int = CROWDED) -> tuple[DataFrame, DataFrame]:
    """(documents that may change, their covered stretches) for ``docs`` (k1, k2, text as bytes).

    The second has one row per document that changes: k1, k2, covered (list of begin and end, overlaps not merged).
    """
    members = materialise(recurring(materialise(anchored(docs, length), "segments")), "recurring")
    touched = docs.join(members.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    touched = materialise(touched.groupBy("k1", "k2").agg(F.first("text").alias("text")), "touched")
    for windows in (w for w in NARROWER if w <= length):  # such windows share some bytes
        weight = F.sum(F.col("first.stop") - F.col("first.start") + length)
        over = _classes(members).groupBy("key").agg(weight.alias("bytes"), F.count(F.lit(1)).alias("kinds"))
        over = materialise(over.filter((F.col("bytes") > crowded) & (F.col("kinds") > 1)).select("key"), "crowded")
        if over.isEmpty():
            break
        dense = members.join(over, "key", "left_semi").select(*members.columns)
        rest = members.join(over, "key", "left_anti").select(*members.columns)
        members = materialise(rest.unionByName(recurring(materialise(narrowed(dense, touched, length, windows), "narrowed"))), "recurring")
    classes = materialise(_classes(members), "classes")
    total = classes.agg(F.sum(F.col("first.stop") - F.col("first.start") + length)).first()[0] or 0
    wanted = classes.groupBy(F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2")).agg(
        F.collect_list(F.struct("key", "content", "members", F.col("first.start").alias("start"), F.col("first.stop").alias("stop"))).alias("found")
    )
    fetched = touched.join(wanted, ["k1", "k2"]).select("text", F.explode("found").alias("f"))
    size = (F.col("f.stop") - F.col("f.start") + length).cast("int")
    dealt = fetched.select(
        "f.key", "f.content", "f.members", F.substring("text", (F.col("f.start") + 1).cast("int"), size).alias("segment")
    ).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(total // shard + 1)))
    kinds = "key long, content binary, `from` long, `to` long"
    repeated = materialise(dealt.groupBy("shard").applyInArrow(repeats_in(length), kinds), "repeats")
    begin, end = F.col("start") + F.col("from"), F.col("start") + F.col("to") + length
    covered = members.join(repeated, ["key", "content"]).groupBy("k1", "k2").agg(F.collect_list(F.struct(begin.alias("begin"), end.alias("end"))).alias("covered"))
    return touched, covered


def _cut(text: bytes, covered: list[dict]) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, what is left)."""
    kept, at, removed, runs = [], 0, 0, 0
    end = -1
    for begin, stop in sorted((c["begin"], c["end"]) for c in covered):
        if begin > end:
            runs += 1
            kept.append(text[at:begin])
            end = begin
        removed += max(0, stop - end)
        at = end = max(end, stop)
    return removed, runs, b"".join([*kept, text[at:]])


def _keyed(df: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """(k1, k2, text as bytes): rows of one id and one text share their keys."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))), F.xxhash64(text), text.cast("binary")


def _changed(docs: DataFrame, length: int, shard: int, crowded: int) -> DataFrame:
    """k1, k2, n_removed, n_spans, kept (bytes), kept_sha256 of the documents that change."""
    touched, covered = spans(docs, length, shard, crowded)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, texts, lists = batch.columns
            cuts = [_cut(t, c) for t, c in zip(texts.to_pylist(), lists.to_pylist())]
            removed, runs, kept = zip(*cuts) if cuts else ((), (), ())
            columns = [k1, k2, pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())]
            columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n_removed", "n_spans", "kept", "kept_sha256"])

    kinds = "k1 long, k2 long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return touched.join(covered, ["k1", "k2"]).select("k1", "k2", "text", "covered").mapInArrow(cut, kinds)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD, crowded: int = CROWDED) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    k1, k2, text = _keyed(df, id_col, text_col)
    docs = df.select(k1.alias("k1"), k2.alias("k2"), text.alias("text"))
    rows = df.select(
        F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole")
    )
    changed = _changed(docs, length, shard, crowded).drop("kept")
    return rows.join(changed, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def cleaned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD, crowded: int = CROWDED) -> DataFrame:
    """``df`` with the covered bytes cut out of its texts (cuts inside a character leave U+FFFD)."""
    a, b, kept = (unused(df, x) for x in ("_k1", "_k2", "_kept"))
    k1, k2, text = _keyed(df, id_col, text_col)
    docs = df.select(k1.alias("k1"), k2.alias("k2"), text.alias("text"))
    changed = _changed(docs, length, shard, crowded).select(F.col("k1").alias(a), F.col("k2").alias(b), F.decode("kept", "UTF-8").alias(kept))
    whole = df.withColumn(a, k1).withColumn(b, k2).join(changed, [a, b], "left")
    return whole.withColumn(text_col, F.coalesce(F.col(kept), F.col(text_col))).select(*df.columns)
