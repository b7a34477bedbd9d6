"""Substring dedup by recompression: repeated passages of LENGTH words stay where they come first.

1. Tasks name runs and pairs of words, round by round (``recompression``). Equal
   windows of LENGTH words have equal interior symbols, so each window is known
   by its longest one, its anchor. Consecutive windows with one anchor make a
   segment, one row.
2. Spark counts the anchors' names over all documents. Segments whose name occurs
   once hold no repeat and go.
3. Segments that agree entirely are one class with its earliest member. Where a
   name has several classes, their words are fetched and their windows compared
   word by word: that verifies what equal names only reveal, and finds each
   window's earliest place. Names with more classes than one task should hold
   are settled by an aggregation of single windows instead.
4. Each document's covered words are cut out.

Words are separated by bytes 09 to 0D and 20. A word goes if a window that covers
it has the same words as one that starts earlier: in a smaller doc_id, or before
it in the same document. Windows are judged on the input.

Defined results: a null text has no words; texts shorter than LENGTH words never
change; null ids come before all others; different texts under one id come in
order of their hash, and rows that agree in id and text are one document, so all
of them keep or lose the same words; very long texts are cut into overlapping
blocks whose windows are those of the whole; an empty table gives an empty
result; ``digest`` reads no other column, ``cleaned`` carries them along unchanged
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.recompression import PLACE_BITS, rounds_of, segments, text_names
from presslens.llm.shared import materialise, release, unused

LENGTH = 20
#: bytes worked on at once
BLOCK = 2_000_000
#: bytes of classes compared by one task, and of one name's classes before its windows are aggregated instead
SHARD, CROWDED = 2_000_000, 2_000_000
#: rough bytes of a word and its space
WORD = 7
SPACE = np.isin(np.arange(256), np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8))


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(number of the first word, text); a text beyond BLOCK goes on with LENGTH - 1 words of overlap."""
    if len(text) <= BLOCK:
        yield 0, text
        return
    words = text.split()
    begin = 0
    while begin + length <= len(words):
        end, held = begin, 0
        while end < len(words) and (held <= BLOCK // 2 or end < begin + length):
            held += len(words[end]) + 1
            end += 1
        yield begin, b" ".join(words[begin:end])
        begin = end - length + 1


def _blocks(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Pieces (row, first word, text) of about BLOCK bytes together."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for begin, piece in _pieces(text, length):
            if held and size + len(piece) > BLOCK:
                yield held
                held, size = [], 0
            held.append((row, begin, piece))
            size += len(piece) + 1
    if held:
        yield held


def _found(held: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """(piece, start, windows, anchor less start, key, content) of the segments of a block."""
    raw = np.frombuffer(b"\n".join([text for _, _, text in held]) + b"\n", np.uint8)
    stops = np.cumsum([len(text) + 1 for _, _, text in held]) - 1
    space = SPACE[raw]
    # words with one space after each
    kept = np.flatnonzero(~space | np.r_[False, space[1:] & ~space[:-1]])
    text = np.where(space[kept], np.uint8(32), raw[kept])
    end = np.flatnonzero(text == 32)
    size = np.diff(np.r_[-1, end]) - 1
    begin = end - size
    piece = np.searchsorted(stops, kept[end])
    # a separator after the words of each piece
    at = np.arange(len(end)) + piece
    total = len(end) + len(held)
    assert total < 1 << PLACE_BITS
    separator = np.ones(total, bool)
    separator[at] = False
    names, sizes, places = np.zeros(total, np.uint64), np.ones(total, np.int64), np.zeros(total, np.int64)
    names[at], sizes[at], places[at] = text_names(text, begin, size), size + 1, np.arange(len(end))
    last = np.flatnonzero(separator)[piece]
    start, count, place, key = segments(names, sizes, separator, at[at + length <= last], length, rounds_of(length))
    word, off = places[start], place - start
    data = text.tobytes()
    hashed = xxhash.xxh3_64_intdigest
    spans = zip(begin[word].tolist(), end[word + count - 2 + length].tolist(), off.tolist())
    content = np.fromiter((hashed(data[b:e], o) for b, e, o in spans), np.uint64, len(word))
    own = piece[word]
    earlier = np.searchsorted(piece, np.arange(len(held)))  # words of the pieces before
    first = np.array([begin for _, begin, _ in held], dtype=np.int64)
    return own, word - earlier[own] + first[own], count, off, key.view(np.int64), content.view(np.int64)


def named_segments(docs: DataFrame, length: int) -> DataFrame:
    """Every segment of ``docs`` (doc_id, k2, text as bytes)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in _blocks(batch.column("text").to_pylist(), length):
                piece, start, count, off, key, content = _found(held, length)
                row = pa.array(np.array([r for r, _, _ in held], dtype=np.int64)[piece])
                columns = [batch.column("doc_id").take(row), batch.column("k2").take(row)]
                columns += [pa.array(x.astype(np.int32)) for x in (start, count, off)] + [pa.array(key), pa.array(content)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k2", "start", "windows", "off", "key", "content"])

    kinds = f"doc_id {_kind(docs)}, k2 bigint, start int, windows int, off int, key bigint, content bigint"
    # a text of n words has 2 n - 1 bytes at least
    return docs.filter(F.octet_length("text") >= 2 * length - 1).select("doc_id", "k2", "text").mapInArrow(find, kinds)


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def recurring(found: DataFrame) -> DataFrame:
    """Segments whose name occurs more than once; the names are written first, so that a hot one can be split."""
    again = materialise(found.groupBy("key").count().filter("count > 1").select("key"), "again")
    members = materialise(found.join(again, "key", "left_semi").select(*found.columns), "recurring")
    release(again)
    return members


def _same_document(a: str, b: str) -> Column:
    return (F.col(f"{a}.k2") == F.col(f"{b}.k2")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))


def fetched(classes: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The words of every class, cut from its first member's text."""
    own = classes.select("first.*", "key", "content", "crowded", "windows")
    wanted = own.groupBy("doc_id", "k2").agg(F.collect_list(F.struct("key", "content", "crowded", "start", "windows")).alias("found"))
    joined = docs.alias("d").join(wanted.alias("w"), _same_document("d", "w")).select("d.doc_id", "d.k2", "d.text", "w.found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            found = batch.column("found")
            rows = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy())
            key, content, crowded, start, windows = found.flatten().flatten()
            texts, parts = [t.split() for t in batch.column("text").to_pylist()], []
            for row, a, n in zip(rows.tolist(), start.to_pylist(), windows.to_pylist()):
                parts.append(b" ".join(texts[row][a : a + n + length - 1]))
            columns = [key, content, crowded, start, pa.array(parts, pa.binary()), *(batch.column(n).take(pa.array(rows)) for n in ("doc_id", "k2"))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "content", "crowded", "start", "words", "doc_id", "k2"])

    return joined.mapInArrow(cut, f"key bigint, content bigint, crowded boolean, start int, words binary, doc_id {_kind(docs)}, k2 bigint")


def _windows(words: bytes, length: int) -> list[bytes]:
    """Every window of ``length`` words of words joined by one space."""
    ends = list(accumulate([len(w) + 1 for w in words.split()]))
    return [words[a : b - 1] for a, b in zip([0, *ends], ends[length - 1 :])]


def repeats_in(length: int):
    """One shard of names: the windows of each class that come earlier in another class, as from..to within the class."""

    def find(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(n).to_pylist() for n in ("key", "content", "words", "doc_id", "k2", "start"))))
        # documents numbered in order, so that a place is one integer
        order = {d: i << 32 for i, d in enumerate(sorted({r[3:5] for r in rows}, key=lambda d: (d[0] is not None, *d)))}
        earliest: dict[bytes, int] = {}
        classes: dict[tuple[int, int], tuple[int, list[bytes]]] = {}
        for key, content, words, doc_id, k2, start in rows:
            if (key, content) in classes:  # a repeated row is fetched once per repeat
                continue
            first, windows = order[doc_id, k2] + start, _windows(words, length)
            classes[key, content] = first, windows
            for place, window in enumerate(windows, first):
                if earliest.setdefault(window, place) > place:
                    earliest[window] = place
        out = []
        for (key, content), (first, windows) in classes.items():
            run = None
            for i, window in enumerate(windows):
                if earliest[window] == first + i:
                    run = None
                elif run is None:
                    run = [key, content, i, i]
                    out.append(run)
                else:
                    run[3] = i
        kinds = [("key", pa.int64()), ("content", pa.int64()), ("from", pa.int32()), ("to", pa.int32())]
        return pa.table({n: pa.array([r[i] for r in out], k) for i, (n, k) in enumerate(kinds)})

    return find


REPEATS = "key bigint, content bigint, `from` int, `to` int"


def crowded_repeats(dense: DataFrame, length: int) -> DataFrame:
    """The same as ``repeats_in`` by an aggregation of single windows: names of any size, in any number of tasks."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            found = [_windows(w, length) for w in batch.column("words").to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(w) for w in found]))
            nth = pa.array([i for w in found for i in range(len(w))], pa.int32())
            digests = pa.array([xxhash.xxh3_128_digest(x) for w in found for x in w], pa.binary())
            columns = [digests, nth, *(batch.column(n).take(rows) for n in ("key", "content", "doc_id", "k2", "start"))]
            yield pa.RecordBatch.from_arrays(columns, ["window", "nth", "key", "content", "doc_id", "k2", "start"])

    kinds = f"window binary, nth int, key bigint, content bigint, doc_id {_kind(dense)}, k2 bigint, start int"
    place = F.struct("doc_id", "k2", (F.col("start") + F.col("nth")).alias("place"))
    windows = materialise(dense.mapInArrow(spread, kinds).withColumn("own", place), "windows")
    earliest = windows.groupBy("window").agg(F.min("own").alias("earliest"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = windows.join(materialise(earliest, "earliest"), "window").filter(~F.col("own").eqNullSafe(F.col("earliest")))
    return again.select("key", "content", F.col("nth").alias("from"), F.col("nth").alias("to"))


def covered_words(docs: DataFrame, length: int = LENGTH, shard: int = SHARD, crowded: int = CROWDED) -> DataFrame:
    """doc_id, k2, covered (list of begin and end, overlaps not merged) of the documents that change.

    ``docs`` has doc_id, k2 (hash of the text) and text (bytes, not null).
    """
    found = materialise(named_segments(docs, length), "segments")
    members = recurring(found)
    release(found)
    first = F.min(F.struct("doc_id", "k2", "start")).alias("first")
    classes = members.groupBy("key", "content").agg(first, F.first("windows").alias("windows"), F.count(F.lit(1)).alias("members"))
    classes = materialise(classes, "classes")
    weight = F.sum((F.col("windows") + length) * WORD)
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), weight.alias("bytes")).filter("kinds > 1")
    several = materialise(several.select("key", "bytes", (F.col("bytes") > crowded).alias("crowded")), "several")
    total, dense = several.agg(F.sum(F.when(~F.col("crowded"), F.col("bytes"))), F.count_if("crowded")).first()
    texts = materialise(fetched(classes.join(several, "key"), docs, length), "words")
    dealt = texts.filter("NOT crowded").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit((total or 0) // shard + 1)))
    repeats = dealt.groupBy("shard").applyInArrow(repeats_in(length), REPEATS)
    if dense:
        repeats = repeats.unionByName(crowded_repeats(texts.filter("crowded"), length))
    runs = repeats.groupBy("key", "content").agg(F.collect_list(F.struct("from", "to")).alias("runs"))
    # in a class, all but the first member repeat it; the first repeats what other classes have earlier
    decided = classes.join(runs, ["key", "content"], "left").filter("members > 1 OR runs IS NOT NULL")
    decided = materialise(decided.select("key", "content", "first", "runs"), "decided")
    release(texts, several, classes)
    start, is_first = F.col("start"), F.struct("doc_id", "k2", "start").eqNullSafe(F.col("first"))

    def span(a: Column, b: Column) -> Column:
        return F.struct((start + a).alias("begin"), (start + b + length).alias("end"))

    own = F.coalesce(F.transform("runs", lambda r: span(r["from"], r["to"])), F.array().cast("array<struct<begin:int,end:int>>"))
    whole = F.array(span(F.lit(0), F.col("windows") - 1))
    spans = members.join(decided, ["key", "content"]).select("doc_id", "k2", F.explode(F.when(is_first, own).otherwise(whole)).alias("span"))
    covered = materialise(spans.groupBy("doc_id", "k2").agg(F.collect_list("span").alias("covered")), "covered")
    release(members, decided)
    return covered


def _kept(text: bytes, covered: list[dict] | None) -> tuple[int, list[bytes]]:
    """(number of words, words that stay)."""
    words = text.split()
    if not covered:
        return len(words), words
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, [c["begin"] for c in covered], 1)
    np.add.at(gone, [c["end"] for c in covered], -1)
    return len(words), [w for w, n in zip(words, np.cumsum(gone).tolist()) if not n]


def _read(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("k2"), text.cast("binary").alias("text"))


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD, crowded: int = CROWDED) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256."""
    docs = _read(df, id_col, text_col)
    covered = covered_words(docs, length, shard, crowded)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(n, len(w), hashlib.sha256(b" ".join(w)).hexdigest()) for n, w in map(_kept, *(batch.column(c).to_pylist() for c in ("text", "covered")))]
            numbers = [pa.array([k[0] for k in kept], pa.int64()), pa.array([k[0] - k[1] for k in kept], pa.int64())]
            columns = [batch.column("doc_id"), *numbers, pa.array([k[2] for k in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = docs.alias("d").join(covered.alias("c"), _same_document("d", "c"), "left").select("d.doc_id", "d.text", "c.covered")
    return joined.mapInArrow(cut, f"doc_id {_kind(docs)}, n_words bigint, n_removed bigint, kept_sha256 string")


def cleaned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD, crowded: int = CROWDED) -> DataFrame:
    """``df`` with the kept words of changed texts, joined by one space; other texts stay as they are."""
    docs = _read(df, id_col, text_col)
    covered = covered_words(docs, length, shard, crowded)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = (batch.column(n).to_pylist() for n in ("text", "covered"))
            kept = [b" ".join(_kept(t, c)[1]).decode() for t, c in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k2"), pa.array(kept, pa.string())], ["doc_id", "k2", "kept"])

    changed = docs.alias("d").join(covered.alias("c"), _same_document("d", "c")).select("d.doc_id", "d.k2", "d.text", "c.covered")
    kept = changed.mapInArrow(cut, f"doc_id {_kind(docs)}, k2 bigint, kept string").dropDuplicates(["doc_id", "k2"])
    own_id, own_k2, new = (unused(df, x) for x in ("_kept_id", "_kept_k2", "_kept"))
    kept = kept.select(F.col("doc_id").alias(own_id), F.col("k2").alias(own_k2), F.col("kept").alias(new))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(own_k2))
    return df.join(kept, same, "left").withColumn(text_col, F.coalesce(F.col(new), F.col(text_col))).select(*df.columns)


ORACLE = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - {LENGTH - 2})) AS s FROM texts
), again AS (
  SELECT doc_id, s FROM starts
  QUALIFY row_number() OVER (PARTITION BY array_to_string(words[s : s + {LENGTH - 1}], ' ') ORDER BY doc_id, s) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + {LENGTH})) AS p FROM again
), spoken AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM texts
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
  FROM spoken ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(t.words)::BIGINT AS n_words, (len(t.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.words, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""
