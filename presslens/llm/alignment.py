"""Cross-tokenizer alignment by interval coalescing.

The tokens of vocabulary A (byte-level BPE) and of vocabulary B (sentencepiece
BPE with byte fallback) tile the same bytes. All of them are sorted by their
first byte, the running maximum of their ends is accumulated, and a new group
begins wherever a token starts at that maximum. Within a group every A token is
linked with every B token.

Neither vocabulary has an entry that goes on past a space between two words, so
tokens and groups of a word never depend on its neighbours: the words of a batch
of texts are encoded and coalesced together, once each, and remembered (up to
REMEMBERED of them, then the memory starts afresh). Vocabularies without that
property, and texts that do not survive encoding word by word, are encoded whole.

Documents that hold an id pair are counted per task and then by a shuffle of
distinct pairs. The CACHED most frequent pairs are given to every task, which
rates almost all links where they lie; the others are joined.

Defined results: a text that is null, empty or not restored by its tokens has no
tokens, zeros in all columns and '' as digest; null and repeated ids are rows of
their own and each row counts as a document; very long texts are encoded whole in
one task; an empty table gives an empty result; other columns are not read, so
their names can't clash; ties for an A id's highest count all count as best.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from presslens.llm.shared import materialise

#: words remembered by a task, longest word remembered, characters of text worked on at once
REMEMBERED, LONGEST, SLICE = 300_000, 64, 1 << 20
#: pairs given to every task, pairs counted by a task before it passes them on
CACHED, COUNTED = 262_144, 1_000_000
SPACE_MARK = "▁"
#: a space with white space on neither side: where a text falls into words
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
CROWDED_SPACE = re.compile(r"\s\s|^\s|\s$")
#: words of visible characters up to U+024F and line ends, of which every engine of the split pattern thinks alike
PLAIN = re.compile("[\n!-~¡-ɏ]+")
#: Fixed value: the byte-level split pattern.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: bytes that no text holds, for entries that stand for no text
NO_TEXT = b"\xff"

#: in place of the times of pairs that are all linked once
ONCE, ONE = b"", np.int64(1).tobytes()

Record = tuple[bytes, bytes, bytes, str] | None


def byte_alphabet() -> dict[str, int]:
    """Byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for U+0100 and on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def entries_a(tokenizer: Tokenizer) -> list[bytes]:
    alphabet = byte_alphabet()
    entries = [NO_TEXT] * tokenizer.get_vocab_size()
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        entries[number] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else NO_TEXT
    return entries


def entries_b(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    def of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if model.is_control(i) or model.is_unknown(i):
            return NO_TEXT
        return piece.replace(SPACE_MARK, " ").encode()

    return [of(i) for i in range(model.get_piece_size())]


def coalesce(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by start, group of each token in that order): a group ends where no token reaches on."""
    order = np.lexsort((end, start))
    reached = np.maximum.accumulate(end[order])
    new = np.r_[True, start[order][1:] >= reached[:-1]][: len(order)]
    return order, np.cumsum(new) - 1


def _counted(group: np.ndarray, ids: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) of the distinct ids of each group, in order of group."""
    found, times = np.unique(group * span + ids, return_counts=True)
    return found // span, found % span, times


class Aligner:
    """Encodes texts with both vocabularies and coalesces their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.bytes_a, self.bytes_b = entries_a(self.a), entries_b(self.b)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in e], dtype=np.int64) for e in (self.bytes_a, self.bytes_b))
        self.span = max(len(self.bytes_a), len(self.bytes_b))
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        pieces = (self.b.id_to_piece(i).lstrip(SPACE_MARK) for i in range(len(self.bytes_b)))
        self.wordwise = (
            spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(SPACE_MARK in p for p in pieces)
            and self.b.normalize("a  b ") == f"{SPACE_MARK}a{SPACE_MARK * 2}b{SPACE_MARK}"
        )
        self.quick = self._ranked(spec["model"].get("merges", [])) if self.wordwise else None
        self.names = list(map(str, range(self.span)))
        self.known: dict[str, Record] = {}

    def _ranked(self, merges: list) -> tiktoken.CoreBPE | None:
        """A faster engine for A, if A's ids are its order of merging."""
        alphabet, ranks = byte_alphabet(), {e: i for i, e in enumerate(self.bytes_a) if e != NO_TEXT}
        for i, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if ranks.get(bytes(alphabet[c] for c in left + right)) != 256 + i:
                return None
        return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids of texts that each begin with the space in front."""
        if self.quick is None:
            return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        quick, plain = self.quick.encode_ordinary, PLAIN.fullmatch
        return [quick(t) if plain(t, 1) else self.a.encode(t, add_special_tokens=False).ids for t in texts]

    def words(self, text: str) -> list[str]:
        """``text`` cut at spaces; every word stands for one space and itself."""
        if not self.wordwise:
            return [text]
        return BETWEEN.split(text) if CROWDED_SPACE.search(text) else text.split(" ")

    def records(self, words: list[str]) -> list[Record]:
        """For each word: pair codes, times of each (or ONCE), (A tokens, B tokens, groups, links), groups as text; None if not restored."""
        if not words:
            return []
        wanted = [" " + w for w in words]
        tokens = self.encode_a(wanted), self.b.encode(words, num_threads=1)
        expected = [w.encode() for w in wanted]
        restored = [
            b"".join(map(self.bytes_a.__getitem__, a)) == e == b"".join(map(self.bytes_b.__getitem__, b))
            for a, b, e in zip(*tokens, expected)
        ]
        good = [i for i, ok in enumerate(restored) if ok]
        out: list[Record] = [None] * len(words)
        if good:
            for i, record in zip(good, self._grouped(*([t[i] for i in good] for t in tokens))):
                out[i] = record
        return out

    def _grouped(self, a: list[list[int]], b: list[list[int]]) -> Iterator[Record]:
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b)]
        ids = [np.fromiter(chain.from_iterable(side), np.int64, int(n.sum())) for side, n in zip((a, b), counts)]
        ends = [np.cumsum(sizes[i]) for sizes, i in zip((self.sizes_a, self.sizes_b), ids)]
        starts = [e - sizes[i] for e, sizes, i in zip(ends, (self.sizes_a, self.sizes_b), ids)]
        side = np.r_[np.zeros(len(ids[0]), np.int64), np.ones(len(ids[1]), np.int64)]
        token, word = np.concatenate(ids), np.concatenate([np.repeat(np.arange(len(n)), n) for n in counts])
        order, group = coalesce(np.concatenate(starts), np.concatenate(ends))
        side, token, word = side[order], token[order], word[order]

        # group by group, A before B
        spoken = np.lexsort((side, group))
        g, s, w = group[spoken], side[spoken], word[spoken]
        change = np.where(w[1:] != w[:-1], 3, np.where(g[1:] != g[:-1], 2, s[1:] != s[:-1]))
        pieces = [""] * (2 * len(token) - 1)
        pieces[::2] = map(self.names.__getitem__, token[spoken].tolist())
        pieces[1::2] = map(",|;\n".__getitem__, change.tolist())
        texts = "".join(pieces).split("\n")

        ga, ia, ta = _counted(group[side == 0], token[side == 0], self.span)
        gb, ib, tb = _counted(group[side == 1], token[side == 1], self.span)
        first = np.searchsorted(gb, ga, "left")
        partners = np.searchsorted(gb, ga, "right") - first
        left = np.repeat(np.arange(len(ga)), partners)
        right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners) + first[left]
        codes, times = ia[left] * self.span + ib[right], ta[left] * tb[right]
        owner = np.empty(int(group[-1]) + 1, np.int64)
        owner[group] = word
        pair_word = owner[ga[left]]
        n_links = np.bincount(pair_word, weights=times, minlength=len(counts[0])).astype(np.int64)
        sums = np.column_stack([counts[0], counts[1], np.bincount(owner, minlength=len(counts[0])), n_links]).tobytes()
        cuts = (8 * np.searchsorted(pair_word, np.arange(len(counts[0]) + 1))).tolist()
        several = np.bincount(pair_word, weights=times > 1, minlength=len(counts[0])).tolist()
        codes, times = codes.tobytes(), times.tobytes()
        for i, (begin, end, text) in enumerate(zip(cuts, cuts[1:], texts)):
            yield codes[begin:end], times[begin:end] if several[i] else ONCE, sums[32 * i : 32 * i + 32], text

    def align(self, texts: list[str]) -> list[list[Record]]:
        """The records of every text; no records for a text that either vocabulary does not restore."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        cut = [self.words(t) if t else [] for t in texts]
        known = self.known
        new = list({w for words in cut for w in words if w not in known})
        fresh = dict(zip(new, self.records(new)))
        found = {w: r for w, r in fresh.items() if len(w) > LONGEST}
        known.update((w, r) for w, r in fresh.items() if len(w) <= LONGEST)
        out = []
        for text, words in zip(texts, cut):
            own = [known[w] if w in known else found[w] for w in words]
            if None in own:
                own = self.records([text]) if len(words) > 1 else [None]
            out.append([] if None in own else own)
        return out


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner; Python workers are reused by later tasks."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Aligner(a_path, b_path)
    return _loaded[a_path, b_path]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about SLICE characters."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= SLICE:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _distinct(records: list[list[Record]]) -> tuple[list[bytes], list[bytes]]:
    """The distinct pairs of every text: codes and how often each is linked, packed."""
    codes, times = [], []
    for own in records:
        every = np.frombuffer(b"".join([r[0] for r in own]), np.int64)
        if any(r[1] for r in own):
            weights = np.frombuffer(b"".join([r[1] or ONE * (len(r[0]) // 8) for r in own]), np.int64)
            code, at = np.unique(every, return_inverse=True)
            total = np.bincount(at, weights=weights, minlength=len(code)).astype(np.int64)
        else:
            every = np.sort(every)
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
            code, total = every[first], np.diff(np.r_[first, len(every)])
        codes.append(code.tobytes())
        times.append(total.tobytes())
    return codes, times


ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, codes binary, times binary"


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``rid``, ``doc_id`` and, of each text, its counts, digest and distinct pairs (packed 64-bit codes and times)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = aligner(a_path, b_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for begin, end in _slices(texts):
                records = encoder.align(texts[begin:end])
                sums = [np.frombuffer(b"".join([r[2] for r in own]), np.int64).reshape(-1, 4).sum(axis=0) for own in records]
                digests = [hashlib.sha256(";".join([r[3] for r in own]).encode()).hexdigest() if own else "" for own in records]
                packed = _distinct(records)
                numbers = np.array(sums).T
                part = batch.slice(begin, end - begin)
                columns = [part.column("rid"), part.column("doc_id"), *(pa.array(n) for n in numbers)]
                columns += [pa.array(digests, pa.string()), *(pa.array(p, pa.binary()) for p in packed)]
                yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("rid", "doc_id", "text").mapInArrow(find, f"rid bigint, doc_id {kind}, {ALIGNED}")


def _tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per pair code among a task's rows, passed on whenever COUNTED pairs have come together."""

    def out(codes: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(docs)], ["code", "docs"])

    codes, docs = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
            new, times = np.unique(np.frombuffer(b"".join(part.column(0).to_pylist()), np.int64), return_counts=True)
            codes, at = np.unique(np.r_[codes, new], return_inverse=True)
            docs = np.bincount(at, weights=np.r_[docs, times], minlength=len(codes)).astype(np.int64)
            if len(codes) > COUNTED:
                yield out(codes, docs)
                codes, docs = np.empty(0, np.int64), np.empty(0, np.int64)
    yield out(codes, docs)


def pair_counts(tokens: DataFrame, span: int) -> DataFrame:
    """code, docs (documents that hold the pair linked), best (no pair of its A id is in more)."""
    tallied = tokens.select("codes").mapInArrow(_tally, "code bigint, docs bigint")
    counts = materialise(tallied.groupBy("code").agg(F.sum("docs").alias("docs")), "pairs")
    own = counts.withColumn("a", F.expr(f"code div {span}"))
    most = own.groupBy("a").agg(F.max("docs").alias("most"))
    return own.join(most, "a").select("code", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _rated(codes: np.ndarray, docs: np.ndarray, best: np.ndarray):
    """Sums over the links of known pairs (sorted ``codes``); the pairs that aren't known are handed on."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                lists = [part.column(n).to_pylist() for n in ("codes", "times")]
                code, times = (np.frombuffer(b"".join(x), np.int64) for x in lists)
                row = np.repeat(np.arange(len(lists[0])), [len(x) // 8 for x in lists[0]])
                at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
                hit = codes[at] == code if len(codes) else np.zeros(len(code), bool)
                # integers of at most 2^53 stay exact as weights
                sums = [np.bincount(row[hit], weights=w[at[hit]] * times[hit], minlength=len(lists[0])) for w in (best, docs)]
                cuts = np.searchsorted(row[~hit], np.arange(len(lists[0]) + 1)).astype(np.int32)
                rest = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[~hit])) for x in (code, times)]
                columns = [part.column("rid"), *(pa.array(s.astype(np.int64)) for s in sums), *rest]
                yield pa.RecordBatch.from_arrays(columns, ["rid", "known_best", "known_sum", "codes", "times"])

    return rate


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", cached: int = CACHED) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tokens = materialise(aligned(docs, a_path, b_path), "aligned")
    pairs = materialise(pair_counts(tokens, aligner(a_path, b_path).span), "rated-pairs")
    top = pairs.orderBy(F.col("docs").desc(), "code").limit(cached).toArrow()
    order = np.argsort(top.column("code").to_numpy())
    known = (top.column(n).to_numpy()[order].astype(np.int64) for n in ("code", "docs", "best"))
    kinds = "rid bigint, known_best bigint, known_sum bigint, codes array<bigint>, times array<bigint>"
    rated = materialise(tokens.select("rid", "codes", "times").mapInArrow(_rated(*known), kinds), "rated")
    unknown = rated.select("rid", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("rid", F.col("p.codes").alias("code"), "p.times")
    joined = unknown.join(pairs, "code").groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("docs") * F.col("times")).alias("more_sum")
    )
    sums = rated.select("rid", "known_best", "known_sum").join(joined, "rid", "left")
    return tokens.join(sums, "rid").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("known_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("known_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
