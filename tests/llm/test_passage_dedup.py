"""Recompression and substring dedup against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest

from llm_tables import AWKWARD, SMOKE, awkward, documents, empty  # noqa: F401
from presslens.llm import passage_dedup, recompression


def test_anchors_depend_on_nothing_but_the_window():
    rng = np.random.default_rng(1)
    for length in (1, 3, 5, 10, 20, 23, 50):
        for symbols in (1, 2, 3, 10):
            texts = [rng.integers(0, symbols, rng.integers(0, 120)) for _ in range(6)]
            texts.append(np.r_[texts[0], texts[1], texts[0]])
            names = recompression.mix(np.arange(symbols, dtype=np.uint64), np.uint64(7))
            named = np.concatenate([np.r_[names[t], np.uint64(0)] for t in texts]).astype(np.uint64)
            plain = np.concatenate([np.r_[t, -1] for t in texts])
            windows = np.array([i for i in range(len(plain) - length + 1) if (plain[i : i + length] >= 0).all()], dtype=np.int64)
            key, place = recompression.anchors(named, np.ones(len(named), np.int64), plain < 0, windows, length, recompression.rounds_of(length))
            seen = {}
            for w, k, p in zip(windows.tolist(), key.tolist(), place.tolist()):
                assert 0 <= p - w < length
                assert seen.setdefault(plain[w : w + length].tobytes(), (k, p - w)) == (k, p - w)


def brute(rows, length):
    """Rows of (id, text) with doc_id distinct, or rows that repeat entirely."""
    docs = sorted({(i is not None, i, t) for i, t in rows}, key=lambda r: (r[0], r[1] or 0))
    words = {(i, t): (t or "").encode().split() for _, i, t in docs}
    seen, out = set(), {}
    for _, i, t in docs:
        own = words[i, t]
        gone = [False] * len(own)
        for a in range(len(own) - length + 1):
            window = tuple(own[a : a + length])
            if window in seen:
                gone[a : a + length] = [True] * length
            seen.add(window)
        kept = [w for w, g in zip(own, gone) if not g]
        out[i, t] = (i, len(own), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return sorted((out[r] for r in rows), key=str)


def got(df, **more):
    return sorted((tuple(r) for r in passage_dedup.digest(df, **more).collect()), key=str)


def passages(seed, n, symbols):
    rng = random.Random(seed)
    shared = [[f"w{rng.randrange(symbols)}" for _ in range(rng.randrange(3, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += rng.choice(shared) if rng.random() < 0.6 else [f"w{rng.randrange(symbols)}" for _ in range(rng.randrange(0, 40))]
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(words)))
    return rows


@pytest.mark.parametrize("length", [1, 4, 20])
@pytest.mark.parametrize("crowded", [0, passage_dedup.CROWDED])
def test_against_brute_force(documents, length, crowded):  # noqa: F811
    rows = passages(length, 60, 40) + [(100, "a " * 300), (101, "a b " * 100), (102, "x " + "a " * 40)]
    rows += [(7, rows[7][1])]  # a repeated row
    assert got(documents(rows), length=length, shard=500, crowded=crowded) == brute(rows, length)


def test_long_texts_in_blocks(documents, monkeypatch):  # noqa: F811
    rows = [(i, t * 3) for i, t in passages(9, 30, 500)]
    monkeypatch.setattr(passage_dedup, "BLOCK", 300)
    texts = [t.encode() for _, t in rows]
    starts, found = [], []
    for held in passage_dedup._blocks(texts, 20):
        starts += [(r, b + i) for r, b, piece in held for i in range(len(piece.split()) - 19)]
        piece, start, count, off, _, _ = passage_dedup._found(held, 20)
        found += [(held[p][0], s + i) for p, s, n in zip(piece.tolist(), start.tolist(), count.tolist()) for i in range(n)]
        assert ((off >= 0) & (off < 20)).all()
    whole = [(r, i) for r, t in rows for i in range(len(t.split()) - 19)]
    assert starts == whole and found == whole
    assert any(len(t) > 600 for t in texts)


def test_names_tell_words_apart():
    words = [b"a", b"b", b"aa", b"ab", b"ba", "é".encode(), b"x" * 50, b"x" * 51]
    text = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    size = np.array([len(w) for w in words])
    begin = np.cumsum(size + 1) - size - 1
    names = recompression.text_names(text, begin, size)
    assert len(set(names.tolist())) == len(words)
    again = recompression.text_names(text[begin[5] :], begin[5:] - begin[5], size[5:])
    assert again.tolist() == names[5:].tolist()


def test_awkward_rows(awkward):  # noqa: F811
    # ids 3 and 4 share a text below the window; (3, "a b") repeats
    assert got(awkward, length=2) == brute(AWKWARD, 2)
    assert got(awkward) == brute(AWKWARD, 20)


def test_texts_under_one_id_keep_one_copy_of_a_passage(documents):  # noqa: F811
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, passage + " one"), (1, passage + " two"), (1, passage + " two")]
    removed = sorted((r.n_words, r.n_removed) for r in passage_dedup.digest(documents(rows)).collect())
    # equal rows share one fate, and one of the two different texts keeps the passage
    assert removed in ([(26, 0), (26, 25), (26, 25)], [(26, 0), (26, 0), (26, 25)])


def test_cleaned_keeps_columns_and_unchanged_texts(documents):  # noqa: F811
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, "new  line\n" + passage), (2, "a  b " + passage + " c"), (None, None), (3, "one  two")]
    table = documents(rows)
    out = passage_dedup.cleaned(table)
    assert out.columns == table.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: rows[0][1], 2: "a b c", None: None, 3: "one  two"}


def test_empty_table(empty):  # noqa: F811
    assert got(empty) == []


def test_whole_documents_table(spark):
    table = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert got(table) == brute(rows, 20)
