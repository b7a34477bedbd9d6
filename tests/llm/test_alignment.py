"""Cross-tokenizer alignment against a brute force that encodes whole texts."""

import hashlib
from bisect import bisect_left
from collections import Counter

import pytest

from llm_tables import AWKWARD, SMOKE, awkward, documents, empty  # noqa: F401
from presslens.llm import alignment
from presslens.llm.queries import ALIGNED

ODD = [
    " a", "a  b ", "a\n b", "a \nb", "x \n y", "▁x", "é 　x  y", "<s> <|endoftext|> </s> <0x41>", "日本語 テキスト 🙂", "don't 's  'll",
    "a" * 3000, "\x1c \x1d a", "á\x85 b", "a\x00b c", "ab  c", "\t\tx = 1\n\n\ty", "w " * 2000, "ﬁne é", "  ", "\n",
]


@pytest.fixture(scope="module")
def both():
    return alignment.aligner(*ALIGNED)


def groups(both, text):
    """[(A ids, B ids)] cut where both vocabularies' tokens end, by encoding the whole text."""
    if not text:
        return []
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    pieces = [[both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]]
    if any(b"".join(p) != (" " + text).encode() for p in pieces):
        return []
    ends = []
    for p in pieces:
        at, own = 0, []
        for x in p:
            at += len(x)
            own.append(at)
        ends.append(own)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out = [([], []) for _ in cuts]
    for side, (ids, own) in enumerate(zip((a, b), ends)):
        for i, e in zip(ids, own):
            out[bisect_left(cuts, e)][side].append(i)
    return out


def brute(both, texts):
    found = [groups(both, t) for t in texts]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in found]
    docs = Counter(pair for own in links for pair in own)
    most = {}
    for (a, _), n in docs.items():
        most[a] = max(most.get(a, 0), n)
    rows = []
    for g, own in zip(found, links):
        spelt = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        rows.append(
            (
                sum(len(x) for x, _ in g),
                sum(len(y) for _, y in g),
                len(g),
                sum(own.values()),
                sum(n for p, n in own.items() if docs[p] == most[p[0]]),
                sum(n * docs[p] for p, n in own.items()),
                hashlib.sha256(spelt.encode()).hexdigest() if g else "",
            )
        )
    return rows


def aligned(df, **more):
    return sorted((tuple(r) for r in alignment.align(df, *ALIGNED, **more).collect()), key=str)


def expected(both, rows):
    return sorted(((r[0], *x) for r, x in zip(rows, brute(both, [r[1] for r in rows]))), key=str)


def test_awkward_rows(both, awkward):  # noqa: F811
    assert aligned(awkward) == expected(both, AWKWARD)


@pytest.mark.parametrize("cached", [0, 3, alignment.CACHED])
def test_odd_texts_with_and_without_cached_pairs(both, documents, cached):  # noqa: F811
    rows = list(enumerate(ODD + ODD[:5]))
    assert aligned(documents(rows), cached=cached) == expected(both, rows)


def test_whole_texts_where_vocabularies_do_not_split_at_spaces(both, monkeypatch):
    monkeypatch.setattr(both, "wordwise", False)
    whole = [";".join(r[3] for r in own) for own in both.align(ODD)]
    monkeypatch.setattr(both, "wordwise", True)
    assert whole == [";".join(r[3] for r in own) for own in both.align(ODD)]


def test_memory_starts_afresh(both, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 2)
    texts = ["one two three", "four five six", "one six " + "x" * 200]
    first = [both.align([t]) for t in texts]
    assert first == [[own] for own in both.align(texts)]


def test_empty_table(empty):  # noqa: F811
    assert aligned(empty) == []


def test_whole_documents_table(both, spark):
    table = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert aligned(table) == expected(both, rows)
