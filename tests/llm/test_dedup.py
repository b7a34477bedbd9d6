"""Exact dedup, SimHash near-dedup and suffix-array dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from llm_tables import awkward, documents, empty  # noqa: F401
from presslens.llm import exact_dedup, simhash, suffix_dedup
from presslens.llm.suffix_arrays import common_prefixes, suffix_array


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- exact dedup


def test_exact_copies_of_awkward_rows(awkward):
    got = exact_dedup.copies(awkward).collect()
    assert len(got) == awkward.count()
    by_text = {}
    for r in got:
        by_text.setdefault(r.text_sha256, []).append(r)
    assert len(by_text) == 6
    ab = by_text[hashlib.sha256(b"a b").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in ab} == {(4, 4)}
    assert [r.doc_id for r in ab if r.kept] == [4]
    empty_texts = by_text[hashlib.sha256(b"").hexdigest()]
    assert {r.keep_id for r in empty_texts} == {2} and len(empty_texts) == 3
    assert all(sum(r.kept for r in group) == 1 for group in by_text.values())


def test_heavy_and_light_paths_agree(documents):
    rng = random.Random(3)
    table = documents([(i, f"text {rng.choice([0, 0, 0, 1, rng.randint(2, 400)])}") for i in range(3000)] + [(2999, "text 0")] * 3)
    light, heavy = (rows(exact_dedup.copies(table, heavy=h).drop("kept")) for h in (1, 64))
    assert light == heavy
    for h in (1, 64):
        kept = exact_dedup.survivors(table, heavy=h)
        assert kept.columns == table.columns
        texts = [r.text for r in kept.collect()]
        assert len(texts) == len(set(texts)) == table.select("text").distinct().count()


def test_misra_gries_misses_no_frequent_digest(documents):
    table = documents([(i, "hot" if i % 3 == 0 else str(i)) for i in range(3000)])
    found = table.select(exact_dedup.digest("text").alias("digest"))
    assert hashlib.sha256(b"hot").digest() in {bytes(r.digest) for r in exact_dedup.frequent_digests(found, 8).collect()}
    assert exact_dedup.frequent_digests(found, 8).count() <= 16


# ---- SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, "A b", "ÀB c D", "x " * 500, "a b c\x0bd e f g"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


def clusters(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def noisy(rng, n, centres, flips):
    values = rng.integers(0, 1 << 63, centres, dtype=np.uint64)[rng.integers(0, centres, n)]
    for _ in range(flips):
        values ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    return np.unique(values)


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 7])
@pytest.mark.parametrize("n", [2, 63, 64, 65, 700])
def test_bucket_links_against_brute_force(n, radius):
    values = noisy(np.random.default_rng(n), n, max(1, n // 20), radius)
    buckets = np.zeros(len(values), np.int64)
    got = simhash.bucket_links(buckets, values, radius)
    assert got.tolist() == clusters(values, radius)


def test_buckets_do_not_mix():
    values = np.array([1, 3, 1, 3, 7], dtype=np.uint64)
    got = simhash.bucket_links(np.array([0, 0, 1, 2, 2]), values, 3)
    assert got.tolist() == [0, 0, 2, 3, 3]


@pytest.mark.parametrize("tile", [40, 4096])
def test_links_join_exactly_the_components(spark, tile):
    values = noisy(np.random.default_rng(7), 900, 30, 2)
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    found = {r.node: r.root for r in simhash.components(simhash.links(table, tile=tile)).collect()}
    signed = values.view(np.int64).tolist()
    expected = clusters(values, simhash.RADIUS)
    groups, got = {}, {}
    for v, c in zip(signed, expected):
        groups.setdefault(c, set()).add(v)
    for v in signed:
        got.setdefault(found.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_near_copies_of_awkward_rows(awkward, empty):
    got = {(r.doc_id, r.component_id) for r in simhash.near_copies(awkward).collect()}
    assert {(1, 1), (2, 1), (6, 1), (3, 3), (4, 3), (None, 1), (None, 3)} <= got
    kept = simhash.survivors(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == [1, 3, 5, 7, 8]
    assert simhash.near_copies(empty).count() == simhash.survivors(empty).count() == 0


def test_components_without_or_with_repeated_ids_stay_apart(documents):
    texts = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red green blue black white grey pink"]
    table = documents([(None, texts[0]), (None, texts[1]), (None, texts[1]), (9, texts[2]), (9, "")])
    assert sorted(r.text for r in simhash.survivors(table).collect()) == sorted([*texts, ""])


# ---- suffix arrays


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array_and_prefixes(seed):
    rng = random.Random(seed)
    letters = rng.choice([b"a", b"ab", b"abc", b"\x00\xff", bytes(range(256))])
    text = bytes(rng.choice(letters) for _ in range(rng.randint(1, 50))) * rng.randint(1, 4)
    order = suffix_array(text, len(text)).tolist()
    assert order == sorted(range(len(text)), key=lambda i: text[i:])
    shared, before = common_prefixes(text, np.array(order))
    for a, b in zip(order, order[1:]):
        n = next((k for k in range(len(text) - max(a, b)) if text[a + k] != text[b + k]), len(text) - max(a, b))
        assert (before[b], shared[b]) == (a, n)


def brute_cuts(texts, length):
    texts = [(t or "").encode() for t in texts]
    count = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        covered = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        runs = sum(c and not p for p, c in zip([False, *covered], covered))
        kept = bytes(b for b, c in zip(t, covered) if not c)
        out.append((len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed, n=60):
    rng = random.Random(seed)

    def words(k):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(k))

    shared = [words(rng.randint(4, 30)) for _ in range(4)]
    texts = []
    for _ in range(n):
        t = words(rng.randint(0, 25))
        for _ in range(rng.randint(0, 2)):
            t = rng.choice([t + rng.choice(shared), rng.choice(shared)[: rng.randint(1, 60)] + t, t + "z" * rng.randint(0, 90)])
        texts.append(t)
    return [*texts, *texts[:5], None, ""]


@pytest.mark.parametrize("seed,length,crowded", [(1, 16, 2_000_000), (2, 24, 50), (3, 40, 300), (4, 64, 2_000_000)])
def test_suffix_dedup_against_brute_force(documents, seed, length, crowded):
    texts = passages(seed)
    table = documents(list(enumerate(texts)))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digest(table, length=length, crowded=crowded, shard=3000).collect()}
    assert [got[i] for i in range(len(texts))] == brute_cuts(texts, length)


def test_suffix_dedup_in_blocks_and_repeated_rows(documents, monkeypatch, empty):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 100)
    long = "".join(chr(97 + i * i % 23 + i // 7 % 3) for i in range(900))
    data = [(0, 0, long.encode()), (1, 1, (long[300:700] + "!").encode())]
    windows = {}
    for blob, held, places in suffix_dedup._blocks(data, 40):
        text, start, stop, anchor, key = suffix_dedup.segments(blob, places, 40)
        for t, a, b in zip(text, start, stop):
            for i in range(a, b + 1):
                spot = (held[t][0], held[t][2] + i - places[t][0])
                assert spot not in windows
                windows[spot] = blob[i : i + 40]
    assert windows == {(k, i): t[i : i + 40] for k, _, t in data for i in range(len(t) - 39)}
    twice = documents([(1, long), (1, long), (2, "short")])
    got = rows(suffix_dedup.digest(twice, length=64))
    assert [r[2] for r in got] == [900, 900, 0]
    cleaned = suffix_dedup.cleaned(twice, length=64)
    assert cleaned.columns == twice.columns and sorted(r.text for r in cleaned.collect()) == ["", "", "short"]
    assert suffix_dedup.digest(empty).count() == 0
