"""Rank-one eigen updates and embedding whitening against numpy's eigh."""

import math

import numpy as np
import pytest

from llm_tables import SMOKE
from presslens.llm import whitening
from presslens.llm.eigen_updates import Spectrum

RNG = np.random.default_rng(12)
CASES = {
    "scaled": RNG.normal(size=(300, 24)) * RNG.uniform(0.01, 30, 24),
    "integers": RNG.integers(-3, 4, size=(200, 12)).astype(float),
    "low rank": RNG.normal(size=(100, 3)) @ RNG.normal(size=(3, 20)),
    "repeated axes": np.repeat(np.eye(16)[:5], 7, axis=0),
    "one vector": np.ones((1, 8)),
    "equal vectors": np.ones((9, 8)),
    "one entry": RNG.normal(size=(50, 1)),
    "fewer vectors than entries": RNG.normal(size=(3, 30)),
    "far from zero": RNG.normal(size=(100, 10)) + 1e6,
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("parts", [1, 3])
def test_updates_and_merges_decompose_the_scatter(name, parts):
    x = CASES[name]
    found = []
    for part in np.array_split(x, parts):
        s = Spectrum(x.shape[1])
        for v in part:
            s.add(v)
        if s.n:
            found.append(Spectrum.unpack(s.pack()))
    whole = found[0]
    for other in found[1:]:
        whole.merge(other)
    c = x - x.mean(axis=0)
    scatter = c.T @ c
    size = max(np.abs(scatter).max(), 1e-300)
    assert whole.n == len(x)
    assert np.allclose(whole.mean, x.mean(axis=0), rtol=1e-14, atol=1e-12)
    assert np.abs(whole.axes.T @ whole.axes - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs((whole.axes * whole.values) @ whole.axes.T - scatter).max() <= 1e-8 * size
    assert (np.diff(whole.values) >= 0).all()


def brute(rows, components=16):
    """{(vec_id, component): ...} by one dense eigendecomposition per vector length."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for size in {len(x) for _, x in kept if x}:
        fit = {tuple(x) for _, x in kept if len(x) == size}
        n = len(fit)
        sums = [sum(c) for c in zip(*fit)]
        centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=float) / n
        values, axes = np.linalg.eigh(centred.T @ centred / n)
        values, axes = values[::-1], axes[:, ::-1]
        for i, x in kept:
            if len(x) != size:
                continue
            off = [n * a - s for a, s in zip(x, sums)]
            for c in range(min(components, size)):
                if values[c] > 1e-13 * values.sum():
                    y = float(np.array(off, dtype=float) / n @ axes[:, c] / math.sqrt(values[c]))
                    out.append((i, c + 1, n, sum(o * o for o in off), y, values[c] / values.sum()))
    return out


def check(df, rows, **more):
    got = whitening.whiten(df, **more).collect()
    want = brute(rows, more.get("components", 16))
    key = lambda r: (str(r[0]), r[2], r[3], r[1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r[:4]) for r in got] == [r[:4] for r in want]
    # a component's direction is free, but one for all rows
    sign = {}
    for r, w in zip(got, want):
        if abs(w[4]) > 1e-3:
            sign.setdefault((r[2], r[1]), math.copysign(1, w[4] * r[4]))
    for r, w in zip(got, want):
        assert abs(r[4] - sign.get((r[2], r[1]), 1) * w[4]) < 1e-7
        assert abs(r[5] - w[5]) <= 1e-9 * w[5]
        assert r[6] < 1e-9
    return got


def test_whole_embeddings_table(spark):
    table = spark.read.parquet(f"{SMOKE}/embeddings.parquet")
    got = check(table, [(r.vec_id, r.embedding) for r in table.collect()])
    assert len(got) == 16 * table.count()


def test_many_small_shares(spark, monkeypatch):
    monkeypatch.setattr(whitening, "SHARE", 7)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(RNG.normal(size=(120, 9)))]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), [(i, np.float32(v).tolist()) for i, v in rows])


def test_nulls_ties_lengths_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [math.sin(i * j) for j in range(1, 7)]) for i in range(20)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (99, rows[4][1])]  # repeated ids, rows and vectors
    rows += [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (52, [nan] * 6), (53, [inf] * 6), (54, []), (55, [-inf, 1.0])]
    rows += [(60 + i, [i * i / 7.0, math.cos(i)]) for i in range(5)]  # a space of its own
    rows += [(80, [1.0, 2.0, 3.0])]  # a single vector has no variance
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "vec_id long, embedding array<double>, x string, n string, component string")
    check(table, rows)
    check(table, rows, components=2)


def test_entries_beyond_every_long(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.5])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and {r.deviation for r in got if r.vec_id < 3} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5] * 4), (2, [0.5] * 4)]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() == []
