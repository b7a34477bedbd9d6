"""Source mixing and hash-tree sharding."""

import math
import zlib
from collections import Counter

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_tables import SMOKE, awkward, documents, empty  # noqa: F401
from presslens.llm import mixing, sharding


def water_fill(sizes, weights, most):
    """Share the whole by weight, cap, and reshare what is over, round by round."""
    target, free, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while free and left > 1e-9:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total >= most * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 3, "d": 500, None: 7}, {"a": 0, "b": 5}, {"a": 0}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(table).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    expected = water_fill(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}, mixing.MOST_COPIES)
    assert got == pytest.approx(expected)


def test_mix_comes_near_its_targets(spark):
    df = E.queries()["op1_source_mixing"](spark, "/root/testdata/sf0.01")
    taken = df.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("largest"))
    for r in taken.collect():
        assert abs(r.taken - r.target) <= r.largest + 1
    assert df.filter("taken > 3 * size").count() == 0


def test_mix_repeats_rows_as_planned(awkward, empty):
    plan = Counter()
    for r in mixing.copies(awkward).collect():
        plan[(r.doc_id, r.source, r.digest)] += r.copies
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    got = Counter((r.doc_id, r.source, r.h) for r in mixed.select("*", F.xxhash64("text").alias("h")).collect())
    assert got == +plan
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(awkward).collect()))
    assert mixing.copies(empty).count() == mixing.mix(empty).count() == 0


def brute_shard(doc_id, tree, seed="shards"):
    key = "null" if doc_id is None else f"#{doc_id}"

    def pick(place, weights):
        draws = []
        for i, w in enumerate(weights):
            if w > 0:
                h = xxhash.xxh64_intdigest(key, xxhash.xxh64_intdigest(f"{place}/{i}", 42))
                draws.append((-math.log(((h >> 11) + 0.5) / (1 << 53)) / w, i))
        return min(draws)[1]

    sums = [[sum(w for _, w in rack) for rack in region] for region in tree]
    region = pick(seed, [sum(r) for r in sums])
    rack = pick(f"{seed}/{region}", sums[region])
    leaf = tree[region][rack]
    return leaf[pick(f"{seed}/{region}/{rack}", [w for _, w in leaf])][0]


TREES = [sharding.even_tree(16), sharding.even_tree(17), [[[(0, 1.0), (1, 3.0)], [(2, 2.0)]], [[(3, 0.0), (4, 5.0)]]]]


@pytest.mark.parametrize("tree", TREES)
def test_shard_against_brute_force(documents, tree):
    table = documents([(i, "x") for i in range(400)] + [(None, "x")])
    got = table.select("doc_id", sharding.shard_of("doc_id", tree).alias("shard")).collect()
    assert all(r.shard == brute_shard(r.doc_id, tree) for r in got)


def test_weights_are_met_and_movement_is_confined(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "doc_id")
    tree, heavier = TREES[2], [[[(0, 1.0), (1, 3.0)], [(2, 4.0)]], [[(3, 0.0), (4, 5.0)]]]
    moved = ids.select(sharding.shard_of("doc_id", tree).alias("a"), sharding.shard_of("doc_id", heavier).alias("b")).groupBy("a", "b").count().collect()
    share = Counter()
    for r in moved:
        share[r.a] += r["count"] / 40_000
        assert r.a == r.b or r.b == 2 or (r.a == 4 and r.b in (0, 1))  # only into the subtree that grew
    assert all(abs(share[s] - w / 11) < 0.02 for s, w in ((0, 1), (1, 3), (2, 2), (4, 5)))


def test_sharding_query(spark):
    sf = SMOKE
    got = E.queries()["op8_hash_tree_sharding"](spark, sf).collect()
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    slots = {}
    for r in got:
        blob = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(blob) + 1, zlib.crc32(blob), "key")
        assert r.grown_shard in (r.shard, 16)
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_of_awkward_rows(awkward, empty):
    tree = sharding.even_tree(4)
    got = sharding.shards(awkward, tree).collect()
    assert len(got) == 11 and {r.size for r in got if r.doc_id in (1, 2)} == {1}
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert sharding.shards(empty, tree).count() == 0
