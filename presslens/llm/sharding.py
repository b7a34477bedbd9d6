"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A document descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the child's place in the tree and the
document's id, and the smallest draw wins (weighted rendezvous). A child's
chance is its share of its siblings' weight, and a draw depends on nothing but
the child and its own weight: when weights change, documents move only into or
out of the subtrees whose weight changed. A shard that opens a region of its
own therefore takes documents only into itself.

Defined results: a null id is a key of its own; a null text counts as empty;
repeated rows share a shard and get slots of their own, in order of id, checksum
and size; of equal draws the first child wins; texts of any length count whole;
an empty table gives an empty result; other columns are not read, so their names
can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.shared import running_totals

#: regions -> racks -> (shard, weight)
Tree = list[list[list[tuple[int, float]]]]


def even_tree(shards: int, racks: int = 2, per_rack: int = 4) -> Tree:
    """Equal shards in regions of ``racks`` x ``per_rack``; a shard beyond full regions opens the next one."""
    ids = list(range(shards))
    slots = [ids[i : i + per_rack] for i in range(0, shards, per_rack)]
    return [[[(s, 1.0) for s in rack] for rack in slots[i : i + racks]] for i in range(0, len(slots), racks)]


def _nested(values) -> Column:
    return F.array(*[_nested(v) if isinstance(v, list) else F.lit(v) for v in values])


def _descend(weights: Column, place: Column, key: Column) -> Column:
    """Index of the winning child among ``weights`` of the node at ``place``."""

    def draw(weight: Column, i: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.concat_ws("/", place, i.cast("string")), key), 11)
        u = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.when(weight > 0, F.struct((-F.ln(u) / weight).alias("draw"), i.alias("child")))

    return F.array_min(F.transform(weights, draw))["child"]


def shard_of(id_col: str, tree: Tree, seed: str = "shards") -> Column:
    """Shard of a row: three weighted draws, each among the children of one node."""
    key = F.coalesce(F.concat(F.lit("#"), F.col(id_col).cast("string")), F.lit("null"))
    rack_sum = [[sum(w for _, w in rack) for rack in region] for region in tree]
    region = _descend(_nested([float(sum(r)) for r in rack_sum]), F.lit(seed), key)

    def inside(region_at: Column) -> Column:
        here = F.concat_ws("/", F.lit(seed), region_at.cast("string"))
        rack = _descend(F.get(_nested([[float(w) for w in r] for r in rack_sum]), region_at), here, key)
        return F.struct(region_at.alias("region"), rack.alias("rack"))

    def leaf(at: Column) -> Column:
        here = F.concat_ws("/", F.lit(seed), at["region"].cast("string"), at["rack"].cast("string"))
        weights = F.get(F.get(_nested([[[float(w) for _, w in rack] for rack in r] for r in tree]), at["region"]), at["rack"])
        ids = F.get(F.get(_nested([[[s for s, _ in rack] for rack in r] for r in tree]), at["region"]), at["rack"])
        return F.get(ids, _descend(weights, here, key))

    # a one-element array binds each level's outcome once
    racks = F.transform(F.array(region), inside)
    return F.get(F.transform(racks, leaf), F.lit(0))


def shards(
    df: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text", seed: str = "shards"
) -> DataFrame:
    """Placement of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` numbers a shard's documents from 0 in id order; ``grown_shard`` is
    the shard under the tree ``grown``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(id_col, tree, seed).alias("shard"),
        (shard_of(id_col, grown, seed) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return running_totals(placed, ["shard"], order, rank="slot", name="shards")
