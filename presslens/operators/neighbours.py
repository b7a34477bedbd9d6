"""Exact top-k cosine neighbours within a blocking key.

Vectors of one block are cut into hash tiles of about ``tile`` vectors, or of
more where that would give a block over ``TILES`` of them: each vector is sent to
every tile of its block, so what is shuffled grows with the table and not with
its square. Only tiles that would exceed ``LARGEST`` vectors are cut further.
Every (query tile, candidate tile) pair of a block is one row carrying both tiles;
a vectorised task multiplies the two tiles (numpy, float64), ``CHUNK`` queries at
a time, and keeps only the k best candidates per query vector. Per query the
k x n_tiles survivors are reduced to the final top k. Row pairs are never
materialised, a hot block is spread over n_tiles^2 independent pairs, and no task
holds more than the tiles of one Arrow batch.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.operators.topk import top_k_per_group

#: tiles of a block, vectors of a tile beyond which there may be more tiles, queries multiplied at once
TILES, LARGEST, CHUNK = 24, 8192, 256
PAIR_SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("neighbour_id", T.LongType()),
    T.StructField("similarity", T.DoubleType()),
])


def _tile_topk(k: int):
    """Per (query tile, candidate tile) row: all similarities as one matrix
    product, then the k best candidates per query row, ordered by similarity
    descending and candidate id ascending (one lexsort along the rows)."""
    def fn(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                q_ids = np.asarray(row.q_ids, dtype=np.int64)
                c_ids = np.asarray(row.c_ids, dtype=np.int64)
                q = np.vstack(row.q_vecs).astype(np.float64)
                c = np.vstack(row.c_vecs).astype(np.float64)
                for first in range(0, len(q), CHUNK):
                    some = q_ids[first:first + CHUNK]
                    sims = q[first:first + CHUNK] @ c.T
                    sims[some[:, None] == c_ids[None, :]] = -np.inf  # never its own neighbour
                    ids = np.broadcast_to(c_ids, sims.shape)
                    order = np.lexsort((ids, -sims), axis=1)[:, :min(k, len(c_ids))]
                    top_sims = np.take_along_axis(sims, order, axis=1)
                    keep = np.isfinite(top_sims)
                    out.append(pd.DataFrame({
                        "vec_id": np.repeat(some, order.shape[1])[keep.ravel()],
                        "neighbour_id": c_ids[order][keep],
                        "similarity": top_sims[keep],
                    }))
            yield (pd.concat(out, ignore_index=True) if out
                   else pd.DataFrame({"vec_id": pd.Series([], dtype="int64"),
                                      "neighbour_id": pd.Series([], dtype="int64"),
                                      "similarity": pd.Series([], dtype="float64")}))
    return fn


def neighbours_topk(vectors: DataFrame, k: int = 5, block: str = "label", id_col: str = "vec_id",
                    vec: str = "embedding", tile: int = 256) -> DataFrame:
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(block).alias("block"),
                       F.col(vec).cast("array<double>").alias("v"))
    norm = F.sqrt(F.aggregate(F.col("v"), F.lit(0.0), lambda acc, x: acc + x * x))
    # no direction, no neighbours: null, zero and non-finite vectors take no part
    v = v.withColumn("norm", norm).filter((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    v = v.withColumn("v", F.transform("v", lambda x: x / F.col("norm"))).drop("norm")
    size = F.count(F.lit(1))
    count = F.greatest(F.least(F.ceil(size / tile), F.lit(TILES)), F.ceil(size / max(tile, LARGEST)), F.lit(1))
    n_tiles = v.groupBy("block").agg(count.cast("int").alias("n_tiles"))
    v = v.join(n_tiles, "block").withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.col("n_tiles")).cast("int"))
    tiles = v.groupBy("block", "tile", "n_tiles").agg(F.collect_list("vec_id").alias("ids"),
                                                      F.collect_list("v").alias("vecs"))
    # each candidate tile is sent once to every query tile of its block
    cand = tiles.select("block", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("tile"),
                        F.col("ids").alias("c_ids"), F.col("vecs").alias("c_vecs"))
    pairs = tiles.select("block", "tile", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")) \
        .join(cand, ["block", "tile"])
    partial = pairs.mapInPandas(_tile_topk(k), PAIR_SCHEMA)
    ranked = top_k_per_group(partial, ["vec_id"], [F.desc("similarity"), F.asc("neighbour_id")], k, rank_col="rank")
    return ranked.select("vec_id", "neighbour_id", F.col("rank").cast("bigint").alias("rank"), "similarity")
