"""Exact top-k search: tiled matrix products, a partial selection per tile, and a tree of merges."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 5
SCALE = 256
TILE_BYTES = 32 << 20
FAN_IN = 64
EXACT = 2.0 ** 53

FOUND = pa.schema([("query_id", pa.int64()), ("shard", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "query_id long, shard long, vec_id long, score long"


def whole_vector(vector: Column) -> Column:
    """Not null and without null, NaN or infinite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector.cast("array<double>"), finite), F.lit(False))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, tile_bytes: int = TILE_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each row of ``queries``, itself excepted.

    Components become ``floor(scale * x)``, so scores are exact integers (clipped to a long). Queries and vectors
    are dealt to blocks of at most ``tile_bytes``; every pair of blocks is a tile, computed in strips of a bounded
    size, that gives each of its queries ``k`` rows. Lists of ``fan_in`` shards merge at a time until one is left.

    Vectors that are null or hold null or non-finite components, and rows with a null id, take no part. Only
    vectors of equal length are compared. Equal scores go to the smaller id. Repeated rows are candidates of their
    own; a query id that occurs more than once is answered for its smallest vector. Fewer than ``k`` candidates give
    as many rows; empty tables give none. Only the two named columns are read.
    """
    def prepared(df: DataFrame) -> DataFrame:
        valid = df.where(F.col(id_col).isNotNull() & whole_vector(F.col(vector_col)))
        whole = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
        return valid.select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))

    rows, asked = prepared(vectors), prepared(queries).groupBy("id").agg(F.min("v").alias("v"))
    size = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    block = max(256, tile_bytes // (8 * max(1, size[1] or 1)))
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, math.ceil(size[0] / block), min(2 * parallel, math.ceil(size[0] / 2048)))
    blocks = max(1, math.ceil(asked.count() / block))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = asked.select("id", "v", F.size("v").alias("d"), dealt(blocks).alias("block"), spread(shards).alias("shard"))
    right = rows.select("id", "v", F.size("v").alias("d"), dealt(shards).alias("shard"), spread(blocks).alias("block"))

    def tile(key: tuple, q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return FOUND.empty_table()
        return _best(q, c, k, key[1].as_py())

    found = (left.groupBy("block", "shard", "d").cogroup(right.groupBy("block", "shard", "d")).applyInArrow(tile, FOUND_DDL))
    best = Window.partitionBy("query_id", "shard").orderBy(F.col("score").desc(), "vec_id")
    while shards > 1:
        shards = math.ceil(shards / fan_in)
        found = (found.withColumn("shard", F.floor(F.col("shard") / fan_in))
                 .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank"))
    return found.withColumn("rank", F.row_number().over(best)).select("query_id", "rank", "vec_id", "score")


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, in the order of ids."""
    ids = table["id"].to_numpy()
    flat = table["v"].combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int64)
    order = np.argsort(ids, kind="stable")
    return ids[order], values.reshape(len(ids), -1)[order]


def _best(q: pa.Table, c: pa.Table, k: int, shard: int, strip: int = 256, run: int = 8192) -> pa.Table:
    q_ids, q_rows = _matrix(q)
    c_ids, c_rows = _matrix(c)
    largest = lambda m: float(np.abs(m.astype(np.float64)).max()) if m.size else 0.0
    exact = largest(q_rows) * largest(c_rows) * max(1, q_rows.shape[1]) * run < EXACT
    kind = np.float64 if exact else object  # Python's integers where a product might not be exact
    out: list[list] = [[], [], []]
    for a in range(0, len(q_ids), strip):
        ids = q_ids[a:a + strip]
        rows = q_rows[a:a + strip].astype(kind)
        top_s = np.zeros((len(ids), 0), np.int64)
        top_i = np.zeros((len(ids), 0), np.int64)
        top_ok = np.zeros((len(ids), 0), bool)
        for b in range(0, len(c_ids), run):
            there = c_ids[b:b + run]
            scores = rows @ c_rows[b:b + run].astype(kind).T
            if not exact:
                scores = np.clip(scores, -(1 << 63), (1 << 63) - 1)
            scores = scores.astype(np.int64)
            own = (np.searchsorted(there, ids, "left"), np.searchsorted(there, ids, "right"))
            allowed = np.ones(scores.shape, bool)
            for i in np.flatnonzero(own[1] > own[0]):
                allowed[i, own[0][i]:own[1][i]] = False
            keep = _selected(scores, allowed, k, exact)
            top_s = np.concatenate([top_s, np.take_along_axis(scores, keep, 1)], 1)
            top_i = np.concatenate([top_i, there[keep]], 1)
            top_ok = np.concatenate([top_ok, np.take_along_axis(allowed, keep, 1)], 1)
            order = np.lexsort((top_i, ~top_s, ~top_ok), axis=1)[:, :k]
            top_s, top_i, top_ok = (np.take_along_axis(x, order, 1) for x in (top_s, top_i, top_ok))
        out[0].append(np.repeat(ids, top_s.shape[1])[top_ok.ravel()])
        out[1].append(top_i[top_ok])
        out[2].append(top_s[top_ok])
    query, vec, score = (np.concatenate(x).astype(np.int64) for x in out)
    return pa.Table.from_arrays([pa.array(query), pa.array(np.full(len(query), shard, np.int64)), pa.array(vec), pa.array(score)], schema=FOUND)


def _selected(scores: np.ndarray, allowed: np.ndarray, k: int, exact: bool) -> np.ndarray:
    """Columns of the ``k`` best of each row; columns are in the order of ids."""
    n = scores.shape[1]
    if n <= k:
        return np.broadcast_to(np.arange(n), scores.shape)
    if exact:
        ranked = np.where(allowed, scores * n + (n - 1 - np.arange(n)), np.iinfo(np.int64).min)
        return np.argpartition(ranked, n - k, axis=1)[:, n - k:]
    return np.lexsort((np.broadcast_to(np.arange(n), scores.shape), ~scores, ~allowed), axis=1)[:, :k]
