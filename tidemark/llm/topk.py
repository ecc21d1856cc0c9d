"""Exact top-k search by integer inner products.

Candidates are dealt into shards and queries into blocks of bounded bytes, each packed
as one matrix. Every shard meets every block of queries (a stated query set
against all rows, in tiles): a tile is one matrix product with a partial
selection per query, which leaves at most k candidates of a query. The lists are
merged as a tree: first in the task that meets a lane of shards, then among the lanes
of a group, then over the groups, so that no task holds the lists of many tiles.

Products are exact: single or double precision is used only where every
partial sum is an integer that it represents; beyond, Python integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import BLOCK_BYTES, LANE, Block, blocks, lanes, read_block, rows_of_vectors

SCALE = 64
K = 20
STRIP = 128           # queries of a block that are multiplied at once
FAN = 16              # lanes whose lists are merged at once


def quantised(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as doubles, which are integers."""
    return np.floor(scale * vectors)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two integer-valued matrices, saturated at +-(2^63 - 1)."""
    bound = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(1, a.shape[1])
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.clip(exact, 1 - (1 << 63), (1 << 63) - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, best first, ties to the smaller id."""
    if len(scores) > k:
        bound = -np.partition(-scores, k - 1)[k - 1]
        keep = np.flatnonzero(scores > bound)
        ties = np.flatnonzero(scores == bound)
        if len(ties) > k - len(keep):
            ties = ties[np.argpartition(ids[ties], k - len(keep) - 1)[:k - len(keep)]]
        keep = np.concatenate([keep, ties])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))]


class _Lists:
    """The best candidates so far of every query of a block."""

    def __init__(self, k: int):
        self.k = k

    def start(self, row: dict) -> dict:
        queries = read_block(row)
        return {"queries": queries, "lane": row["lane"], "best": [None] * len(queries.keys)}

    def meet(self, held: dict, shard: Block) -> None:
        queries = held["queries"]
        for at in range(0, len(queries.keys), STRIP):
            scores = products(queries.data[at:at + STRIP], shard.data)
            for i, line in enumerate(scores, at):
                keep = best(line, shard.orders, self.k + 1)
                keep = keep[shard.keys[keep] != queries.keys[i]][:self.k]
                found = line[keep], shard.orders[keep], shard.named[keep]
                if held["best"][i] is not None:
                    found = tuple(np.concatenate(c) for c in zip(held["best"][i], found))
                    keep = best(found[0], found[1], self.k)
                    found = tuple(c[keep] for c in found)
                held["best"][i] = found

    def result(self, held: dict) -> pa.RecordBatch:
        queries, lists = held["queries"], held["best"]
        met = [i for i, found in enumerate(lists) if found is not None]
        sizes = [len(lists[i][0]) for i in met]
        score, order, named = (np.concatenate([lists[i][c] for i in met]) if met else np.empty(0, np.int64) for c in range(3))
        return pa.record_batch([
            pa.array(np.repeat(queries.keys[met], sizes), pa.int64()), pa.array(np.repeat(queries.orders[met], sizes), pa.int64()),
            pa.array(order, pa.int64(), mask=~named.astype(bool)), pa.array(score, pa.int64()),
            pa.array(np.full(len(score), held["lane"]), pa.int32())], ["query", "query_id", "vec_id", "score", "g"])


def top_k(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", modulus: int = 20, k: int = K,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row whose id is divisible by ``modulus``.

    A row is no candidate of itself; ties go to the smaller id; fewer than k
    candidates give fewer rows. Vectors that are null or hold null or non-finite
    components take no part. Rows that repeat an id are rows of their own, as queries
    and as candidates; rows without an id are candidates, last among ties, and their id is
    null in the result. Vectors of unequal lengths are compared as if the shorter ended
    in zeros. Scores are exact and saturate at +-(2^63 - 1). An empty table gives an
    empty result; other columns are not read.
    """
    table = stored(rows_of_vectors(rows, vec_id, vector))
    is_query = F.col("named") & (F.col("order") % modulus == 0)
    size = table.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"),
                     F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dims")).first()
    shards, n_shards = blocks(table, size.n, size.dims, 1, block_bytes, quantised)
    queries, n_queries = blocks(table.where(is_query), size.q, size.dims, 0, block_bytes, quantised)
    lists = lanes(queries, n_queries, shards, n_shards, _Lists(k),
                  "query bigint, query_id bigint, vec_id bigint, score bigint, g int")
    groups, order = math.ceil(n_shards / LANE), (F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    while groups > FAN:
        groups = math.ceil(groups / FAN)
        lists = lists.withColumn("g", F.floor(F.col("g") / FAN))
        ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query", "g").orderBy(*order)))
        lists = ranked.where(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return (lists.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
