"""Hard-negative mining: rows that score close to an anchor's positives but have another label.

An anchor's positives are its best rows of the same label; the hard negatives of an
anchor and a positive are the best rows of other labels whose score lies in a
window below the positive's score. Scores are inner products of integer
vectors, floor(scale * x).

Anchors and candidates are packed into blocks of bounded bytes. A tile, a block of
anchors against a block of candidates, is one integer matrix product by
Strassen's recursion: each level pads odd sides with zeros, splits both matrices in
four and replaces eight products by seven and exact integer additions. Wrapped
additions of 64-bit integers cancel out, so a product is right whenever the final
inner products fit; where a bound says that they might not, the same recursion
runs on Python integers.

Two passes over the tiles fill heaps of fixed size: per anchor the best positives,
then, with their scores known, per anchor and positive the best rows of the
window. A task meets a run of candidate blocks (a lane) with one block of
anchors, keeps one heap for all of them, and passes only its heap on; the heaps
of the lanes are merged by a ranked window, whose group limit cuts lists before
they are shuffled. A label or a group of copies may hold any share of the rows:
nothing is grouped by label.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import BLOCK_BYTES, ROW, Block, blocks, lanes, read_block, rows_of_vectors

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
WINDOW = (80, 100)            # a negative scores this share of the positive's score, in percent
LEAF = 32                     # side at which the recursion multiplies directly
STRIP = 256                   # anchors of a block that are multiplied at once
MOST = (1 << 63) - 1

def _padded(m: np.ndarray) -> np.ndarray:
    """A matrix with even sides: odd ones end in zeros."""
    rows, columns = m.shape
    if not rows % 2 and not columns % 2:
        return m
    out = np.zeros((rows + rows % 2, columns + columns % 2), m.dtype)
    out[:rows, :columns] = m
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices (int64, modulo 2^64, or Python integers)."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b if inner else np.zeros((rows, columns), a.dtype)
    a, b = _padded(a), _padded(b)
    r, i, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b11, b12, b21, b22 = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * c), a.dtype)
    out[:r, :c] = m1 + m4 - m5 + m7
    out[:r, c:] = m3 + m5
    out[r:, :c] = m2 + m4
    out[r:, c:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer-valued double matrices, saturated at +-(2^63 - 1)."""
    bound = float(np.abs(a).max(initial=0.0)) * float(np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if bound < 2.0 ** 62:
        return strassen(a.astype(np.int64), b.astype(np.int64).T)
    whole = np.vectorize(int, otypes=[object])
    exact = strassen(whole(a), whole(b).T) if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.clip(exact, -MOST, MOST).astype(np.int64)


class Heap:
    """The ``most`` best (score, id, key) seen: high scores first, then small ids, then small keys."""

    def __init__(self, most: int):
        self.most, self.rows = most, []  # a binary heap, its worst entry on top

    def push(self, score: int, order: int, key: int, named: bool) -> None:
        entry = (score, -order, -key, named)
        if len(self.rows) < self.most:
            heapq.heappush(self.rows, entry)
        elif entry > self.rows[0]:
            heapq.heapreplace(self.rows, entry)

    def merge(self, scores: np.ndarray, orders: np.ndarray, keys: np.ndarray, named: np.ndarray, at: np.ndarray) -> None:
        """Push the candidates at positions ``at``, after those that cannot enter are left out."""
        line = scores[at]
        if len(self.rows) == self.most:
            at, line = at[line >= self.rows[0][0]], line[line >= self.rows[0][0]]
        if len(at) > self.most:
            bound = np.partition(line, len(line) - self.most)[len(line) - self.most]
            above, ties = at[line > bound], at[line == bound]
            # Of the ties, only the smallest ids (and keys) can enter.
            ties = ties[np.lexsort((keys[ties], orders[ties]))][:self.most]
            at = np.concatenate([above, ties])
        for i in at:
            self.push(int(scores[i]), int(orders[i]), int(keys[i]), bool(named[i]))


class _Work:
    """Heaps of a block of anchors: one per anchor, or one per anchor and positive."""

    def __init__(self, most: int, window: tuple[int, int] | None = None):
        self.most, self.window = most, window

    def start(self, row: dict) -> dict:
        anchors = read_block(row)
        slots = [len(s) for s in anchors.scores] if self.window else [1] * len(anchors.keys)
        return {"anchors": anchors, "heaps": [[Heap(self.most) for _ in range(s)] for s in slots]}

    def meet(self, held: dict, candidates: Block) -> None:
        own, a = held["anchors"], held["anchors"].data
        keys, orders, named, labels = candidates.keys, candidates.orders, candidates.named, candidates.labels
        for at in range(0, len(a), STRIP):
            products = inner_products(a[at:at + STRIP], candidates.data)
            for i, line in enumerate(products, at):
                if self.window is None:
                    rows = np.flatnonzero((labels == own.labels[i]) & (keys != own.keys[i]))
                    held["heaps"][i][0].merge(line, orders, keys, named, rows)
                    continue
                other = labels != own.labels[i]
                for heap, score in zip(held["heaps"][i], own.scores[i].tolist()):
                    if score < 0:       # no score is at least 80 % of it and at most all of it
                        continue
                    low, high = self.window
                    least = -(-low * score // high)
                    heap.merge(line, orders, keys, named, np.flatnonzero(other & (line >= least) & (line <= score)))

    def result(self, held: dict) -> pa.RecordBatch:
        rows = [(int(key), slot, -k, -o if named else None, score)
                for key, heaps in zip(held["anchors"].keys, held["heaps"]) for slot, heap in enumerate(heaps)
                for score, o, k, named in heap.rows]
        columns = list(zip(*rows)) or [[]] * 5
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["anchor", "slot", "key", "id", "score"])


def _best(lists: DataFrame, most: int) -> DataFrame:
    order = (F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("key"))
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*order))
    return lists.withColumn("rank", rank).where(F.col("rank") <= most)


def mine(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", modulus: int = 100,
         positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: int = SCALE,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Anchors are the rows whose id is divisible by ``modulus``, candidates all rows
    but the anchor's own. Rows without a label or a vector, or with a null or
    non-finite component, take no part. Rows that repeat an id are rows of their
    own; rows without an id are candidates, last among ties, and their id is null in
    the result. Ties that are left go by the order in which rows were read.
    Vectors of unequal lengths are compared as if the shorter ended in zeros; an
    empty vector scores 0. Scores are exact and saturate at +-(2^63 - 1). An anchor
    without a positive, or a positive with an empty window, has no rows; an empty
    table gives an empty result. Other columns are not read.
    """
    schema = "anchor bigint, slot int, key bigint, id bigint, score bigint"
    table = stored(rows_of_vectors(rows.where(F.col(label).isNotNull()), vec_id, vector, F.col(label)))
    is_anchor = F.col("named") & (F.col("order") % modulus == 0)
    size = table.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"),
                     F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dims")).first()

    def packed(part: DataFrame, count: int, side: int) -> tuple[DataFrame, int]:
        return blocks(part, count, size.dims, side, block_bytes, lambda data: np.floor(scale * data))

    candidates, n_candidates = packed(table, size.n, 1)
    anchors = table.where(is_anchor)
    first, n_first = packed(anchors, size.anchors, 0)
    found = stored(_best(lanes(first, n_first, candidates, n_candidates, _Work(positives), schema), positives)
                   .select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score")))
    # At most ``positives`` scores per anchor, in the order of their slots.
    lists = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("s"))
    scored = anchors.drop("scores").join(lists, anchors["key"] == lists["anchor"]).withColumn("scores", F.col("s.positive_score"))
    second, n_second = packed(scored.select(*ROW), size.anchors, 0)
    near = _best(lanes(second, n_second, candidates, n_candidates, _Work(negatives, window), schema), negatives)
    ids = anchors.select(F.col("key").alias("anchor"), F.col("order").alias("anchor_id"))
    return (near.join(found, ["anchor", "slot"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
