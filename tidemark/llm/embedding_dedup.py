"""Near-duplicate embeddings: all pairs by cosine, in PCA-ordered tiles.

Unit vectors are turned onto the principal axes of the table, so that the leading
dimensions hold most of every product. A tile of two blocks is compared in
steps: products over the leading dimensions first, plus the product of the two
suffix norms, bound the cosine; pairs whose bound is below the threshold stop
there. What is left after the last step is decided in double precision on the
vectors themselves. Bounds run in single precision with a margin.

Blocks are intervals of the first principal coordinate. Two unit vectors with
cosine t or more differ by sqrt(2 - 2 t) at most in any coordinate, so a block
meets only the blocks that are no farther than that; these pairs of blocks are
the tiles. An interval with very many vectors is split into several blocks.

A tile returns, per vector that has a link in it, the number of links and one link
towards its component within the tile, so a family of copies costs rows in
proportion to its members, never all pairs. Components of these links are those
of all links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored
from tidemark.llm.components import components
from tidemark.llm.vectors import finite, matrix

THRESHOLD = 0.9
BLOCK_BYTES = 4 << 20 # of a block of vectors in single precision
LANE = 2              # blocks that a task compares with one block
BINS = 4096           # intervals of the first coordinate
GROUPS = 64           # partial moments summed before the driver adds them
STEPS = (4, 2, 1)     # prefixes: a quarter, half, all of the dimensions
MARGIN = 1e-4         # of bounds in single precision
ROWS, COLUMNS = 1024, 2048
_DENSE = 0.1          # share of pairs above which a tile goes on as a matrix


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that makes the largest component about one; cosines stay exact."""
    top = np.abs(x).max(axis=1, initial=0.0, keepdims=True)
    return np.ldexp(x, -np.frexp(np.where(top > 0, top, 1.0))[1])


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(rows: DataFrame, dims: int) -> np.ndarray:
    """Axes of the unit vectors by falling second moment, as columns (dims x dims)."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dims, dims)), 0
        for batch in batches:
            u = _units(scaled(matrix(batch.column(0), dims)))
            total += u.T @ u
            seen += len(u)
        if seen:
            yield pa.record_batch([pa.array([seen % GROUPS], pa.int32()), pa.array([total.tobytes()])], ["g", "moments"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims * dims)
        for batch in batches:
            for part in batch.column("moments"):
                total += np.frombuffer(part.as_py())
        yield pa.record_batch([pa.array([0], pa.int32()), pa.array([total.tobytes()])], ["g", "moments"])

    schema = "g int, moments binary"
    parts = rows.select("vector").mapInArrow(moments, schema).repartition(GROUPS, "g").mapInArrow(add, schema)
    total = sum((np.frombuffer(bytes(r.moments)) for r in parts.collect()), np.zeros(dims * dims))
    return np.linalg.eigh(total.reshape(dims, dims))[1][:, ::-1]


def block_table(counts: dict[int, int], threshold: float, block: int) -> list[tuple[int, int, int, int]]:
    """(bin, first block, blocks, last block to meet) of every bin that has vectors.

    Small neighbouring bins share a block, a large bin has several.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    spans, at = [], []  # of each group of bins: its bins, first block, blocks
    size, start = 0, 0
    for b in sorted(counts):
        if at and size + counts[b] > block:
            spans.append((at, start, max(1, math.ceil(size / block))))
            start += spans[-1][2]
            at, size = [], 0
        at.append(b)
        size += counts[b]
    if at:
        spans.append((at, start, max(1, math.ceil(size / block))))
    width = 2 / BINS
    out = []
    far = 0
    for bins, first, n in spans:
        high = (bins[-1] + 1) * width + reach
        while far + 1 < len(spans) and spans[far + 1][0][0] * width <= high:
            far += 1
        out += [(b, first, n, spans[far][1] + spans[far][2] - 1) for b in bins]
    return out


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the components of linked positions; ``root`` holds the smallest position of each."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if np.array_equal(above, root):
                break
            root[:] = above


def _exact(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold in double precision."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    out = [np.einsum("ij,ij->i", x[i[at:at + 20_000]], y[j[at:at + 20_000]])
           / (nx[i[at:at + 20_000]] * ny[j[at:at + 20_000]]) >= threshold for at in range(0, len(i), 20_000)]
    return np.concatenate(out) if out else np.empty(0, bool)


def linked_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float,
                 same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of linked rows of two matrices, part by part; i < j if they are the same."""
    dims = axes.shape[0]
    u, v = ((_units(m) @ axes).astype(np.float32) for m in (x, y))
    ends = sorted({max(1, dims // s) for s in STEPS})
    rest = [[np.sqrt(np.maximum(0, (m[:, e:].astype(np.float64) ** 2).sum(1))).astype(np.float32) for e in ends] for m in (u, v)]
    least = np.float32(threshold - MARGIN)
    for r in range(0, len(u), ROWS):
        for c in range(r if same else 0, len(v), COLUMNS):
            a, b = slice(r, r + ROWS), slice(c, c + COLUMNS)
            product, i, j, start = None, None, None, 0
            for step, end in enumerate(ends):
                sa, sb = rest[0][step][a], rest[1][step][b]
                if i is None:
                    more = u[a, start:end] @ v[b, start:end].T
                    product = more if product is None else product + more
                    alive = product + sa[:, None] * sb[None, :] >= least
                    if same and c < r + ROWS:
                        alive &= np.arange(c, c + alive.shape[1])[None, :] > np.arange(r, r + alive.shape[0])[:, None]
                    if np.count_nonzero(alive) <= _DENSE * alive.size or step == len(ends) - 1:
                        i, j = np.nonzero(alive)
                        product = product[i, j]
                else:
                    product = product + np.einsum("ij,ij->i", u[a, start:end][i], v[b, start:end][j])
                    keep = product + sa[i] * sb[j] >= least
                    i, j, product = i[keep], j[keep], product[keep]
                if i is not None and not len(i):
                    break
                start = end
            if len(i):
                keep = _exact(x[a], y[b], i, j, threshold)
                yield i[keep] + r, j[keep] + c


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    block: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows``.

    n_links: other rows whose vectors are at ``threshold`` or more; component_id:
    smallest vec_id reachable by links, itself included; kept: whether that is its own.
    Vectors that are null, empty or zero, or hold null or non-finite components,
    link with nothing. Rows that repeat an id are vectors of their own. Rows without
    an id are compared too; their component is null if it holds no id, and they
    are not kept. Vectors of unequal lengths are compared as if the shorter ended in
    zeros. An empty table gives an empty result; other columns are not read.
    ``block``: rows of a block, by default as many as make up ``BLOCK_BYTES``.
    """
    # Stored, so that a row's key is the same for every later read.
    every = stored(rows.select(F.monotonically_increasing_id().alias("key"), F.col(vec_id).alias("vec_id"),
                               F.col(vector).cast("array<double>").alias("vector")))
    usable = every.where(finite("vector") & F.exists("vector", lambda x: x != 0)).select(F.col("key").alias("id"), "vector")
    found = stored(_tile_links(usable, threshold, block))
    counts = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    keyed = every.select("key", "vec_id")
    linked = (counts.select("id").join(roots, counts["id"] == roots["node"], "left")
              .select("id", F.coalesce("root", "id").alias("root")).join(keyed, F.col("id") == keyed["key"]))
    low = linked.groupBy("root").agg(F.min("vec_id").alias("low"))
    named = linked.join(low, "root").select(F.col("id").alias("member"), "low")
    known = keyed.join(counts, keyed["key"] == counts["id"], "left").join(named, keyed["key"] == named["member"], "left")
    component = F.coalesce(F.col("low"), F.col("vec_id"))
    return known.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _tile_links(once: DataFrame, threshold: float, block: int | None) -> DataFrame:
    """(id, links, root): per tile and row, its links there and one link to its component there."""
    schema = "id bigint, links bigint, root bigint"
    dims = once.agg(F.max(F.size("vector"))).first()[0]
    if not dims:
        return once.sparkSession.createDataFrame([], schema)
    block = block or max(1, BLOCK_BYTES // (4 * dims))
    axes = principal_axes(once, dims)
    shared = once.sparkSession.sparkContext.broadcast(axes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = _units(scaled(matrix(batch.column("vector"), dims))) @ shared.value[:, 0]
            bins = np.clip(np.floor((first + 1) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.record_batch([batch.column("id"), batch.column("vector"), pa.array(bins)], ["id", "vector", "bin"])

    placed = once.mapInArrow(place, T.StructType([*once.schema.fields, T.StructField("bin", T.IntegerType())]))
    counts = {r.bin: r["count"] for r in placed.groupBy("bin").count().collect()}  # at most BINS rows
    spans = block_table(counts, threshold, block)
    table = once.sparkSession.createDataFrame(spans, "bin int, first int, blocks int, last int")
    dealt = placed.join(F.broadcast(table), "bin").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int").alias("block"), "last", "id", "vector")

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # Scaled by a power of two, vectors of single precision stay what they are.
        data = scaled(matrix(list(frame["vector"]), dims))
        single = data.astype(np.float32)
        exact = bool((single == data).all())
        return pd.DataFrame({"block": [key[0]], "last": [key[1]], "ids": [frame["id"].to_numpy(np.int64).tobytes()],
                             "single": [exact], "data": [(single if exact else data).tobytes()]})

    packed = stored(dealt.groupBy("block", "last").applyInPandas(pack, "block int, last int, ids binary, single boolean, data binary"))
    # A block meets those after it within its reach, ``LANE`` of them in a task. Only the
    # numbers of the blocks are paired; a block is sent once per lane, and once per block before it.
    lane = F.floor((F.col("block") - F.col("own")) / LANE).cast("int").alias("lane")
    held = packed.select("*", F.col("block").alias("own"), F.explode(F.sequence(
        F.lit(0), F.floor((F.col("last") - F.col("block")) / LANE).cast("int"))).alias("lane"))
    pairs = packed.where(F.col("last") > F.col("block")).select(
        F.col("block").alias("own"), F.explode(F.sequence(F.col("block") + 1, F.col("last"))).alias("other"))
    met = packed.join(pairs, F.col("block") == F.col("other")).select(*packed.columns, "own", lane)
    reach = {b: last for _, first, n, last in spans for b in range(first, first + n)}
    tasks = sum((last - b) // LANE + 1 for b, last in reach.items())
    tiles = held.unionByName(met).repartition(max(1, tasks), "own", "lane").sortWithinPartitions("own", "lane", "block")

    def unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(row["ids"], np.int64)
        data = np.frombuffer(row["data"], np.float32 if row["single"] else np.float64)
        return ids, data.astype(np.float64).reshape(len(ids), dims)

    def compare(left: tuple, right: tuple | None) -> pa.RecordBatch:
        (left_ids, x), (right_ids, y) = left, right or left
        ids = np.concatenate([left_ids, right_ids]) if right else left_ids
        shift = len(left_ids) if right else 0
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for i, j in linked_pairs(x, y, shared.value, threshold, right is None):
            links += np.bincount(i, minlength=len(ids)) + np.bincount(j + shift, minlength=len(ids))
            unite(root, i, j + shift)
        has = links > 0
        return pa.record_batch([pa.array(ids[has]), pa.array(links[has]), pa.array(ids[root[has]])], ["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, left = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["own"] == row["block"]:
                    own, left = (row["own"], row["lane"]), unpack(row)
                    if row["lane"] == 0:
                        yield compare(left, None)
                elif own == (row["own"], row["lane"]):
                    yield compare(left, unpack(row))

    return tiles.mapInArrow(run, schema)
