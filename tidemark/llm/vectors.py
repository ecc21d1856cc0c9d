"""Blocks of vectors: rows of a table packed into matrices that tasks multiply.

Rows are told apart by a key of their own, whatever their ids: they may repeat an id
or have none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

def finite(vector: str = "embedding") -> Column:
    """Whether a vector is there, and has neither null nor non-finite components."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad, F.lit(False))


def matrix(vectors: pa.Array | list, dims: int) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros."""
    if isinstance(vectors, pa.Array):
        lengths = np.diff(vectors.offsets.to_numpy())
        if len(lengths) and (lengths == dims).all():
            return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
        vectors = vectors.to_pylist()
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


# ---------------------------------------------------------------- a stated set of rows against all rows

BLOCK_BYTES = 4 << 20         # of a packed block
LANE = 8                      # blocks of one side that a task meets with one block of the other
NO_ID = (1 << 63) - 1         # the place of rows without an id among ties: last
ROW = ("key", "order", "named", "label", "vector", "scores")
_BLOCK = "at int, side int, dims int, keys binary, orders binary, named binary, labels binary, data binary, scores binary"


@dataclass
class Block:
    keys: np.ndarray
    orders: np.ndarray        # ids, or NO_ID
    named: np.ndarray         # whether there is an id
    labels: np.ndarray
    data: np.ndarray
    scores: list[np.ndarray]


def rows_of_vectors(rows: DataFrame, vec_id: str, vector: str, label: Column | None = None) -> DataFrame:
    """The usable rows as (key, order, named, label, vector, scores). Keys are unique; store the
    rows before they are read twice, so that they stay the same."""
    key = F.col(vec_id).cast("bigint")
    return rows.where(finite(vector)).select(
        F.monotonically_increasing_id().alias("key"), F.coalesce(key, F.lit(NO_ID)).alias("order"),
        key.isNotNull().alias("named"), (F.lit(0) if label is None else label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), F.array().cast("array<bigint>").alias("scores"))


def blocks(rows: DataFrame, count: int, dims: int, side: int, block_bytes: int,
           change: Callable[[np.ndarray], np.ndarray]) -> tuple[DataFrame, int]:
    """``count`` rows of ``rows_of_vectors`` as one stored row per block, and the number of blocks, which
    have about ``block_bytes`` each whatever the dimensions. ``change`` is applied to the matrices."""
    number = max(1, math.ceil(count * 8 * max(1, dims) / block_bytes))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        scores = [np.asarray(s, np.int64) for s in frame["scores"]]
        lengths = np.array([len(s) for s in scores], np.int32)
        columns = {"keys": frame["key"].to_numpy(np.int64), "orders": frame["order"].to_numpy(np.int64),
                   "named": frame["named"].to_numpy(bool), "labels": frame["label"].to_numpy(np.int64),
                   "data": change(matrix(list(frame["vector"]), dims))}
        return pd.DataFrame({"at": [key[0]], "side": [side], "dims": [dims], **{n: [c.tobytes()] for n, c in columns.items()},
                             "scores": [lengths.tobytes() + b"".join(s.tobytes() for s in scores)]})

    dealt = rows.withColumn("at", F.pmod(F.xxhash64("key"), F.lit(number)).cast("int"))
    return stored(dealt.groupBy("at").applyInPandas(pack, _BLOCK)), number


def read_block(row: dict) -> Block:
    keys = np.frombuffer(row["keys"], np.int64)
    lengths = np.frombuffer(row["scores"][:4 * len(keys)], np.int32)
    scores = np.split(np.frombuffer(row["scores"][4 * len(keys):], np.int64), np.cumsum(lengths)[:-1])
    return Block(keys, np.frombuffer(row["orders"], np.int64), np.frombuffer(row["named"], bool),
                 np.frombuffer(row["labels"], np.int64), np.frombuffer(row["data"]).reshape(len(keys), row["dims"]), scores)


def lanes(left: DataFrame, n_left: int, right: DataFrame, n_right: int, work, schema: str) -> DataFrame:
    """Every block of ``left`` (side 0) meets every block of ``right`` (side 1).

    A task holds one block of ``left`` and meets ``LANE`` blocks of ``right`` with it, one after
    the other, so a left block is sent once per lane and not once per tile, and a
    task's memory is bounded by the bytes of a lane. ``work``: ``start(row)`` returns
    what is held for a left block, ``meet(held, block)`` takes a right one, ``result(held)``
    gives the lane's rows.
    """
    number = math.ceil(n_right / LANE)
    own = left.select("*", F.col("at").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("lane"))
    others = right.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))).alias("own"),
                          F.floor(F.col("at") / LANE).cast("int").alias("lane"))
    dealt = (own.unionByName(others).repartition(n_left * number, "own", "lane")
             .sortWithinPartitions("own", "lane", "side", "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, met = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["side"] == 0:
                    if held is not None:
                        yield work.result(held)
                    held, met = work.start(row), (row["own"], row["lane"])
                elif met == (row["own"], row["lane"]):
                    work.meet(held, read_block(row))
        if held is not None:
            yield work.result(held)

    return dealt.mapInArrow(run, schema)
