"""Word frequencies: of a corpus, and of each document joined with a word table.

A word is a run of bytes without white space (0x20, 0x09-0x0D).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import _SPACE, content_key

FLUSH = 300_000       # distinct words that a task holds before passing them on
TEXT = 1 << 22        # bytes of text that a task splits at once
ROWS = 50_000         # rows of a batch that a task passes on
_STEP = 1.02          # ratio of neighbouring frequency classes


def _bytes(column: pa.Array) -> pa.Array:
    column = column.cast(pa.large_binary())
    return pc.fill_null(column, b"") if column.null_count else column


def _split(data: np.ndarray, ends: np.ndarray, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """The words of texts that lie one after the other in ``data``, and how many each has; text i ends at ``ends[i]``."""
    if lower:
        data = data | ((data - 65 < 26).view(np.uint8) << 5)
    solid = (data != 0x20) & (data - 9 >= 5)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = np.concatenate([[0], ends[:-1]])
    begins = begins[begins < len(data)]
    first[begins] = solid[begins]
    numbers = np.diff(np.searchsorted(np.flatnonzero(first), ends), prepend=0)
    kept = data[solid]
    offsets = np.append(np.flatnonzero(first[solid]), len(kept)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers), numbers


def words_of(texts: pa.Array, lower: bool) -> Iterator[tuple[pa.Array, np.ndarray, bool]]:
    """The words of texts in order, about ``TEXT`` bytes of text at a time; a null text is empty.

    Yields (words, number of words of each text, True). A longer text comes alone
    in pieces, cut at white space, of which all but the last say False.
    """
    texts = _bytes(texts)
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        begin = offsets[at]
        upto = max(at + 1, int(np.searchsorted(offsets, begin + TEXT, "right")) - 1)
        if upto == at + 1:
            while offsets[upto] - begin > TEXT and (found := _SPACE.search(held, begin + TEXT, offsets[upto])):
                yield *_split(data[begin:found.start()], np.array([found.start() - begin]), lower), False
                begin = found.start()
        yield *_split(data[begin:offsets[upto]], offsets[at + 1:upto + 1] - begin, lower), True
        at = upto


def corpus_counts(texts: DataFrame, lower: bool) -> DataFrame:
    """(word binary, n) over all rows of a frame with the one column ``text``.

    Tasks count before the shuffle, in tables of bounded size.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            for words, _, _ in words_of(batch.column(0), lower):
                found = pa.Table.from_arrays(words.value_counts().flatten(), ["word", "n"])
                if counts is not None:
                    both = pa.concat_tables([counts, found]).combine_chunks()
                    found = both.group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])
                counts = found
                if len(counts) > FLUSH:
                    yield from counts.to_batches(ROWS)
                    counts = None
        if counts is not None:
            yield from counts.to_batches(ROWS)

    counted = texts.select("text").mapInArrow(count, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """The rows of (word, n, ...) above a frequency that at most ``most`` words reach.

    The bound comes from a histogram of frequency classes, so nothing is sorted
    and nothing but one row per class reaches the driver.
    """
    frequency = F.floor(F.log(F.col("n").cast("double")) / math.log(_STEP))
    classes = counts.groupBy(frequency.alias("c")).count().orderBy(F.col("c").desc()).collect()
    total, bound = 0, None
    for row in classes:
        total += row["count"]
        if total > most:
            break
        bound = row["c"]
    return counts.where(frequency >= bound) if bound is not None else counts.limit(0)


def document_rows(docs: DataFrame, reader: Callable[[], Callable], fields: dict[str, type], lower: bool) -> DataFrame:
    """Per document, its sums and its words that need a join.

    ``docs``: doc_id, text. ``reader()`` runs once per task and returns a function
    from what ``words_of`` yields to the sums of each text by field, and which of
    the words are to be joined. Returns rows (doc_id, _k1, _k2, word, n,
    rows, fields...): one row per document with its sums, rows = 1 and a word
    that no text contains (and one such row with rows = 0 per further piece of a long text),
    and one row per word with sums 0. The keys (``content_key``) tell documents that share a doc_id apart.
    """
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("_k1", T.LongType()), T.StructField("_k2", T.LongType()),
         T.StructField("word", T.BinaryType()),
         T.StructField("n", T.LongType()), T.StructField("rows", T.LongType())]
        + [T.StructField(k, T.DoubleType() if t is float else T.LongType()) for k, t in fields.items()])
    kinds = {k: np.float64 if t is float else np.int64 for k, t in fields.items()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader()
        for batch in batches:
            at = 0
            for words, numbers, whole in words_of(batch.column("text"), lower):
                texts = batch.slice(at, len(numbers))
                at += len(numbers) if whole else 0
                sums, apart = read(words, numbers, whole)
                keys = [texts.column(c) for c in ("doc_id", "_k1", "_k2")]
                marks = pa.array([b" %d" % (k & 0xFFFF) for k in keys[1].to_pylist()], pa.binary())  # with a space: no text's word
                yield pa.record_batch([*keys, marks, pa.array(np.zeros(len(texts), np.int64)),
                                       pa.array(np.full(len(texts), int(whole))),
                                       *[pa.array(sums[k].astype(kind)) for k, kind in kinds.items()]], schema.names)
                owner = np.repeat(np.arange(len(numbers)), numbers)[apart]
                found = pa.table([pa.array(owner), words.take(pa.array(apart))], ["owner", "word"])
                found = found.group_by(["owner", "word"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
                for part in found.to_batches(ROWS):
                    owner, word, n = (part.column(c) for c in ("owner", "word", "count_all"))
                    yield pa.record_batch([*[k.take(owner) for k in keys], word, n, pa.array(np.zeros(len(part), np.int64)),
                                           *[pa.array(np.zeros(len(part), kind)) for kind in kinds.values()]], schema.names)

    return docs.select("doc_id", "text", *content_key("text")).mapInArrow(rows, schema)
