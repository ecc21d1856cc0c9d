"""Token counts of documents without tokenising them one by one.

Texts are cut into the tokenizer's own pre-tokens, by its normaliser and pre-tokenizer;
no pre-token spans white space, so that is done once per distinct word (a run without
white space) and worker, in a bounded table. A word with one of the tokenizer's
special strings is counted as it stands, like a pre-token.

A document brings its pre-token frequencies. Every distinct pre-token is counted once with
the tokenizer library, the count is joined to the frequencies, and a second, narrow
shuffle sums per document. No ids are kept.

Pre-tokens that are frequent in a sample of documents are counted first and given to
all tasks (at most ``HEAD``, so the broadcast is bounded); they are summed
where the document is read. They carry no information that the join would not: a
different sample moves work, never a result.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, word_blocks
from tidemark.llm.words import frequent_words

HEAD = 1 << 18
FLUSH = 300_000       # distinct pre-tokens, or rows, that a task holds before passing them on
CACHE_WORDS = 200_000
CACHE_LENGTH = 64
SLICE = 50_000
_LATIN_END = "\u0250" # letters before it are composed letters in every version of the character tables
SAMPLE = 20_000
LIMIT = 2048


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    """The library's tokenizer without truncation and padding, one per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


class Cutter:
    """Pre-tokens of words, as UTF-8 of normalised text."""

    def __init__(self, path: str):
        own = tokenizer(path)
        self.normalise = own.normalizer.normalize_str if own.normalizer else str
        self.cut = own.pre_tokenizer.pre_tokenize_str
        self.special = [t.content for t in own.get_added_tokens_decoder().values()]
        # Whether words of letters are one pre-token, in lower case, and a mark after them is another.
        letters = "abcdefghijklmnopqrstuvwxyz"
        self.plain = self._by_library(letters + letters.upper()) == ((letters * 2).encode(),)
        self.marks = {m.encode() for m in ",.;:!?" if self.plain and self._by_library("ab" + m) == (b"ab", m.encode())}
        self.kept: dict[bytes, tuple[bytes, ...]] = {}
        self.passed = 0       # words not kept since the table was full

    def _pre_tokens(self, word: bytes) -> tuple[bytes, ...]:
        if self.plain:
            if word.isalpha():               # ASCII letters
                return (word.lower(),)
            if word[:-1].isalpha() and word[-1:] in self.marks:
                return (word[:-1].lower(), word[-1:])
        text = word.decode()
        if self.plain and text.isalpha() and max(text) < _LATIN_END:
            low = text.lower()
            if low.isalpha():
                return (low.encode(),)
        return self._by_library(text)

    def _by_library(self, text: str) -> tuple[bytes, ...]:
        normal = self.normalise(text)
        if any(s in text or s in normal for s in self.special):
            return (text.encode(),)
        return tuple(normal[i:j].encode() for _, (i, j) in self.cut(normal))

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """The pre-tokens of words, in order."""
        new = {w: self._pre_tokens(w) for w in set(words).difference(self.kept)}
        get = self.kept.get
        found = [new[w] if w in new else get(w) for w in words] if new else map(self.kept.__getitem__, words)
        out = list(chain.from_iterable(found))
        if len(self.kept) + len(new) <= CACHE_WORDS:
            self.kept.update((w, p) for w, p in new.items() if len(w) <= CACHE_LENGTH)
        else:
            self.passed += len(new)
            if self.passed > 8 * CACHE_WORDS:
                self.kept.clear()
                self.passed = 0
        return out


@functools.lru_cache(maxsize=2)
def cutter(path: str) -> Cutter:
    """One per worker process; the tokenizer file must be readable on the workers."""
    return Cutter(path)


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, SLICE):
        yield batch.slice(at, SLICE)


def pre_token_counts(texts: DataFrame, path: str) -> DataFrame:
    """(word binary, n) of the pre-tokens of all texts (one column); tasks count before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = cutter(path), Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            out = pa.record_batch([pa.array(list(counts), pa.binary()),
                                   pa.array(np.fromiter(counts.values(), np.int64, len(counts)))], ["word", "n"])
            counts.clear()
            yield from _slices(out)
        for batch in batches:
            for text in _binary(batch.column(0)):
                for words in word_blocks(text.as_py() or b""):
                    counts.update(cut(words))
                    if len(counts) > FLUSH:
                        yield from flush()
        yield from flush()

    return texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def piece_counts(words: Column, path: str) -> Column:
    """Tokens of each pre-token as the library gives them, without added special tokens."""

    @F.arrow_udf("bigint")
    def counted(batch: pa.Array) -> pa.Array:
        found = tokenizer(path).encode_batch_fast([w.as_py().decode() for w in batch], add_special_tokens=False)
        return pa.array([len(e.ids) for e in found], pa.int64())

    return counted(words)


def document_frequencies(docs: DataFrame, path: str, known: dict[bytes, int]) -> DataFrame:
    """(key, word, n, n_bytes, n_tokens) of (doc_id, text): per document, a row with its bytes, the tokens
    of its ``known`` pre-tokens, its doc_id and a word that no text contains, and a row for
    each other pre-token. Keys are unique per document; store the rows before they are read twice."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cut, pieces = cutter(path), shared.value.get
        base, seen = TaskContext.get().partitionId() << 33, 0
        owners, words, counts, ids, sums = [], [], [], [], []

        def flush(id_type) -> Iterator[pa.RecordBatch]:
            # The rows of pre-tokens, then those of the documents that ended.
            n, m = len(words), len(sums)
            out = pa.record_batch([
                pa.array([*owners, *[s[0] for s in sums]], pa.int64()),
                pa.array([*words, *[b" %d" % (s[0] & 0xFFFF) for s in sums]], pa.binary()),
                pa.array([*counts, *[0] * m], pa.int64()), pa.array([*[None] * n, *ids], id_type),
                pa.array([*[0] * n, *[s[1] for s in sums]], pa.int64()), pa.array([*[0] * n, *[s[2] for s in sums]], pa.int64())],
                ["key", "word", "n", "doc_id", "n_bytes", "n_tokens"])
            for held in (owners, words, counts, ids, sums):
                held.clear()
            yield from _slices(out)

        for batch in batches:
            own_ids = batch.column("doc_id")
            for i, text in enumerate(_binary(batch.column("text"))):
                data, key, tokens = text.as_py() or b"", base + seen, 0
                seen += 1
                for block in word_blocks(data):
                    found = cut(block)
                    known_pieces = list(map(pieces, found))
                    tail = Counter(w for w, p in zip(found, known_pieces) if p is None)
                    tokens += sum(filter(None, known_pieces))
                    owners += [key] * len(tail)
                    words += tail.keys()
                    counts += tail.values()
                    if len(words) > FLUSH:
                        yield from flush(own_ids.type)
                ids.append(own_ids[i].as_py())
                sums.append((key, len(data), tokens))
            yield from flush(own_ids.type)

    schema = f"key bigint, word binary, n bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT,
                 head: int = HEAD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    Whole texts; a null text counts as empty (0, 0, false). Special strings in a
    text are handled as the library does by default. Every row is returned with its
    own counts, rows that repeat a doc_id (or have none) too; an empty table gives an
    empty result. Columns besides the two are not read.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = docs.count()
    few = docs if rows <= sample else docs.sample(False, sample / rows, 17)
    frequent = frequent_words(pre_token_counts(few.select("text"), path), head)
    found = frequent.select("word", piece_counts(F.col("word"), path).alias("pieces")).toArrow()
    # Stored: the keys of the documents stay, and the distinct pre-tokens and the join read the same rows.
    parts = stored(document_frequencies(docs, path, dict(zip(found["word"].to_pylist(), found["pieces"].to_pylist()))))
    distinct = parts.where(F.col("n") > 0).select("word").distinct()
    counted = distinct.select("word", piece_counts(F.col("word"), path).alias("pieces"))
    joined = parts.join(counted, "word", "left")
    total = joined.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"),
        F.sum(F.col("n_tokens") + F.coalesce(F.col("n") * F.col("pieces"), F.lit(0))).alias("n_tokens"))
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
