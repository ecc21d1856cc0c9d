"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Tokens are words after lower-casing A-Z, then one end per text. The base is a
unigram model of the training texts with a half added to every count. The neural
model predicts a token from the two before it: the context vector is the sum of
two position-dependent word vectors, and the score of an output is its product with
the output's vector plus a bias. Its vocabulary follows the data: every training
word seen ``LEAST_COUNT`` times, the end, and one output for all other words, which
the unigram counts of those words (and one place for unknown ones) divide up.
The ``SHORTLIST`` most frequent words, the end and the others are classes of
their own; the rest of the vocabulary is cut by frequency into about as many
classes as a class has words. A token's probability is that of its class among all
classes times that of the word within its class, so a token costs the square root of
the vocabulary, and the probabilities of all known words, the end and "unknown" add
up to one after any context. Normalisers are computed by batched matrix products
for the contexts met.

Training covers every training text: a task runs one pass of stochastic gradient
steps over the tokens of each of its batches, from the same start (zero vectors
with small noise, biases at the unigram log-probabilities). The models are averaged
row by row, weighted by the examples of a row, and summed in blocks of rows, so
that the driver takes one model. Noise tokens come from the unigram distribution
and are shared by the examples of a step; steps touch the rows they use only.

Counts cover all training texts. Documents are scored where they are read; only
their words outside the ``HEAD`` most frequent ones, whose counts every task has,
are shuffled and joined with the counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder, stored
from tidemark.llm.words import corpus_counts, document_rows, frequent_words, words_of

DIMENSIONS = 16
HEAD = 1 << 18
LEAST_COUNT = 20      # of a word of the vocabulary
VOCABULARY = HEAD     # words at most: a task holds their vectors (200 bytes a word, as much again in training)
SHORTLIST = 128       # words that are classes of their own
NOISE = 64            # noise tokens of a step
STEP = 8192           # examples of a step, fewer where there are few
CHUNK = 8192          # examples scored at once
PIECE = 1 << 16       # scores computed at once: they stay in the cache
PASS = 4_000_000      # tokens after which a task starts the next pass
LEAST_STEPS, LEAST_STEP = 64, 128
RATE = 0.1
EPSILON = 1e-5
BLOCK = 4096          # rows of a model that are averaged together
SHARD = 16_000_000    # training tokens of a task, so that its model is small beside its texts


@dataclass
class Counts:
    """What the training texts hold: a stored table (word, n), and its totals."""

    table: DataFrame
    texts: int        # training texts, the count of the end
    tokens: int       # with the ends
    types: int        # with the end, if any


class LogBilinear:
    """Words are 0..k-1 by falling frequency, k all other words, k + 1 the end; k + 2 is the start of a text.

    ``output`` and ``bias`` belong to the classes: first the shortlist, the other
    words and the end, then the classes of several words, whose vectors within
    the class are ``inner`` and ``inner_bias``.
    """

    def __init__(self, words: list[bytes] | pa.Array, unigram: np.ndarray, shortlist: int | None = None):
        self.words, self.unigram = words, unigram / unigram.sum()
        self.other, self.end, self.start = len(words), len(words) + 1, len(words) + 2
        self.short = min(len(words), SHORTLIST if shortlist is None else shortlist)
        tail = len(words) - self.short
        self.width = max(1, math.isqrt(tail))
        self.classes = np.concatenate([np.arange(self.short), self.short + 2 + np.arange(tail) // self.width,
                                       [self.short, self.short + 1]]).astype(np.int64)
        self.of_class = np.bincount(self.classes, self.unigram)
        self.of_tail = self.unigram[self.short:self.other] / (self.unigram[self.short:self.other].sum() or 1)
        rng = np.random.default_rng(11)
        self.output = rng.normal(0, 0.01, (len(self.of_class), DIMENSIONS)).astype(np.float32)
        self.near = rng.normal(0, 0.01, (self.start + 1, DIMENSIONS)).astype(np.float32)
        self.far = rng.normal(0, 0.01, (self.start + 1, DIMENSIONS)).astype(np.float32)
        self.bias = np.log(self.of_class).astype(np.float32)
        self.inner = rng.normal(0, 0.01, (tail, DIMENSIONS)).astype(np.float32)
        self.inner_bias = np.log(self.of_tail).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.output, self.inner, self.near, self.far, self.bias, self.inner_bias]

    def packed(self) -> np.ndarray:
        """One row per vector, its bias (or zero) in the last column."""
        biases = np.concatenate([self.bias, self.inner_bias, np.zeros(len(self.near) + len(self.far), np.float32)])
        return np.column_stack([np.concatenate(self.parameters()[:4]), biases])

    def unpack(self, rows: np.ndarray) -> None:
        at = 0
        for p, bias in zip(self.parameters()[:4], (self.bias, self.inner_bias, None, None)):
            p[...] = rows[at:at + len(p), :-1]
            if bias is not None:
                bias[...] = rows[at:at + len(p), -1]
            at += len(p)

    def examples(self, far: np.ndarray, near: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Examples per row of ``packed``."""
        tail = token[(token >= self.short) & (token < self.other)] - self.short
        return np.concatenate([np.bincount(self.classes[token], minlength=len(self.output)),
                               np.bincount(tail, minlength=len(self.inner)),
                               np.bincount(near, minlength=len(self.near)), np.bincount(far, minlength=len(self.far))])

    def train(self, far: np.ndarray, near: np.ndarray, token: np.ndarray, rng: np.random.Generator,
              squares: list[np.ndarray]) -> None:
        """One pass of noise-contrastive steps; ``squares`` are the running squared gradients."""
        order = rng.permutation(np.arange(len(token), dtype=np.int32))
        step = min(STEP, max(LEAST_STEP, len(order) // LEAST_STEPS))
        tables = [(self.output, self.bias, squares[0], squares[4], self.of_class),
                  (self.inner, self.inner_bias, squares[1], squares[5], self.of_tail)]
        drawn = [(np.cumsum(q), np.log(NOISE * q).astype(np.float32)) for *_, q in tables]
        scratch = np.empty((step, NOISE), np.float32)

        def contrast(table, context, outputs, upto, log_noise):
            noise = np.minimum(np.searchsorted(upto, rng.random(NOISE) * upto[-1], "right"), len(upto) - 1)
            return _contrast(*table[:4], context, outputs, noise, log_noise, len(rows), scratch[:len(outputs)])
        for at in range(0, len(order), step):
            rows = order[at:at + step]
            a, b, c = (x.take(rows) for x in (far, near, token))
            context = self.far.take(a, 0)
            context += self.near.take(b, 0)
            g_context = contrast(tables[0], context, self.classes.take(c), *drawn[0])
            in_tail = np.flatnonzero((c >= self.short) & (c < self.other))
            if len(in_tail):
                g_tail = contrast(tables[1], context.take(in_tail, 0), c.take(in_tail) - self.short, *drawn[1])
                g_tail += g_context.take(in_tail, 0)
                g_context[in_tail] = g_tail
            for p, index, s in ((self.near, b, squares[2]), (self.far, a, squares[3])):
                _descend(p, s, *_sum_rows(index, g_context), len(rows))

    def log_normaliser(self, context: np.ndarray) -> np.ndarray:
        """Log of the sum over classes after each context vector."""
        return _log_sum(context, self.output, self.bias)

    def log_normalisers(self) -> np.ndarray:
        """The same after each (far, near) pair of context words, for small vocabularies."""
        return np.stack([self.log_normaliser(far + self.near) for far in self.far])

    def log_probabilities(self, far: np.ndarray, near: np.ndarray, token: np.ndarray) -> np.ndarray:
        out = np.empty(len(token), np.float64)
        group = self.classes[token]
        # The classes are summed once per context that is met.
        size = self.start + 1
        pairs, which = np.unique(far.astype(np.int64) * size + near, return_inverse=True)
        sums = np.empty(len(pairs))
        for at in range(0, len(pairs), CHUNK):
            p = pairs[at:at + CHUNK]
            sums[at:at + CHUNK] = self.log_normaliser(self._context(p // size, p % size))
        for at in range(0, len(token), CHUNK):
            part = slice(at, at + CHUNK)
            c, g = self._context(far[part], near[part]), group[part]
            out[part] = np.einsum("ij,ij->i", c, self.output.take(g, 0)) + self.bias.take(g) - sums.take(which[part])
        ordered, order = _sorted(group)
        order = order[np.searchsorted(ordered, self.short + 2):]
        cuts = np.flatnonzero(np.diff(ordered[len(ordered) - len(order):])) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            low = self.short + (group[rows[0]] - self.short - 2) * self.width
            members = slice(low - self.short, min(low + self.width, self.other) - self.short)
            vectors, biases = self.inner[members], self.inner_bias[members]
            for at in range(0, len(rows), CHUNK):
                part = rows[at:at + CHUNK]
                c, w = self._context(far.take(part), near.take(part)), token.take(part) - low
                out[part] += np.einsum("ij,ij->i", c, vectors.take(w, 0)) + biases.take(w) - _log_sum(c, vectors, biases)
        return out

    def _context(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        context = self.far.take(far, 0)
        context += self.near.take(near, 0)
        return context


def _log_sum(context: np.ndarray, vectors: np.ndarray, biases: np.ndarray) -> np.ndarray:
    # One product with the biases as a last column, in pieces that stay in the cache; powers of two are faster than of e.
    base = biases.max()
    table = np.column_stack([vectors, biases - base]).T / np.float32(math.log(2))
    rows = np.column_stack([context, np.ones(len(context), np.float32)])
    reach = math.sqrt(float(np.einsum("ij,ij->i", context, context).max())
                      * float(np.einsum("ij,ij->i", vectors, vectors).max()))
    piece = max(16, PIECE // table.shape[1])
    ones, out = np.ones(table.shape[1], np.float32), np.empty(len(rows), np.float32)
    held, top = np.empty((piece, table.shape[1]), np.float32), np.zeros(len(rows), np.float32)
    for at in range(0, len(rows), piece):
        part = slice(at, at + piece)
        scores = np.matmul(rows[part], table, out=held[:len(rows[part])])
        if reach > 40:                          # else no sum can overflow or vanish
            scores.max(1, out=top[part])
            scores -= top[part, None]
        np.matmul(np.exp2(scores, out=scores), ones, out=out[part])
    return (np.log2(out).astype(np.float64) + top) * math.log(2) + base


def _contrast(vectors: np.ndarray, biases: np.ndarray, squares: np.ndarray, bias_squares: np.ndarray,
              context: np.ndarray, outputs: np.ndarray, noise: np.ndarray, log_noise: np.ndarray,
              size: int, scratch: np.ndarray) -> np.ndarray:
    """A noise-contrastive step on a table of outputs; returns the gradient of the contexts."""
    own, others = vectors.take(outputs, 0), vectors[noise]
    true = np.einsum("ij,ij->i", context, own) + biases.take(outputs) - log_noise.take(outputs)
    g_true = -1 / (1 + np.exp(np.clip(true, -30, 30)))
    # The logistic function of the noise's scores, in place.
    g_false = np.matmul(context, -others.T, out=scratch)
    g_false += log_noise[noise] - biases[noise]
    np.exp(np.clip(g_false, -30, 30, out=g_false), out=g_false)
    g_false += 1
    np.divide(1, g_false, out=g_false)
    grads = np.empty((len(outputs) + len(noise), DIMENSIONS + 1), np.float32)
    np.multiply(g_true[:, None], context, out=grads[:len(outputs), :-1])
    np.matmul(g_false.T, context, out=grads[len(outputs):, :-1])
    grads[:len(outputs), -1], grads[len(outputs):, -1] = g_true, g_false.sum(0)
    found, grads = _sum_rows(np.concatenate([outputs, noise]), grads)
    own *= g_true[:, None]
    own += g_false @ others
    _descend(vectors, squares, found, grads[:, :-1], size)
    _descend(biases, bias_squares, found, grads[:, -1], size)
    return own


def _descend(p: np.ndarray, squares: np.ndarray, rows: np.ndarray, grads: np.ndarray, size: int) -> None:
    grads = grads / size
    s = squares.take(rows, 0)
    s += grads * grads
    squares[rows] = s
    np.sqrt(s, out=s)
    s += EPSILON
    grads *= RATE
    grads /= s
    p[rows] = p.take(rows, 0) - grads


def _sum_rows(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``index`` and the sums of their rows."""
    ordered, order = _sorted(index)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[starts], np.add.reduceat(rows.take(order, 0), starts, axis=0)


def _sorted(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small numbers in order, and the places they had; equal ones keep theirs."""
    # The places are the lower bits: sorting plain numbers is faster than a stable argsort.
    keys = (index.astype(np.int64) << 32) + np.arange(len(index))
    keys.sort()
    return keys >> 32, keys & 0xFFFFFFFF


def training_rows(docs: DataFrame, modulus: int = 5, held_out: int = 1) -> DataFrame:
    return docs.where(id_remainder("doc_id", modulus) != held_out)


def count_corpus(training: DataFrame) -> Counts:
    table = stored(corpus_counts(training.select("text"), lower=True))
    texts = training.count()
    words, types = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    return Counts(table, texts, words + texts, types + (texts > 0))


class Sequences:
    """Examples (far, near, token) of the texts that ``words_of`` yields, called for one piece after the other."""

    def __init__(self, model: LogBilinear):
        self.end, self.start = model.end, model.start
        self.before = [self.start, self.start]      # of the piece to come

    def __call__(self, ids: np.ndarray, numbers: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``ids`` are the words; returns the examples, and how many each text has (its end is one)."""
        sizes = numbers + whole
        upto = np.cumsum(sizes)
        if whole:
            token = np.full(upto[-1], self.end, np.int32)
            words = np.ones(len(token), bool)
            words[upto - 1] = False
            token[words] = ids
        else:
            token = ids.astype(np.int32)
        padded = np.concatenate([self.before, token]).astype(np.int32)
        far, near = padded[:-2].copy(), padded[1:-1].copy()
        begins = upto[:-1]
        near[begins] = far[begins] = self.start
        seconds = begins[sizes[1:] > 1] + 1
        far[seconds] = self.start
        self.before = [self.start, self.start] if whole else padded[-2:].tolist()
        return far, near, token, sizes


def _places(words: pa.Array, of: pa.Array) -> np.ndarray:
    """The place of each word in ``of``, ``len(of)`` for others."""
    return pc.index_in(words, value_set=of).fill_null(len(of)).to_numpy()


def _rows(at: int, met: np.ndarray, rows: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """The rows ``met`` of the block that starts at ``at``, and their examples."""
    return pa.record_batch([pa.array([at], pa.int32()), *[pa.array([a.tobytes()], pa.binary())
                                                          for a in (met.astype(np.int16), rows, n)]], ["at", "met", "model", "n"])


def fit(training: DataFrame, counts: Counts, words: list[tuple[bytes, int]]) -> LogBilinear:
    """Train on all texts; ``words`` are the vocabulary with its counts."""
    known = sum(n for _, n in words)
    unigram = np.array([n for _, n in words] + [counts.tokens - counts.texts - known, counts.texts], np.float64) + 0.5
    model = LogBilinear(pa.array([w for w, _ in words], pa.binary()), unigram)

    shared = training.sparkSession.sparkContext.broadcast((model.words, unigram))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LogBilinear(*shared.value)
        sequences = Sequences(own)
        rng = np.random.default_rng(23)
        squares = [np.zeros_like(p) for p in own.parameters()]
        weights = 0
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            size = 0

            def step():
                nonlocal weights
                far, near, token = (np.concatenate(x) for x in zip(*parts))
                parts.clear()
                own.train(far, near, token, rng, squares)
                weights = weights + own.examples(far, near, token)
            for found, numbers, whole in words_of(batch.column(0), lower=True):
                *examples, sizes = sequences(_places(found, own.words), numbers, whole)
                at, ends = 0, np.cumsum(sizes) if whole else np.empty(0, np.int64)
                # A pass ends with the text that exceeds its size.
                while (last := np.searchsorted(ends, PASS - size + at, "right")) < len(ends):
                    parts.append(tuple(x[at:ends[last]] for x in examples))
                    step()
                    at, size = ends[last], 0
                if at < len(examples[0]):
                    parts.append(tuple(x[at:] for x in examples))
                    size += len(examples[0]) - at
            if parts:
                step()
        if np.any(weights):
            # How far the rows that were touched have moved, in half the width, and by how many examples.
            squares.clear()
            moved = own.packed()
            moved -= LogBilinear(*shared.value).packed()
            moved = moved.astype(np.float16)
            for at in range(0, len(moved), BLOCK):
                met = np.flatnonzero(weights[at:at + BLOCK])
                if len(met):
                    yield _rows(at, met, moved[at + met], weights[at + met].astype(np.float32))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, met, rows, n in zip(*(column.to_pylist() for column in batch.columns)):
                total = sums.setdefault(at, np.zeros((BLOCK, DIMENSIONS + 2)))
                met, n = np.frombuffer(met, np.int16), np.frombuffer(n, np.float32).astype(np.float64)
                total[met, :-1] += np.frombuffer(rows, np.float16).reshape(-1, DIMENSIONS + 1) * n[:, None]
                total[met, -1] += n
        for at, total in sums.items():
            met = np.flatnonzero(total[:, -1])
            yield _rows(at, met, (total[met, :-1] / total[met, -1:]).astype(np.float32), total[met, -1].astype(np.float32))

    schema = "at int, met binary, model binary, n binary"
    tasks = -(-counts.tokens // SHARD)
    trained = training.select("text").coalesce(max(1, tasks)).mapInArrow(train, schema)
    rows = model.packed()
    blocks = -(-len(rows) // BLOCK)
    for block in trained.repartition(min(blocks, 64), "at").mapInArrow(add, schema).collect():  # one row per block
        met = np.frombuffer(bytes(block.met), np.int16)
        rows[block.at + met.astype(np.int64)] += np.frombuffer(bytes(block.model), np.float32).reshape(-1, DIMENSIONS + 1)
    model.unpack(rows)
    return model


def score(docs: DataFrame, counts: Counts, model: LogBilinear, head: list[tuple[bytes, int]]) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) for every row of ``docs`` (doc_id, text)."""
    known = sum(n + 0.5 for w, n in head[:len(model.words)])
    rest = counts.tokens - counts.texts + 0.5 * (counts.types - (counts.texts > 0)) - known + 0.5
    base_total = math.log10(counts.tokens + 0.5 * (counts.types + 1))
    shared = docs.sparkSession.sparkContext.broadcast({
        "words": pa.array([w for w, _ in head], pa.binary()),
        "log": np.log10(np.array([n for _, n in head], np.float64) + 0.5),
        "model": model})
    texts = counts.texts

    def reader():
        kept = shared.value
        own, size, logs = kept["model"], len(kept["words"]), np.append(kept["log"], 0.0)
        sequences, log_rest, log_end = Sequences(own), math.log10(rest), math.log10(texts + 0.5)

        def read(words: pa.Array, numbers: np.ndarray, whole: bool):
            at = _places(words, kept["words"])
            far, near, token, sizes = sequences(np.minimum(at, own.other), numbers, whole)

            def per_text(values: np.ndarray, of: np.ndarray) -> np.ndarray:
                return np.bincount(of, values, len(numbers))
            word_of, token_of = (np.repeat(np.arange(len(numbers)), n) for n in (numbers, sizes))
            # The other words divide up their output by their counts; those outside the head are joined.
            lm = per_text(np.where(at < own.other, 0.0, logs[at] - log_rest), word_of)
            lm += per_text(own.log_probabilities(far, near, token) / math.log(10), token_of)
            sums = {"n_tokens": sizes, "known": per_text(at < size, word_of) + int(whole and texts > 0), "lm": lm,
                    "base": per_text(logs[at], word_of) + (log_end if whole else 0.0)}
            return sums, np.flatnonzero(at == size)
        return read

    fields = {"n_tokens": int, "known": int, "lm": float, "base": float}
    parts = document_rows(docs, reader, fields, lower=True)
    joined = parts.join(counts.table.withColumnRenamed("n", "c"), "word", "left")
    tail = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    total = joined.groupBy("doc_id", "_k1", "_k2").agg(
        F.sum("rows").alias("rows"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("lm") + tail).alias("score"), F.sum(F.col("base") + tail).alias("base"))
    # Equal rows share a key: their sums are those of one row, so many times.
    each = total.select("doc_id", *[(F.col(c) / F.col("rows")).alias(c) for c in ("n_tokens", "n_known", "score", "base")],
                        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_row"))
    return each.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"),
                       F.col("n_known").cast("bigint").alias("n_known"),
                       (F.col("base") - F.col("n_tokens") * base_total).alias("base_score"), "score")


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = 5, held_out: int = 1,
                    vocabulary: int = VOCABULARY, head: int = HEAD, least_count: int = LEAST_COUNT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from the rows whose crc32 of the id as text, modulo ``modulus``, is not
    ``held_out`` (rows without an id among them). Scores are log10 probabilities of
    whole texts; a null text is an empty one, whose only token is the end. Rows
    that repeat an id are returned each. Without training rows all words are
    unknown; an empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    training = training_rows(docs, modulus, held_out)
    counts = count_corpus(training)
    found = frequent_words(counts.table, head).toArrow()
    frequent = sorted(zip(found["word"].to_pylist(), found["n"].to_pylist()), key=lambda w: (-w[1], w[0]))
    model = fit(training, counts, [w for w in frequent[:vocabulary] if w[1] >= least_count])
    scored = score(docs, counts, model, frequent)
    return scored.select("doc_id", (id_remainder("doc_id", modulus) == held_out).alias("held_out"), "n_tokens", "n_known",
                         F.lit(counts.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
