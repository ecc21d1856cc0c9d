"""Quality classifier on learned subword embeddings.

The features of a text are hashed: every word, the character n-grams (2 to 4
characters) of every word between boundary marks, and for every pair of
neighbouring words that are equal a mark of repetition (the word bigram with its
words left out, so that a repeated word is seen whatever it is). Each feature has a
learned vector, a text is the average of the vectors of its features, and a
softmax over two outputs gives the probability of label 1. Vectors and outputs
are learned together by stochastic gradient descent in numpy, one text a step.

Training takes at most ``TRAINING_ROWS`` labelled texts (those with the smallest
hash of the id), each whole, as feature counts of bounded size. Scoring covers
all texts: the output being linear in the average, each feature is reduced to
one number, tasks keep the numbers of recent words, and texts are read in blocks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder, word_blocks

TRAINING_ROWS = 6000
BUCKETS = 1 << 18
DIMENSIONS = 16
EPOCHS = 6
RATE = 2.0
GRAMS = (2, 3, 4)
CACHE_WORDS = 200_000
_REPEAT = b"\x00repeat"
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so that multiplication modulo 2^64 loses nothing


def features_of(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of their character n-grams, and the position of the word of each.

    Every word stands between boundary marks; the n-grams of all words are hashed
    together, those that would span two words left out.
    """
    marked = b"<" + b">\n<".join(words) + b">\n"
    codes = np.frombuffer(marked.decode("utf-8", "replace").encode("utf-32-le"), "<u4").astype(np.uint64)
    end = codes == 10
    word = np.cumsum(end) - end
    found = [np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) % np.uint64(buckets)]
    owner = [np.arange(len(words))]
    for n in GRAMS:
        last = len(codes) - n + 1
        value, inside = codes[:last] + np.uint64(n), ~end[:last]
        for k in range(1, n):
            value = value * _MIX + codes[k:last + k]
            inside &= ~end[k:last + k]
        value = (value[inside] * _MIX) >> np.uint64(24)
        found.append(value % np.uint64(buckets))
        owner.append(word[:last][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(owner)


def repeats(words: list[bytes], before: bytes | None) -> int:
    """How many words equal the word before them."""
    return sum(map(bytes.__eq__, words, words[1:])) + (bool(words) and words[0] == before)


def text_features(data: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    counts: Counter[bytes] = Counter()
    same, last = 0, None
    total = np.zeros(buckets, np.int64)
    for words in word_blocks(data):
        counts.update(words)
        same += repeats(words, last)
        last = words[-1] if words else last
        if len(counts) > CACHE_WORDS:
            _add(counts, total)
    _add(counts, total)
    total[zlib.crc32(_REPEAT) % buckets] += same
    found = np.flatnonzero(total)
    return found.astype(np.int32), total[found].astype(np.int32)


def _add(counts: Counter, total: np.ndarray) -> None:
    if counts:
        found, owner = features_of(list(counts), len(total))
        times = np.fromiter(counts.values(), np.int64, len(counts))
        total += np.bincount(found, times[owner], len(total)).astype(np.int64)
        counts.clear()


@dataclass
class Model:
    vectors: np.ndarray     # buckets x dimensions
    output: np.ndarray      # dimensions x 2
    bias: np.ndarray        # 2

    def probability(self, features: np.ndarray, counts: np.ndarray) -> float:
        """Softmax probability of label 1."""
        mean = counts @ self.vectors[features] / max(1, counts.sum())
        scores = mean @ self.output + self.bias
        return float(1 / (1 + np.exp(scores[0] - scores[1])))

    def reduced(self) -> tuple[np.ndarray, float]:
        """What each feature adds to the difference of the two scores, and the constant."""
        return self.vectors @ (self.output[:, 1] - self.output[:, 0]), float(self.bias[1] - self.bias[0])


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, epochs: int = EPOCHS,
          rate: float = RATE) -> Model:
    """Fit on (features, counts, label) rows; without rows of both labels only the bias says anything."""
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (buckets, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    step, steps = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            features, counts, label = rows[i]
            now = rate * (1 - step / steps)
            step += 1
            share = (counts / max(1, counts.sum())).astype(np.float32)
            mean = share @ vectors[features]
            scores = mean @ output + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[label] -= 1
            back = output @ error
            output -= now * np.outer(mean, error)
            bias -= 0.05 * now * error
            vectors[features] -= now * share[:, None] * back
    return Model(vectors, output, bias)


def labelled(docs: DataFrame, labels: DataFrame, modulus: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, text, quality) of the training rows; of repeated labels of a document the lowest counts."""
    of = (labels.where(F.col("quality").isin(0, 1) & (id_remainder("doc_id", modulus) != held_out) & F.col("doc_id").isNotNull())
          .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    ids = docs.select("doc_id").distinct().join(of, "doc_id")
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # bounded, and so is its broadcast
    # Rows that repeat an id are one training row, combined before the shuffle.
    return (docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
            .agg(F.min("text").alias("text"), F.min("quality").alias("quality")))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, most: int = TRAINING_ROWS) -> Model:
    """Train on labelled rows whose crc32 of the id as text, modulo ``modulus``, is not ``held_out``.

    ``docs``: doc_id, text; ``labels``: doc_id, quality. Feature counts of at
    most ``most`` documents (at most ``BUCKETS`` numbers each) go to one task,
    which trains; only the model reaches the driver.
    """
    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                found, counts = text_features(text.as_py() or b"")
                yield pa.record_batch([batch.column("doc_id").slice(i, 1).cast(pa.string()), batch.column("quality").slice(i, 1).cast(pa.int32()),
                                       pa.array([found.tobytes()]), pa.array([counts.tobytes()])],
                                      ["id", "quality", "features", "counts"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["id"], np.frombuffer(r["features"], np.int32), np.frombuffer(r["counts"], np.int32), r["quality"])
                for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (zlib.crc32(r[0].encode()), r[0]))  # an order that no rerun changes
        model = train([r[1:] for r in rows])
        yield pa.record_batch([pa.array([p.tobytes()]) for p in (model.vectors, model.output, model.bias)],
                              ["vectors", "output", "bias"])

    chosen = labelled(docs, labels, modulus, held_out, most)
    featured = chosen.mapInArrow(featurise, "id string, quality int, features binary, counts binary")
    fitted = featured.repartition(1).mapInArrow(learn, "vectors binary, output binary, bias binary").toArrow()
    if not fitted.num_rows:
        return train([])
    vectors, output, bias = (np.frombuffer(fitted[c][0].as_buffer(), np.float32) for c in fitted.column_names)
    return Model(vectors.reshape(BUCKETS, DIMENSIONS), output.reshape(DIMENSIONS, 2), bias)


class Scorer:
    """Scores texts from the reduced features; remembers a bounded number of words."""

    def __init__(self, reduced: np.ndarray, constant: float):
        self.reduced, self.constant = reduced.astype(np.float64), constant
        self.repeat = float(self.reduced[zlib.crc32(_REPEAT) % len(reduced)])
        self.place: dict[bytes, int] = {}
        self.value = np.empty(CACHE_WORDS + 1)
        self.size = np.empty(CACHE_WORDS + 1)

    def _learn(self, words: list[bytes]) -> None:
        if len(self.place) + len(words) > CACHE_WORDS:
            self.place.clear()
        at = np.arange(len(self.place), len(self.place) + len(words))
        self.place.update(zip(words, at.tolist()))
        found, owner = features_of(words, len(self.reduced))
        self.value[at] = np.bincount(owner, self.reduced[found], len(words))
        self.size[at] = np.bincount(owner, minlength=len(words))

    def __call__(self, data: bytes) -> float:
        value = size = 0.0
        last = None
        for block in word_blocks(data):
            for start in range(0, len(block), CACHE_WORDS // 4):
                words = block[start:start + CACHE_WORDS // 4]
                found = list(map(self.place.get, words))
                if None in found:
                    new = {w for w, f in zip(words, found) if f is None}
                    if len(self.place) + len(new) > CACHE_WORDS:
                        new = set(words)  # the table starts anew, with all words of this part
                    self._learn(list(new))
                    found = list(map(self.place.__getitem__, words))
                at = np.array(found)
                value += self.value[at].sum()
                size += self.size[at].sum()
                same = repeats(words, last)
                value += same * self.repeat
                size += same
                last = words[-1] if words else last
        return float(1 / (1 + np.exp(-np.clip(self.constant + value / max(1.0, size), -700, 700))))


def probability(text: str | Column, model: Model) -> Column:
    """Probability of label 1 for a text column; a null text is an empty one."""
    reduced, constant = model.reduced()

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(reduced, constant)
        for batch in batches:
            yield pa.array([scorer(t.as_py() or b"") for t in batch.cast(pa.binary())], pa.float64())

    return scored(F.col(text) if isinstance(text, str) else text)


def score_quality(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Add the score (0 to 1) to every row; a column of that name is replaced.

    Nothing but the text is looked at. Empty and null texts get the score of the
    bias alone. Repeated rows score alike; an empty table gives an empty result.
    """
    return docs.withColumn(score, probability(text, model))
