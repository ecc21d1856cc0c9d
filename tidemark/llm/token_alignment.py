"""Alignment of two tokenizers' tokens over a corpus.

Tokenizer A is a byte-level BPE file, B a sentencepiece model; both read a space and
then the text. Byte offsets at which tokens of both end cut a text into groups;
an A and a B token are linked where their byte ranges overlap. How many documents
hold a pair of ids linked shows which B token an A token corresponds to.

Most links join tokens of the same bytes. Their B id follows from the A id, so an
array maps every A id to the B id of the same bytes, if any, and links that
agree with it are counted in vectors of the length of A's vocabulary: tasks add
theirs up, and the driver takes one number per A id. Only the other links, from
groups of several tokens, enter a shuffle of (pair, documents), combined per
task first. The totals go back to the documents in the same two ways: from the
vectors, and for other pairs by a join, but for the ``HEAD`` most frequent
ones, whose counts every task has.

Both tokenizers cut at a single space between two other characters (A's pattern by
its form, B's if no piece holds a space after another character), so a text is cut
there, and the tokens, groups and links of a piece are found once per worker
process and kept in a bounded table. Links of many pieces are found at once: the
ends of the tokens of A and B together cut the bytes into segments, and every
segment is one link.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import speculative_bpe
from tidemark.llm.common import stored
from tidemark.llm.speculative_bpe import GROUP_CHARACTERS, cut_pieces, ragged

CACHE_PIECES = 300_000
CACHE_LENGTH = 64
HEAD = 1 << 18                # pairs whose counts every task has
BUFFER = 1 << 21              # pairs that a task combines before passing them on
SLICE = 50_000

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_LISTS = ("same_ids", "same_links", "pairs", "pair_links")
_FIELDS = [*[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("groups", T.StringType()),
           *[T.StructField(c, T.ArrayType(T.LongType() if c == "pairs" else T.IntegerType())) for c in _LISTS]]


class Aligner:
    """Aligns texts; ``same`` holds the B id of the bytes of each A id, or -1."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = speculative_bpe.codec(a_path, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.a_bytes = self.a.vocabulary.bytes
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                        for i, n in enumerate(names)]
        self.size_b = size
        if len(self.a_bytes) * size >= 1 << 32:
            raise ValueError("the vocabularies have too many pairs of ids")
        self.cuts = not any("▁" in n.lstrip("▁") for n in names)
        ids = {}
        for i, token in enumerate(self.b_bytes):
            if token not in ids or self.b.is_byte(ids[token]):     # a piece rather than the byte of its character
                ids[token] = i
        self.same = np.array([ids.get(t, -1) if t else -1 for t in self.a_bytes], np.int64)
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        # Ids as text, with the mark that follows within a group, and after its last one.
        self.texts = [[np.array([f"{i}{mark}" for i in range(len(v))], object) for mark in marks]
                      for v, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))]
        self.a_flat, self.b_flat = (np.frombuffer(b"".join(v), np.uint8) for v in (self.a_bytes, self.b_bytes))
        self.a_starts, self.b_starts = (np.cumsum(n) - n for n in (self.a_lengths, self.b_lengths))
        self.place: dict[str, int] = {}   # of a known piece
        self.known = Pieces.none()
        self.passed = 0

    def _fits(self, data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray,
              starts: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Which pieces, of so many bytes each in ``data``, are what their tokens' bytes make up."""
        owner = np.repeat(np.arange(len(sizes)), counts)
        fits = np.bincount(owner, lengths[ids], len(sizes)).astype(np.int64) == sizes
        mine = fits[owner]
        got = flat[ragged(starts[ids[mine]], lengths[ids[mine]])]
        byte_owner = np.repeat(np.arange(len(sizes)), sizes)
        byte_owner, want = byte_owner[fits[byte_owner]], data[fits[byte_owner]]
        fits[byte_owner[got != want]] = False
        return fits

    def align_pieces(self, pieces: list[str]) -> Pieces:
        """Tokens, groups and links of a space and each piece."""
        if not pieces:
            return Pieces.none()
        a, a_counts = self.a.encode_pieces(pieces)
        b_rows = self.b.encode(pieces, num_threads=1)
        b_counts = np.fromiter(map(len, b_rows), np.int64, len(pieces))
        b = np.fromiter(chain.from_iterable(b_rows), np.int64, int(b_counts.sum()))
        rows = [(" " + p).encode() for p in pieces]
        sizes, data = np.fromiter(map(len, rows), np.int64, len(rows)), np.frombuffer(b"".join(rows), np.uint8)
        fits = (self._fits(data, sizes, a, a_counts, self.a_lengths, self.a_starts, self.a_flat)
                & self._fits(data, sizes, b, b_counts, self.b_lengths, self.b_starts, self.b_flat))
        a, b = a[np.repeat(fits, a_counts)], b[np.repeat(fits, b_counts)]
        a_counts, b_counts = np.where(fits, a_counts, 0), np.where(fits, b_counts, 0)
        ends = np.cumsum(np.where(fits, sizes, 0))                # of the pieces, in bytes
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        # Marks at the bytes where tokens end: of both, a border of groups; of either, the end of a link.
        ends_at = np.zeros((2, int(ends[-1]) + 1), np.int8)
        ends_at[0, a_ends], ends_at[1, b_ends] = 1, 1
        borders = ends_at[0] & ends_at[1]
        cuts = np.flatnonzero(ends_at[0] | ends_at[1])
        link_a = a[np.cumsum(ends_at[0], dtype=np.int64)[cuts - 1]]
        link_b = b[np.cumsum(ends_at[1], dtype=np.int64)[cuts - 1]]
        same = self.same[link_a] == link_b
        owner = np.searchsorted(ends, cuts)
        links, same_counts = (np.bincount(o, minlength=len(pieces)) for o in (owner, owner[same]))
        groups = np.bincount(np.searchsorted(ends, np.flatnonzero(borders)), minlength=len(pieces))
        # Tokens in the order of the text form: by group, A's before B's.
        passed = np.cumsum(borders, dtype=np.int64)               # groups that have ended, by byte
        a_group, b_group = passed[a_ends - 1], passed[b_ends - 1]
        a_upto = np.cumsum(np.bincount(a_group, minlength=int(passed[-1])))
        b_upto = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=int(passed[-1])))])
        words = np.empty(len(a) + len(b), object)
        for ids, token_ends, at, table in ((a, a_ends, np.arange(len(a)) + b_upto[a_group], self.texts[0]),
                                           (b, b_ends, np.arange(len(b)) + a_upto[b_group], self.texts[1])):
            last = borders[token_ends] > 0
            words[at[last]], words[at[~last]] = table[1][ids[last]], table[0][ids[~last]]
        words, upto = words.tolist(), np.cumsum(a_counts + b_counts).tolist()
        return Pieces(fits, np.stack([a_counts, b_counts, groups, links], axis=1),
                      ["".join(words[i:j]) for i, j in zip([0, *upto], upto)],
                      same_counts, link_a[same], links - same_counts, (link_a * self.size_b + link_b)[~same])

    def _keep(self, new: list[str], found: Pieces) -> None:
        """Keep the pieces met first, mostly frequent ones; start anew after many others."""
        if len(self.place) + len(new) <= CACHE_PIECES:
            # Only pieces without white space at their ends: others do not show that a text can be cut.
            at = [n for n, p in enumerate(new) if 0 < len(p) <= CACHE_LENGTH and p == p.strip()]
            self.place.update(zip([new[n] for n in at], range(len(self.place), len(self.place) + len(at))))
            self.known = self.known.joined(found.taken(at))
        else:
            self.passed += len(new)
            if self.passed > 8 * CACHE_PIECES:
                self.place, self.known, self.passed = {}, Pieces.none(), 0

    def align(self, texts: list[str]) -> pa.RecordBatch:
        """One row per text: counts, groups as text, and its distinct links with their numbers."""
        rows, missing, place = [], set(), self.place
        for text in texts:
            if not text:
                rows.append(([], []))
                continue
            first, rest, known, unknown = cut_pieces(text, place) if self.cuts else (text, [], [], [])
            rows.append(([first, *rest], [place.get(first), *known]))
            missing.update(unknown)
            if first not in place:
                missing.add(first)
        new = list(missing)
        found = self.align_pieces(new)
        every = self.known.joined(found)
        placed = dict(zip(new, range(len(place), len(place) + len(new))))
        sizes = np.array([len(pieces) for pieces, _ in rows], np.int64)
        at = np.fromiter(chain.from_iterable([placed[p] if n is None else n for p, n in zip(*row)] for row in rows),
                         np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(rows)), sizes)
        fits = np.ones(len(rows), bool)
        fits[owner[~every.fits[at]]] = False
        mine = fits[owner]
        at, owner = at[mine], owner[mine]
        sums = [np.bincount(owner, column[at], len(rows)).astype(np.int64) for column in every.counts.T]
        lists, upto = at.tolist(), np.cumsum(np.where(fits, sizes, 0)).tolist()
        groups = ["".join(map(every.texts.__getitem__, lists[i:j]))[:-1] for i, j in zip([0, *upto], upto)]
        out = [*[pa.array(c, pa.int64()) for c in sums], pa.array(groups, pa.string())]
        for counts, starts, values, kind in ((every.same_counts, every.same_starts, every.same, pa.int32()),
                                             (every.pair_counts, every.pair_starts, every.pairs, pa.int64())):
            links = values[ragged(starts[at], counts[at])]
            out += _distinct(np.repeat(owner, counts[at]), links, len(rows), kind)
        self._keep(new, found)
        return pa.record_batch(out, [f.name for f in _FIELDS])


class Pieces:
    """What is known of pieces of text, by number.

    ``fits``: whether the tokens' bytes are the piece's; ``counts``: tokens of A
    and B, groups, links; ``texts``: the groups; ``same``: linked A ids of the same
    bytes, and ``pairs``: other linked pairs, of all pieces in a row.
    """

    def __init__(self, fits, counts, texts, same_counts, same, pair_counts, pairs):
        self.fits, self.counts, self.texts = fits, counts, texts
        self.same_counts, self.same, self.pair_counts, self.pairs = same_counts, same, pair_counts, pairs
        self.same_starts, self.pair_starts = np.cumsum(same_counts) - same_counts, np.cumsum(pair_counts) - pair_counts

    @staticmethod
    def none() -> Pieces:
        empty = np.empty(0, np.int64)
        return Pieces(np.empty(0, bool), np.empty((0, 4), np.int64), [], empty, empty, empty, empty)

    def joined(self, other: Pieces) -> Pieces:
        return Pieces(*[a + b if isinstance(a, list) else np.concatenate([a, b])
                        for a, b in zip(self._columns(), other._columns())])

    def taken(self, at: list[int]) -> Pieces:
        at = np.array(at, np.int64)
        return Pieces(self.fits[at], self.counts[at], [self.texts[i] for i in at.tolist()],
                      self.same_counts[at], self.same[ragged(self.same_starts[at], self.same_counts[at])],
                      self.pair_counts[at], self.pairs[ragged(self.pair_starts[at], self.pair_counts[at])])

    def _columns(self) -> tuple:
        return self.fits, self.counts, self.texts, self.same_counts, self.same, self.pair_counts, self.pairs


def _distinct(owner: np.ndarray, values: np.ndarray, rows: int, kind: pa.DataType) -> tuple[pa.ListArray, pa.ListArray]:
    """Per row, the distinct numbers (below 2^32) that it owns and how often each occurs."""
    keys, n = np.unique(owner << 32 | values, return_counts=True)
    ends = np.searchsorted(keys >> 32, np.arange(rows + 1)).astype(np.int32)
    lists = (keys & 0xFFFFFFFF).astype(kind.to_pandas_dtype()), n.astype(np.int32)
    return tuple(pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in lists)


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker process; the files must be readable on the workers."""
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, with its alignment.

    n_a, n_b, n_groups, n_links; ``groups``: the ids of each group as text
    (``a1,a2|b1;a3|b2,b3``); same_ids, same_links: distinct A ids linked to the B id of
    the same bytes, and how often; pairs, pair_links: the other linked pairs
    (a * size of B's vocabulary + b), and how often. No special tokens: their
    strings within texts are plain text. Null and empty texts, and those whose tokens do
    not give back the bytes of a space and the text, have no tokens. Every row is
    kept, repeated ones too; an empty table gives an empty result.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("document"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["document"], *_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)

        def part(documents: pa.Array, group: list[str]) -> pa.RecordBatch:
            found = own.align(group)
            return pa.record_batch([documents, *found.columns], schema.names)

        for batch in batches:
            documents, start, group, size = batch.column(0), 0, [], 0
            for i, value in enumerate(batch.column(1)):
                group.append(value.as_py() or "")
                size += len(group[-1])
                if size > GROUP_CHARACTERS // 2:      # the text of the groups is several times as long
                    yield part(documents.slice(start, i + 1 - start), group)
                    start, group, size = i + 1, [], 0
            if group:
                yield part(documents.slice(start), group)

    found = rows.mapInArrow(run, schema)
    return found.select(*[F.col("document").getField(c).alias(c) for c in keep], *[f.name for f in _FIELDS])


def _combined(rows: DataFrame, column: str, key: str, length: int | None = None) -> DataFrame:
    """(key, documents): in how many rows each number of a column of distinct numbers is, combined per task.

    With ``length``, tasks count in one vector of that length; else in buffers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(values: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(values), SLICE):
                yield pa.record_batch([pa.array(values[at:at + SLICE], pa.int64()), pa.array(n[at:at + SLICE], pa.int64())],
                                      [key, "documents"])
        vector, held, size = np.zeros(length or 0, np.int64), [], 0
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if length:
                vector += np.bincount(values, minlength=length)
                continue
            held.append(values)
            size += len(values)
            if size > BUFFER:
                yield from out(*np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
        if length:
            held = [np.flatnonzero(vector)]
            yield from out(held[0], vector[held[0]])
        elif held:
            yield from out(*np.unique(np.concatenate(held), return_counts=True))

    counted = rows.select(column).mapInArrow(run, f"{key} bigint, documents bigint")
    return counted.groupBy(key).agg(F.sum("documents").alias("documents"))


def _head(counts: DataFrame, most: int) -> DataFrame:
    """The pairs above a count that at most ``most`` pairs reach, found from a histogram of counts."""
    bucket = F.floor(F.log2(F.col("documents").cast("double")) * 8)
    total, bound = 0, None
    for row in counts.groupBy(bucket.alias("c")).count().orderBy(F.col("c").desc()).collect():  # a few hundred rows
        total += row["count"]
        if total > most:
            break
        bound = row["c"]
    return counts.where(bucket >= bound) if bound is not None else counts.limit(0)


def score_links(aligned: DataFrame, a_path: str, b_path: str, head: int = HEAD) -> DataFrame:
    """Replace the lists of ``align`` by n_best and count_sum, from the counts of all its rows.

    The count of a pair is the number of rows that hold it linked. n_best: links
    whose count is the highest of their A id, ties included; count_sum: the counts
    of all links added up.
    """
    # Stored, so that texts are tokenised once and a row's key is the same for every later read.
    table = stored(aligned.withColumn("_key", F.monotonically_increasing_id()))
    own = aligner(a_path, b_path)
    size_a, size_b = len(own.a_bytes), own.size_b
    # One number per A id at most.
    same = _combined(table, "same_ids", "a", size_a).toArrow()
    same_counts = np.zeros(size_a, np.int64)
    same_counts[same["a"].to_numpy()] = same["documents"].to_numpy()
    counts = stored(_combined(table, "pairs", "pair"))
    highest = counts.groupBy(F.floor(F.col("pair") / size_b).cast("bigint").alias("a")).agg(F.max("documents").alias("n")).toArrow()
    best = same_counts.copy()
    best[highest["a"].to_numpy()] = np.maximum(best[highest["a"].to_numpy()], highest["n"].to_numpy())
    frequent = _head(counts, head).toArrow()
    order = np.argsort(frequent["pair"].to_numpy())
    shared = table.sparkSession.sparkContext.broadcast(
        (same_counts, best, frequent["pair"].to_numpy()[order], frequent["documents"].to_numpy()[order]))
    schema = "_key bigint, pair bigint, links bigint, n_best bigint, count_sum bigint"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same_counts, best, pairs, pair_counts = shared.value

        def lists(batch: pa.RecordBatch, ids: str, links: str) -> tuple[np.ndarray, ...]:
            values, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (ids, links))
            lengths = batch.column(ids).value_lengths().to_numpy(zero_copy_only=False)
            return values, n, np.repeat(np.arange(batch.num_rows), lengths)

        def total(owner: np.ndarray, n: np.ndarray, rows: int) -> np.ndarray:
            out = np.zeros(rows, np.int64)
            np.add.at(out, owner, n)
            return out

        for batch in batches:
            rows, keys = batch.num_rows, batch.column("_key").to_numpy()
            a, n, owner = lists(batch, "same_ids", "same_links")
            sums = total(owner, n * same_counts[a], rows)
            bests = total(owner, n * (same_counts[a] == best[a]), rows)
            pair, n, owner = lists(batch, "pairs", "pair_links")
            at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            met = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            count = pair_counts[at[met]]
            sums += total(owner[met], n[met] * count, rows)
            bests += total(owner[met], n[met] * (count == best[pair[met] // size_b]), rows)
            rest = ~met
            zeros = np.zeros(int(rest.sum()), np.int64)
            # A row's own sums come with a number that no pair has.
            columns = [np.concatenate(c) for c in (
                (keys, keys[owner[rest]]), (-1 - keys % 65536, pair[rest]), (np.zeros(rows, np.int64), n[rest]),
                (bests, zeros), (sums, zeros))]
            out = pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["_key", "pair", "links", "n_best", "count_sum"])
            for start in range(0, out.num_rows, SLICE):
                yield out.slice(start, SLICE)

    parts = table.select("_key", *_LISTS).mapInArrow(add, schema)
    highest_of = table.sparkSession.createDataFrame(
        pa.table({"_a": pa.array(np.arange(size_a)), "_best": pa.array(best)}))  # bounded by A's vocabulary
    rare = counts.select("pair", "documents").join(
        F.broadcast(highest_of), F.floor(F.col("pair") / size_b) == F.col("_a")).select("pair", "documents", "_best")
    joined = parts.join(rare, "pair", "left")
    sums = joined.groupBy("_key").agg(
        F.sum(F.col("n_best") + F.when(F.col("documents") == F.col("_best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("count_sum") + F.coalesce(F.col("links") * F.col("documents"), F.lit(0))).alias("count_sum"))
    return table.drop(*_LISTS).join(sums, "_key").drop("_key")


def pair_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a_id, b_id, documents): in how many rows of ``align`` each pair of ids is linked."""
    own = aligner(a_path, b_path)
    size_b = own.size_b
    spark = aligned.sparkSession
    table = stored(aligned.select("same_ids", "pairs"))
    same_of = spark.createDataFrame(pa.table({"a": pa.array(np.arange(len(own.same))), "b": pa.array(own.same)}))
    same = _combined(table, "same_ids", "a", len(own.same)).join(F.broadcast(same_of), "a")
    other = _combined(table, "pairs", "pair").select(
        F.floor(F.col("pair") / size_b).cast("bigint").alias("a"), F.pmod("pair", F.lit(size_b)).alias("b"), "documents")
    both = same.select("a", "b", "documents").unionByName(other)
    return both.select(F.col("a").cast("int").alias("a_id"), F.col("b").cast("int").alias("b_id"), "documents")
