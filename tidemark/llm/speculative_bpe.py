"""Byte-level BPE by speculation and verification, for vocabularies with a list of merges.

BPE merges the adjacent pair of the lowest rank first, leftmost first. A row of
tokens is what it makes of their bytes if each token is what it makes of the
token's own bytes and every two neighbours stay apart when they are merged
by themselves. So words (pre-tokens) are encoded in three steps, each over
many words at once:

1. propose: greedy longest-match tokens, by one automaton over all words;
2. verify: every distinct pair of neighbours is taken apart, in arrays: of the two
   tokens, the one formed last is undone until both are bytes at the border,
   and the pair is rejected when a merge across the border would have come first;
3. merge: only words with a rejected pair, or a token that BPE does not make of its own
   bytes, undergo exact merging.

Texts are cut at added tokens first, as the library does. Between them, a pre-token
never spans a single space between two other characters (a space only starts
one), so texts are cut there, and the ids of a piece are kept in a bounded table
per worker process. Pieces of other than ASCII characters are cut into
pre-tokens by the tokenizer's own pre-tokenizer, whose character classes hold.
Decoding maps ids back to their bytes.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from itertools import chain, repeat
from operator import ne

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CACHE_PIECES = 200_000
CACHE_LENGTH = 64
GROUP_CHARACTERS = 1 << 20
LONG_WORD = 512               # bytes; longer words are merged one at a time, with a heap

# The cut of the byte-level pre-tokenizer, on ASCII texts.
_ASCII_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", regex.A)
# Where a text can be cut: one space between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_LATIN_END = "\u0250"         # letters before it are letters in every version of the character tables
_BETWEEN = "Ā"           # no byte's character
_NONE = np.int64(1) << 60     # rank of a pair that does not merge


def byte_characters() -> dict[str, int]:
    """The byte of every character of a byte-level vocabulary: printable bytes stand for themselves,
    the others are numbered from 256."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _slots(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    factor = np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(level << 20)
    return ((keys.astype(np.uint64) * factor) >> np.uint64(64 - bits)).astype(np.int64)


def _hash_levels(keys: np.ndarray, values: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Hash tables for array lookups: keys whose slot is taken go to the next table."""
    out = []
    while len(keys):
        bits = len(keys).bit_length() + 2
        slots = _slots(keys, len(out), bits)
        held, kept = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        held[slots], kept[slots] = keys, values
        out.append((bits, held, kept))
        left = held[slots] != keys
        keys, values = keys[left], values[left]
    return out


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


class Vocabulary:
    """Tokens and merges of a byte-level BPE file of the tokenizers library.

    ``rank`` of a token is that of its merge, counted from one (bytes: 0);
    ``left`` and ``right`` are the tokens that it merges. Files with other
    parts than these (prefix spaces, normalisers, dropout, several merges of one
    token, ...) are refused.
    """

    def __init__(self, path: str):
        import tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = (model["type"] == "BPE" and spec["normalizer"] is None and spec["post_processor"] is None
                 and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        added = spec["added_tokens"]
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        self.pre_tokenizer = tokenizers.Tokenizer.from_file(path).pre_tokenizer
        self.added = {t["content"]: t["id"] for t in added}
        byte_of, ids = byte_characters(), model["vocab"]
        size = 1 + max([*ids.values(), *self.added.values()])
        self.bytes = [b""] * size
        for token, i in ids.items():
            self.bytes[i] = bytes(map(byte_of.__getitem__, token))
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.left, self.right, self.rank = (np.zeros(size, np.int64) for _ in range(3))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        a, b = (np.array([ids[p[j]] for p in pairs], np.int64) for j in (0, 1))
        made = np.array([ids[x + y] for x, y in pairs], np.int64)
        if len(np.unique(made)) != len(made) or len(ids) != len(made) + 256:
            raise ValueError(f"{path} has tokens without a merge, or with several")
        self.left[made], self.right[made], self.rank[made] = a, b, np.arange(1, len(made) + 1)
        self._levels = _hash_levels(a << 32 | b, made)
        self.byte_ids = np.array([ids[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])], np.int64)
        # Whether BPE makes a token of its own bytes: it makes its two parts, which stay apart until its merge.
        order = np.argsort(self.rank)
        apart = (self.compatible(self.left, self.right, self.rank) & (self.rank[self.left] < self.rank)
                 & (self.rank[self.right] < self.rank))
        self.sound = np.zeros(size, bool)
        sound, parts = apart.tolist(), (self.left.tolist(), self.right.tolist(), self.rank.tolist())
        for i in order.tolist():
            if parts[2][i]:
                sound[i] = sound[i] and sound[parts[0][i]] and sound[parts[1][i]]
            else:
                sound[i] = True
        self.sound[:] = sound

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, or -1."""
        keys = a << 32 | b
        out = np.full(len(keys), -1, np.int64)
        open_ = None
        for level, (bits, held, made) in enumerate(self._levels):
            slots = _slots(keys, level, bits)
            found = held[slots]
            hit = found == keys
            if open_ is None:
                out = np.where(hit, made[slots], -1)
            else:
                out[open_[hit]] = made[slots[hit]]
            more = np.flatnonzero(~hit & (found >= 0))    # another pair's slot: the pair may be on the next level
            open_, keys = more if open_ is None else open_[more], keys[more]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE keeps the border between neighbours a and b, of all merges or those before rank ``until``.

        The tokens are taken apart from the last merge to the first. A merge across
        the border comes first if its rank is lower than that of the merge which
        takes its left token away, or not higher than that of the merge which takes
        its right one (of equal ranks, the leftmost comes first).
        """
        out = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        limit = np.full(len(a), _NONE) if until is None else until.copy()
        a, b = a.copy(), b.copy()
        while len(open_):
            made = self.merged(a, b)
            crossed = (made >= 0) & (np.where(made >= 0, self.rank[made], _NONE) < limit)
            out[open_[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossed & ((ra > 0) | (rb > 0))
            open_, a, b, ra, rb = open_[go], a[go], b[go], ra[go], rb[go]
            undo_left = ra > rb          # of equal ranks, the right one was formed last
            limit = np.where(undo_left, ra, rb + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return out


class Codec:
    """Encodes texts to token ids and back; ``special``: added tokens in a text become their ids."""

    def __init__(self, vocabulary: Vocabulary, special: bool = True):
        import ahocorasick

        self.vocabulary = vocabulary
        self.special = regex.compile("|".join(
            regex.escape(t) for t in sorted(vocabulary.added, key=len, reverse=True))) if special and vocabulary.added else None
        self.longest = ahocorasick.Automaton()
        added = set(vocabulary.added.values())
        self.own: dict[str, int] = {}
        for i, token in enumerate(vocabulary.bytes):
            if token and i not in added:
                self.longest.add_word(token.decode("latin-1"), i)
                if vocabulary.sound[i]:
                    self.own[token.decode("latin-1")] = i
        self.longest.make_automaton()
        self.lengths = np.array([len(t) for t in vocabulary.bytes], np.int64)
        self.kept: dict[str, bytes] = {}
        self.passed = 0       # pieces not kept since the table was full
        self.words = self.merges = 0  # words that were encoded, and those that underwent exact merging

    # -- words: strings with one character for every byte

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and ids per word."""
        own = np.fromiter(map(self.own.get, words, repeat(-1)), np.int64, len(words))
        self.words += len(words)
        counts = np.ones(len(words), np.int64)
        several = np.flatnonzero(own < 0)
        if not len(several):
            return own, counts
        rows = [words[n] for n in several.tolist()]
        proposed, sizes, right = self._propose(rows)
        wrong = np.flatnonzero(~right)
        merged, merged_sizes = self._merge([rows[n] for n in wrong.tolist()])
        self.merges += len(wrong)
        counts[several] = sizes
        counts[several[wrong]] = merged_sizes
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        alone = np.flatnonzero(own >= 0)
        out[starts[alone]] = own[alone]
        out[ragged(starts[several[right]], sizes[right])] = proposed[np.repeat(right, sizes)]
        out[ragged(starts[several[wrong]], merged_sizes)] = merged
        return out, counts

    def _propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest-match ids of all words in a row, ids per word, and which words are verified."""
        found = np.fromiter(chain.from_iterable(self.longest.iter_long(_BETWEEN.join(words))), np.int64).reshape(-1, 2)
        last, ids = found[:, 0], found[:, 1]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1)
        owner = np.searchsorted(ends, last, "right")
        counts = np.bincount(owner, minlength=len(words))
        right = np.bincount(owner, self.lengths[ids], len(words)).astype(np.int64) == sizes  # every byte has a token
        right[owner[~self.vocabulary.sound[ids]]] = False
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(ids[inside] << 32 | ids[inside + 1], return_inverse=True)
        apart = self.vocabulary.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        right[owner[inside[~apart[which]]]] = False
        return ids, counts, right

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging, as ids of all words in a row and ids per word: in every word, the pair of the lowest rank
        wherever it stands, leftmost first, until none merges."""
        done_ids, done_words = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.flatnonzero(sizes > LONG_WORD).tolist():
            done_ids.append(self._merge_long(words[n]))
            done_words.append(np.full(len(done_ids[-1]), n))
        short = np.flatnonzero(sizes <= LONG_WORD)
        data = "".join([words[n] for n in short.tolist()]).encode("latin-1")
        ids = self.vocabulary.byte_ids[np.frombuffer(data, np.uint8)]
        owner = np.repeat(short, sizes[short])
        while len(ids):
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            made = np.full(len(ids), -1, np.int64)
            made[inside] = self.vocabulary.merged(ids[inside], ids[inside + 1])
            rank = np.where(made >= 0, self.vocabulary.rank[made], _NONE)
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            done = least == _NONE
            done_ids.append(ids[done])
            done_words.append(owner[done])
            chosen = (rank == least) & ~done
            # Of a run of chosen places, every other one merges, the first included.
            again = chosen & np.concatenate([[False], chosen[:-1]])
            if again.any():
                place = np.arange(len(ids))
                begins = np.maximum.accumulate(np.where(chosen & ~again, place, 0))
                chosen &= (place - begins) % 2 == 0
            ids = np.where(chosen, made, ids)
            stays = ~done
            stays[1:] &= ~chosen[:-1]
            ids, owner = ids[stays], owner[stays]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def _merge_long(self, word: str) -> np.ndarray:
        """The same with a heap of pairs, for one long word."""
        v = self.vocabulary
        ids = v.byte_ids[np.frombuffer(word.encode("latin-1"), np.uint8)]
        made = v.merged(ids[:-1], ids[1:])
        pairs = self._pairs
        rank = v.rank
        heap = [(int(rank[m]), i, int(m)) for i, m in enumerate(made.tolist()) if m >= 0]
        heapq.heapify(heap)
        ids = ids.tolist()
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        while heap:
            _, i, m = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or pairs.get((ids[i], ids[j])) != m:
                continue             # one of the two is merged already
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else -1
                if y >= 0:
                    new = pairs.get((ids[x], ids[y]))
                    if new is not None:
                        heapq.heappush(heap, (int(rank[new]), x, new))
        return np.array([i for i in ids if i >= 0], np.int64)

    @functools.cached_property
    def _pairs(self) -> dict[tuple[int, int], int]:
        v = self.vocabulary
        made = np.flatnonzero(v.rank)
        return dict(zip(zip(v.left[made].tolist(), v.right[made].tolist()), made.tolist()))

    # -- texts

    def pre_tokens(self, text: str) -> list[str]:
        """The words of a text."""
        if text.isascii():
            return _ASCII_WORDS.findall(text)
        cut = self.vocabulary.pre_tokenizer.pre_tokenize_str(text)
        return [text[i:j].encode().decode("latin-1") for _, (i, j) in cut]

    def encode_rows(self, words: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of so many words, all in a row, and ids per row of words."""
        ids, counts = self.encode_words(words)
        upto = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
        return ids, np.diff(upto)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of text that each follow a space: all in a row, and ids per piece."""
        letters, plain, other, odd = [], [], [], []
        for n, piece in enumerate(pieces):
            if piece.isalpha() and (piece.isascii() or max(piece) < _LATIN_END):
                letters.append(n)        # one word
            elif piece != piece.strip() or " " in piece or not piece:
                odd.append(n)
            else:
                (plain if piece.isascii() else other).append(n)
        words, sizes = [], [np.ones(len(letters), np.int64)]
        if letters:
            words += map(" ".__add__, " ".join([pieces[n] for n in letters]).encode().decode("latin-1").split(" "))
        for group in (plain, other):
            # Pieces without a space are cut into words together: each starts a word
            # with the space before it, and no other word has one.
            own = self.pre_tokens(" " + " ".join([pieces[n] for n in group])) if group else []
            starts = [i for i, w in enumerate(own) if w[0] == " "]
            words += own
            sizes.append(np.diff(np.array([*starts, len(own)], np.int64)))
        for n in odd:
            own = self.pre_tokens(" " + pieces[n])
            words += own
            sizes.append(np.array([len(own)]))
        ids, counts = self.encode_rows(words, np.concatenate(sizes))
        order = np.argsort(np.array(letters + plain + other + odd, np.int64))
        starts = np.cumsum(counts) - counts
        return ids[ragged(starts[order], counts[order])], counts[order]

    def _keep(self, new: dict[str, bytes]) -> None:
        """Fill the table with the pieces met first, mostly frequent ones; start anew after many others."""
        if len(self.kept) + len(new) <= CACHE_PIECES:
            self.kept.update((p, ids) for p, ids in new.items() if len(p) <= CACHE_LENGTH)
        else:
            self.passed += len(new)
            if self.passed > 8 * CACHE_PIECES:
                self.kept.clear()
                self.passed = 0

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text; pieces not met before are encoded together."""
        kept, rows, firsts, missing = self.kept, [], [], set()
        for text in texts:
            parts = []               # an added token's id, or the pieces after a first one that is in ``firsts``
            at = 0
            for found in chain(self.special.finditer(text) if self.special else (), [None]):
                part = text[at:found.start() if found else len(text)]
                if part:
                    first, *rest = cut_pieces(part, kept)
                    firsts.append(self.pre_tokens(first))
                    missing.update(rest[2])
                    parts.append(rest)
                if found:
                    parts.append(self.vocabulary.added[found.group()])
                    at = found.end()
            rows.append(parts)
        new = list(missing)
        coded = dict(zip(new, _slices(*self.encode_pieces(new))))
        starts = iter(_slices(*self.encode_rows(list(chain.from_iterable(firsts)), np.array([len(f) for f in firsts], np.int64))))
        out = []
        for parts in rows:
            data = [p.to_bytes(4, "little") if isinstance(p, int) else next(starts) + b"".join(
                [coded[piece] if ids is None else ids for piece, ids in zip(p[0], p[1])]) for p in parts]
            out.append(np.frombuffer(b"".join(data), "<i4"))
        self._keep(coded)
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _slices(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Rows of ids as little-endian 32-bit integers."""
    data, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
    return [data[i:j] for i, j in zip([0, *ends], ends)]


def cut_pieces(text: str, kept: dict) -> tuple[str, list[str], list, list[str]]:
    """A text's start, the pieces after it, which each follow a single space between other characters, what is
    kept of each (or None), and the pieces of which nothing is."""
    rest = text.split(" ")
    first = rest.pop(0)
    found = list(map(kept.get, rest))
    unknown = [p for p, f in zip(rest, found) if f is None]
    # Only pieces without white space at their ends are ever kept.
    if rest and (not first or first[-1].isspace() or "" in unknown or any(map(ne, unknown, map(str.strip, unknown)))):
        first, *rest = _CUT.split(text)
        found = list(map(kept.get, rest))
        unknown = [p for p, f in zip(rest, found) if f is None]
    return first, rest, found, unknown


@functools.lru_cache(maxsize=2)
def codec(path: str, special: bool = True) -> Codec:
    """One codec per worker process; the vocabulary file must be readable on the workers."""
    return Codec(Vocabulary(path), special)


def in_groups(texts: pa.Array, work) -> list:
    """``work`` on the texts (null: empty) of an Arrow array, about a million characters at a time."""
    out, group, size = [], [], 0
    for t in texts:
        group.append(t.as_py() or "")
        size += len(group[-1])
        if size > GROUP_CHARACTERS:
            out += work(group)
            group, size = [], 0
    return out + work(group)


def round_trip(text: str | Column, path: str, special: bool = True) -> Column:
    """Token ids as little-endian 32-bit integers, and the text that they decode to (struct ids, decoded)."""

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def coded(texts: pa.Array) -> pa.Array:
        own = codec(path, special)
        ids = in_groups(texts, own.encode_all)
        return pa.StructArray.from_arrays(
            [pa.array([i.tobytes() for i in ids], pa.binary()), pa.array([own.decode(i) for i in ids], pa.string())],
            ["ids", "decoded"])

    # So marked, the optimizer evaluates it once, also where the result is used twice.
    return coded.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def encode(text: str | Column, path: str, special: bool = True) -> Column:
    """Token ids (array of int) of a text column; null and empty texts give an empty array."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        ids = in_groups(texts, codec(path, special).encode_all)
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))

    return encoded.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def decode(ids: str | Column, path: str) -> Column:
    """The text of an array of token ids; null gives an empty text, an unknown id fails."""

    @F.arrow_udf("string")
    def decoded(rows: pa.Array) -> pa.Array:
        known = codec(path).decode
        return pa.array([known(r.values.to_numpy(zero_copy_only=False)) if r.is_valid else "" for r in rows], pa.string())

    return decoded(F.col(ids) if isinstance(ids, str) else ids)


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded",
                     special: bool = True) -> DataFrame:
    """Add token ids (little-endian 32-bit integers, as tokenised corpora are stored) and the text they decode to.

    Whole texts, no special tokens around them; an added token's string within a
    text is that token, unless ``special`` is false. A null text is an empty one and
    has no ids. Columns of these names are replaced; every row is kept, repeated
    ones too; an empty table gives an empty result.
    """
    both = docs.select(F.struct(*docs.columns).alias("_document"), round_trip(F.col(text), path, special).alias("_coded"))
    kept = [F.col("_document").getField(c).alias(c) for c in docs.columns if c not in (ids, decoded)]
    return both.select(*kept, F.col("_coded.ids").alias(ids), F.col("_coded.decoded").alias(decoded))
