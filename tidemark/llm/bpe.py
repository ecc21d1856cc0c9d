"""Byte-level BPE through sentencepiece, with a model written straight from a rank vocabulary.

Every byte is mapped to one character, every token of the vocabulary becomes a
BPE piece of those characters scored by its negative rank, and normalisation is
the identity. sentencepiece then merges the adjacent pair with the best score,
leftmost first, which is the lowest rank, as rank-file encoders do. A text is
first cut into pre-tokens by the tokenizer's pattern; a pre-token that is itself
in the vocabulary is its own token. Decoding maps ids back to their bytes.

Pre-tokens never span a single space between two other characters (a space
only starts one), so texts are cut there and the ids of a piece are kept in a
bounded table per worker process.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CACHE_PIECES = 200_000
CACHE_LENGTH = 64
GROUP_CHARACTERS = 1 << 20

# Letters and numbers that are newer than the character tables
# (Unicode 16) of the tokenizer library, which treats them as other characters.
NEW_LETTERS = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    r"\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    r"\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3"
    r"\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    r"\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    r"\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5"
    r"\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    r"\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
NEW_NUMBERS = r"\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"

# Where a text can be cut: one space between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
FIRST_CHARACTER = np.uint16(0x100)  # stands for byte 0, the next for byte 1, ...


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _characters(tokens: list[bytes]) -> list[str]:
    """Each token with one character for every byte."""
    data = np.frombuffer(b"".join(tokens), np.uint8)
    text = (data.astype("<u2") + FIRST_CHARACTER).tobytes().decode("utf-16-le")
    ends = [0, *accumulate(map(len, tokens))]
    return [text[i:j] for i, j in zip(ends, ends[1:])]


def _field(number: int, value: bytes | int) -> bytes:
    """One protobuf field: a varint, or bytes with their length."""
    def varint(n: int) -> bytes:
        out = b""
        while n > 0x7F:
            out += bytes([n & 0x7F | 0x80])
            n >>= 7
        return out + bytes([n])
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def sentencepiece_model(ranks: dict[bytes, int]) -> tuple[bytes, list[bytes]]:
    """A serialised BPE model and its tokens, in the order of its ids.

    Fields of the public model format: pieces (1) of text (1), score (2) and kind
    (3; 2 is the unknown piece); trainer settings (2) with the model kind (3;
    2 is BPE); normaliser settings (3) with its name (1), no dummy prefix (3), no
    removal of extra spaces (4) and no escaping of spaces (5).
    """
    tokens = sorted(ranks, key=ranks.__getitem__)
    pieces = [_field(1, _field(1, text.encode()) + b"\x15" + struct.pack("<f", -ranks[token]))
              for text, token in zip(_characters(tokens), tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _field(3, 2)))
    trainer = _field(2, _field(3, 2))
    normaliser = _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return b"".join(pieces) + trainer + normaliser, tokens


def compile_pattern(pattern: str) -> regex.Pattern:
    """The pre-token pattern, with the character classes of the tokenizer library."""
    letters = rf"[\p{{L}}--[{NEW_LETTERS}]]"
    numbers = rf"[\p{{N}}--[{NEW_NUMBERS}]]"
    return regex.compile(pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers), regex.V1)


class Codec:
    """Encodes texts to token ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        model, tokens = sentencepiece_model(ranks)
        self.ranks, self.pattern = ranks, compile_pattern(pattern)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rank_of = np.array([ranks[t] for t in tokens], "<i4")
        self.kept: dict[str, bytes] = {}
        self.passed = 0  # pieces not kept since the table was full

    def _tokens(self, pre_tokens: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens as little-endian 32-bit integers; those outside the vocabulary in one call."""
        out, merged = {}, []
        for token in pre_tokens:
            rank = self.ranks.get(token.encode())
            if rank is None:
                merged.append(token)
            else:
                out[token] = rank.to_bytes(4, "little")
        if merged:
            found = self.pieces.EncodeAsIds(_characters([t.encode() for t in merged]), num_threads=1)
            ids = self.rank_of[np.fromiter(chain.from_iterable(found), np.int64)].tobytes()
            ends = [0, *accumulate(4 * len(f) for f in found)]
            out.update(zip(merged, [ids[i:j] for i, j in zip(ends, ends[1:])]))
        return out

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces of text that each follow a space."""
        # Pieces without a space are cut into pre-tokens together: each starts a
        # pre-token with the space before it, and no other pre-token has one.
        plain = [p for p in pieces if " " not in p]
        other = {p: self.pattern.findall(" " + p) for p in pieces if " " in p}
        tokens = self.pattern.findall(" " + " ".join(plain)) if plain else []
        ids = self._tokens({*tokens, *chain.from_iterable(other.values())})
        starts = [i for i, t in enumerate(tokens) if t[0] == " "] + [len(tokens)]
        found = list(map(ids.__getitem__, tokens))
        new = {p: found[i] if j - i == 1 else b"".join(found[i:j]) for p, i, j in zip(plain, starts, starts[1:])}
        new.update((p, b"".join(map(ids.__getitem__, row))) for p, row in other.items())
        self._keep(new)
        return new

    def _keep(self, new: dict[str, bytes]) -> None:
        """Fill the table with the pieces met first, mostly frequent ones; start anew after many others."""
        if len(self.kept) + len(new) <= CACHE_PIECES:
            self.kept.update((p, i) for p, i in new.items() if len(p) <= CACHE_LENGTH)
        else:
            self.passed += len(new)
            if self.passed > 8 * CACHE_PIECES:
                self.kept.clear()
                self.passed = 0

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text; pieces not met before are encoded together."""
        rows, missing = [], set()
        for text in texts:
            first, *rest = text.split(" ")
            found = list(map(self.kept.get, rest))
            gaps = [p for p, f in zip(rest, found) if f is None]
            # Only pieces without white space at their ends are ever kept.
            if rest and (not first or first[-1].isspace() or "" in gaps or list(map(str.strip, gaps)) != gaps):
                first, *rest = _CUT.split(text)
                found = list(map(self.kept.get, rest))
                gaps = [p for p, f in zip(rest, found) if f is None]
            missing.update(gaps)
            rows.append((self.pattern.findall(first), rest, found))
        new = self._learn(list(missing)) if missing else {}
        starts = self._tokens({t for first, _, _ in rows for t in first})
        return [np.frombuffer(b"".join([starts[t] for t in first])
                              + b"".join([new[p] if f is None else f for p, f in zip(rest, found)]), "<i4")
                for first, rest, found in rows]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process; the vocabulary file must be readable on the workers."""
    return Codec(read_ranks(path), pattern)


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes of every token id."""
    return {rank: token for token, rank in read_ranks(path).items()}


def _encoded(own: Codec, texts: pa.Array) -> list[np.ndarray]:
    ids, group, size = [], [], 0
    for t in texts:
        group.append(t.as_py() or "")
        size += len(group[-1])
        if size > GROUP_CHARACTERS:
            ids += own.encode_all(group)
            group, size = [], 0
    return ids + own.encode_all(group)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def encode(text: str | Column, path: str, pattern: str) -> Column:
    """Token ids (array of int) of a text column; null and empty texts give an empty array."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _lists(_encoded(codec(path, pattern), texts))

    # So marked, the optimizer evaluates it once, also where the ids are used twice.
    return encoded.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def round_trip(text: str | Column, path: str, pattern: str) -> Column:
    """Token ids and the bytes that these decode to (struct ids, decoded), in one worker."""

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def coded(texts: pa.Array) -> pa.Array:
        known = token_bytes(path).__getitem__
        ids = _encoded(codec(path, pattern), texts)
        back = pa.array((b"".join(map(known, i.tolist())) for i in ids), pa.binary(), size=len(ids))
        return pa.StructArray.from_arrays([_lists(ids), back], ["ids", "decoded"])

    return coded.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def decode(ids: str | Column, path: str) -> Column:
    """Bytes of an array of token ids; null gives empty bytes, an unknown id fails."""

    @F.arrow_udf("binary")
    def decoded(rows: pa.Array) -> pa.Array:
        known = token_bytes(path).__getitem__
        return pa.array([b"".join(map(known, r.values.to_pylist())) if r.is_valid else b"" for r in rows], pa.binary())

    return decoded(F.col(ids) if isinstance(ids, str) else ids)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids",
                     decoded: str | None = "decoded") -> DataFrame:
    """Add token ids and, unless ``decoded`` is None, the bytes they decode to.

    Whole texts, no special tokens. Columns of these names are replaced; every
    row is kept, repeated ones too.
    """
    if decoded is None:
        return docs.withColumn(ids, encode(text, path, pattern))
    both = docs.select(F.struct(*docs.columns).alias("_document"), round_trip(F.col(text), path, pattern).alias("_coded"))
    kept = [F.col("_document").getField(c).alias(c) for c in docs.columns if c not in (ids, decoded)]
    return both.select(*kept, F.col("_coded.ids").alias(ids), F.col("_coded.decoded").alias(decoded))
