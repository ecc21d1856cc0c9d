import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import speculative_bpe as sb
from tidemark.llm.catalog import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return sb.Codec(sb.Vocabulary(PATH))


def merge(own, words):
    ids, counts = own._merge(words)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def same(own, library, texts):
    ids = own.encode_all(texts)
    for text, got, want in zip(texts, ids, library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == want.ids, text[:80]
        assert own.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_odd_texts(own, library):
    same(own, library, [
        "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n b", "\n", "it's I'LL we'll'll 's", "x" * 3000, "ab" * 700, "aaaaaaaaa",
        "<|endoftext|>", " <|endoftext|> a", "a<|endoftext|><|endoftext|>b c", "<|endoftext", "naïve Ärger ﬁ 漢字 カナ", "🙂🙃 👩‍👩‍👧",
        " x   y", " a b  c", "\x1c\x1d a\x1f b", "\x00\x01 \x7f", "\u0085 a", "é ́x", "1234567 ½ ²³ ٣٤",
        "﻿a", "퟿", "\U0010ffff", "a\r\nb\tc", "-----=====", "http://x.org/a?b=1&c=%20", "don't  stop' s"])


def test_every_character(own, library):
    rng = random.Random(1)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = ["".join(f"a{c} {c}b1{c}" for c in every[at:at + 2000]) for at in range(0, len(every), 2000)]
    same(own, library, rows[:40] + rng.sample(rows, 30))


def test_random_words(own, library):
    rng = random.Random(2)
    small = "aeinrst"
    texts = [" ".join("".join(rng.choice(small) for _ in range(rng.randint(1, 14))) for _ in range(400)) for _ in range(10)]
    texts += ["".join(rng.choice("ab \n'sé漢<|>1") for _ in range(3000)) for _ in range(10)]
    before = own.words, own.merges
    same(own, library, texts)
    # words that the proposal gets right do not undergo merging, others do
    assert 0 < own.merges - before[1] < own.words - before[0]


def test_documents(own, library):
    import pyarrow.parquet as pq
    texts = [t or "" for t in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()]
    same(own, library, texts)
    kept = dict(own.kept)
    same(own, library, texts)                     # now with known pieces
    assert kept


def test_pairs_that_stay_apart_are_those_that_bpe_keeps(own):
    v = own.vocabulary
    rng = np.random.default_rng(4)
    tokens = [b.decode("latin-1") for b in v.bytes]
    a, b = rng.integers(0, 2000, 3000), rng.integers(0, 2000, 3000)
    apart = v.compatible(a, b)
    merged = merge(own, [tokens[i] + tokens[j] for i, j in zip(a, b)])
    want = [m == [i, j] for m, i, j in zip(merged, a, b)]
    assert apart.tolist() == want and 0 < sum(want) < 3000


def test_sound_tokens_are_their_own_encoding(own):
    v = own.vocabulary
    ids = [i for i, t in enumerate(v.bytes) if t and i not in v.added.values()][::7]
    merged = merge(own, [v.bytes[i].decode("latin-1") for i in ids])
    assert [m == [i] for m, i in zip(merged, ids)] == v.sound[ids].tolist()


def test_long_words_merge_like_short_ones(own, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 400))).encode().decode("latin-1") for _ in range(40)] + ["a" * 333]
    want = merge(own, words)
    monkeypatch.setattr(sb, "LONG_WORD", 0)
    assert merge(own, words) == want
    monkeypatch.setattr(sb, "LONG_WORD", 150)
    assert merge(own, words) == want


def test_unsound_tokens_and_overlapping_merges(tmp_path):
    # "abc" is in the vocabulary, but bc merges before ab does: BPE never makes it.
    chars = sorted(sb.byte_characters())
    merges = [["b", "c"], ["a", "b"], ["ab", "c"], ["a", "a"], ["aa", "a"], ["aa", "aa"], ["x", "aa"]]
    vocab = {t: i for i, t in enumerate(chars + ["".join(m) for m in merges])}
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["added_tokens"] = []
    spec["model"].update(vocab=vocab, merges=merges)
    path = str(tmp_path / "small.json")
    json.dump(spec, open(path, "w", encoding="utf-8"))
    own, library = sb.Codec(sb.Vocabulary(path)), Tokenizer.from_file(path)
    assert not own.vocabulary.sound[vocab["abc"]]
    rng = random.Random(6)
    same(own, library, ["abc aabc", *["".join(rng.choice("abcx") for _ in range(rng.randint(1, 12))) for _ in range(500)]])
    # A file that the method does not cover is refused.
    spec["model"]["byte_fallback"] = True
    json.dump(spec, open(path, "w", encoding="utf-8"))
    with pytest.raises(ValueError):
        sb.Vocabulary(path)


def test_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(sb, "CACHE_PIECES", 50)
    own = sb.Codec(sb.Vocabulary(PATH))
    rng = random.Random(7)
    for _ in range(30):
        same(own, library, [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 4))) for _ in range(60))])


def test_frames(spark, documents, library):
    rows = [(1, None), (1, None), (2, ""), (3, "plain <|endoftext|> text"), (None, "x" * 20000 + " é"), (3, "plain <|endoftext|> text")]
    docs = documents(rows).withColumnRenamed("simhash", "token_ids")
    got = sb.encode_documents(docs, PATH)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "word", "n", "token_ids", "decoded"]
    found = sorted(((r.text or "", np.frombuffer(bytes(r.token_ids), "<u4").tolist(), r.decoded) for r in got.collect()))
    assert found == sorted((t or "", library.encode(t or "", add_special_tokens=False).ids, t or "") for _, t in rows)
    plain = sb.encode_documents(docs, PATH, special=False).collect()
    assert all(50256 not in np.frombuffer(bytes(r.token_ids), "<u4") and r.decoded == (r.text or "") for r in plain)
    assert sb.encode_documents(documents([]), PATH).collect() == []
    lists = docs.select("text", sb.encode("text", PATH).alias("ids")).select("*", sb.decode("ids", PATH).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in lists)


def test_query_is_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(back.encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op12_speculative_bpe"](spark, SF).collect()} == want
