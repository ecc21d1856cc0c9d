import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tidemark.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    ranks = bpe.read_ranks(PATH)
    return bpe.Codec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n", "it's they'll I'D x 's", "don't  stop\t\tnow ", "<|endoftext|>",
         "1234567 12 ٣٤", "Émile était là … “quoted”", "漢字かな交じり文 テスト", "🙂🙃 👩‍👩‍👧", "a b  c\x1c d\x1f", "é ́x",
         "aaaa" * 5000, "x" * 100 + " " + "y" * 300, "tab\tsep\r\nline", "   lead", "trail   ", ". \nNext", "\U00033000꟎ a\U0003d000", "a " * 3000]


def test_matches_the_library(pair):
    own, library = pair
    rng = random.Random(4)
    alphabet = "ab eE's'  \n\t1!é漢́ 🙂\x1c"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)]
    for t in texts:
        ids = own.encode(t).tolist()
        assert ids == library.encode_ordinary(t), repr(t)
        assert b"".join(map(bpe.token_bytes(PATH).__getitem__, ids)) == t.encode()


def test_every_character_class(pair):
    own, library = pair
    for block in range(0, 0x110000, 64):
        t = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}!" for c in range(block, block + 64) if not 0xD800 <= c < 0xE000)
        assert own.encode(t).tolist() == library.encode_ordinary(t), hex(block)


def test_small_cache_changes_nothing(pair, monkeypatch):
    own, library = pair
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    own.kept.clear()
    t = "one two three four five six one two three " * 5
    assert own.encode(t).tolist() == library.encode_ordinary(t)


def test_query(spark, documents, pair, monkeypatch):
    from tidemark.llm import catalog
    docs = documents([(i // 2, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, None)])
    monkeypatch.setattr(catalog, "read_table", lambda *a: docs)
    got = catalog.op2_byte_bpe(spark, "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in docs.collect():
        ids = pair[1].encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=repr) == sorted(want, key=repr)
    assert got.schema["n_tokens"].dataType.simpleString() == "bigint"
    monkeypatch.setattr(catalog, "read_table", lambda *a: docs.where("doc_id > 1000"))
    assert catalog.op2_byte_bpe(spark, "").count() == 0


def test_whole_table_round_trip(spark):
    from tidemark.llm.catalog import op2_byte_bpe
    from pyspark.sql import functions as F
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet")
    joined = op2_byte_bpe(spark, sf).join(texts.select("doc_id", F.sha2("text", 256).alias("want")), "doc_id")
    assert joined.count() == texts.count() and joined.where("want <> decoded_sha256").count() == 0
