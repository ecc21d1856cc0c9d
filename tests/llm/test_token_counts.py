import random

import public_tokenizers as P
from tokenizers import Tokenizer

from tidemark.llm import token_counts

PATH = P.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "Hello, World!", "hello hello HELLO", "don't they'll I'D 's 't", "<|endoftext|> and <|startoftext|>x<|endoftext|>",
         "<|EndOfText|>", "é é É ΣΑΣ Straße İ", "a　b c d\x1ce\x85f", "12345 ٣ ½", "漢字 かな", "🙂🙃", "x" * 3000,
         "\n\t a \x0b b \x0c", "́ ́x", "a<|endoftext|>", "word " * 20000, " lead", "a​b"]


def brute(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_like_the_library(spark, documents, monkeypatch):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choices("ab'sE <|>é1!\n\t ́", k=rng.randint(1, 80))) for _ in range(150)]
    rows = [(i // 2, t) for i, t in enumerate(texts)] + [(None, "null id"), (7, "same"), (7, "same"), (7, "same")]
    docs = documents(rows)
    want = sorted(((d, len((t or "").encode()), brute(t), brute(t) > 2048) for d, t in rows), key=repr)
    for head, flush in ((1 << 18, 300_000), (5, 20), (0, 3)):
        monkeypatch.setattr(token_counts, "FLUSH", flush)
        token_counts.cutter.cache_clear()
        got = token_counts.count_tokens(docs, PATH, head=head)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert token_counts.count_tokens(docs.where("doc_id > 10000"), PATH).count() == 0


def test_pre_tokens_are_those_of_the_library():
    own, cut = Tokenizer.from_file(PATH), token_counts.Cutter(PATH)
    for text in TEXTS:
        if text and "<|" not in text:
            normal = own.normalizer.normalize_str(text)
            want = [normal[i:j].encode() for _, (i, j) in own.pre_tokenizer.pre_tokenize_str(normal)]
            assert cut(text.encode().split()) == want == cut(text.encode().split())
    assert cut([b"a<|endoftext|>b"]) == [b"a<|endoftext|>b"]
    # The short way for words of letters is that of the library.
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    words = [f"{a}{b}{m}".encode() for a in letters for b in ("", "b", "Z", "é") for m in ("", ",", ".", "!", "-", "'s", "1")]
    assert cut.plain and cut.marks and [cut._pre_tokens(w) for w in words] == [cut._by_library(w.decode()) for w in words]


def test_table_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 5)
    cut, whole = token_counts.Cutter(PATH), token_counts.Cutter(PATH)
    rng = random.Random(4)
    for _ in range(60):
        words = ["".join(rng.choices("abé1,", k=rng.randint(1, 3))).encode() for _ in range(12)]
        assert cut(words) == [p for w in words for p in whole._pre_tokens(w)]


def test_rows_that_share_an_id(spark, documents):
    rows = [(None, "a " * 40), (None, "b" * 26), (3, "x y"), (3, "x y"), (3, "x y z"), (None, None)]
    want = sorted(((d, len((t or "").encode()), brute(t), False) for d, t in rows), key=repr)
    assert sorted(map(tuple, token_counts.count_tokens(documents(rows), PATH, head=1).collect()), key=repr) == want


def test_every_distinct_pre_token_is_counted_once(spark, documents):
    docs = documents([(i, "alpha beta, alpha!") for i in range(50)]).select("doc_id", "text")
    parts = token_counts.document_frequencies(docs, PATH, {b"alpha": 1})
    assert {bytes(r.word) for r in parts.where("n > 0").collect()} == {b"beta", b",", b"!"}
    plan = token_counts.count_tokens(docs, PATH)._jdf.queryExecution().optimizedPlan().toString()
    eval_at = plan.index("ArrowEvalPython")
    assert plan.index("Join") < eval_at < plan.index("Aggregate [word", eval_at)     # counted over the distinct ones, then joined


def test_whole_table(spark):
    from tidemark.llm.catalog import op6_token_counts
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in op6_token_counts(spark, sf).collect()}
    own = Tokenizer.from_file(PATH)
    want = {r.doc_id: (len(r.text.encode()), len(own.encode(r.text, add_special_tokens=False).ids))
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got == want
