import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import token_alignment as ta
from tidemark.llm.catalog import QUERIES
from tidemark.llm.speculative_bpe import byte_characters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
BYTE = byte_characters()


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute_groups(library, text):
    """((A ids, B ids) of each group, linked (a, b) of every overlap) from whole texts, token by token."""
    a, b = library
    if not text:
        return [], []
    data = (" " + text).encode()
    left = [(i, bytes(BYTE[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
             for i in b.encode(text)]
    if b"".join(t for _, t in left) != data or b"".join(t for _, t in right) != data:
        return [], []
    spans = []
    for side in (left, right):
        at, out = 0, []
        for i, token in side:
            out.append((at, at + len(token), i))
            at += len(token)
        spans.append(out)
    groups, links, at = [], [], [0, 0]
    for end in sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}):
        group = []
        for n, side in enumerate(spans):
            start = at[n]
            while at[n] < len(side) and side[at[n]][1] <= end:
                at[n] += 1
            group.append([i for _, _, i in side[start:at[n]]])
        groups.append(tuple(group))
    j = 0
    for s, e, i in spans[0]:
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(spans[1]) and spans[1][k][0] < e:
            links.append((i, spans[1][k][2]))
            k += 1
    return groups, links


def brute(library, rows):
    found = [(i, *brute_groups(library, t)) for i, t in rows]
    counts = Counter(p for _, _, links in found for p in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for i, groups, links in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, counts


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def aligned(docs):
    return ta.align(docs, A, B)


def scored(docs, head=ta.HEAD):
    from pyspark.sql import functions as F
    out = ta.score_links(aligned(docs), A, B, head)
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a\n b", "\n\n", "x▁y z", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "漢字 カナ é",
       "🙂 x y  ", "\x00\x01 \x7f", "﻿ a", "tokenization of internationalisation", "퟿  \U0010ffff", "1234 5678 ½",
       "a\tb", "　 x", "é ́"]


def test_pieces_make_up_whole_texts(library):
    rng = random.Random(3)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("abst \n'é漢<1▁"[:12]) for _ in range(500)) for _ in range(20)]
    texts += [" ".join("".join(rng.choice("aeinrstlk") for _ in range(rng.randint(1, 12))) for _ in range(300)) for _ in range(5)]
    own = ta.Aligner(A, B)
    assert own.cuts
    for _ in range(2):                            # the second time with known pieces
        batch = own.align(texts).to_pylist()
        for text, row in zip(texts, batch):
            groups, links = brute_groups(library, text)
            assert row["groups"] == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups), text
            assert row["n_links"] == len(links) and row["n_groups"] == len(groups)
            got = Counter({(a, int(own.same[a])): n for a, n in zip(row["same_ids"], row["same_links"])})
            got.update({divmod(p, own.size_b): n for p, n in zip(row["pairs"], row["pair_links"])})
            assert got == Counter(links), text
    own.cuts = False
    assert own.align(texts).to_pylist() == batch


def test_most_links_are_of_the_same_bytes(library):
    own = ta.Aligner(A, B)
    row = own.align(["the quick brown fox and the lazy dog"]).to_pylist()[0]
    assert sum(row["same_links"]) > sum(row["pair_links"])


@pytest.mark.parametrize("head", [ta.HEAD, 40, 0])
def test_against_whole_texts(spark, documents, library, head):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeinrstlk") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(40)]
    rows += list(enumerate(ODD, 100)) + [(7, rows[3][1]), (7, rows[3][1]), (None, rows[4][1]), (None, rows[5][1])]
    want, _ = brute(library, rows)
    docs = documents([(i, t) for i, t in rows]).repartition(5)
    assert plain(scored(docs, head).collect()) == plain(want)


def test_counts_of_pairs(spark, documents, library):
    rows = [(i, t) for i, t in enumerate(["strawberries are berries", "berries", "xstraw xberries", "berries berries", None])]
    _, counts = brute(library, rows)
    got = ta.pair_counts(aligned(documents(rows)), A, B).collect()
    assert {(r.a_id, r.b_id): r.documents for r in got} == counts and len(got) == len(counts)


def test_empty_table(documents):
    assert scored(documents([])).collect() == []
    assert [tuple(r) for r in scored(documents([(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_query_is_the_brute_force(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want, _ = brute(library, rows)
    assert plain(QUERIES["op13_token_alignment"](spark, SF).collect()) == plain(want)
