import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import language_model as lm
from tidemark.llm import words


def brute(rows):
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    out_of = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for d, t in rows if not out_of(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(d, out_of(d), len(ts), sum(c[w] > 0 for w in ts), n, sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ts))
            for d, t in rows for ts in [tokens(t)]]


ROWS = [(i, t) for i, t in enumerate(["the cat sat", "The CAT ran", "a dog sat the", "", None, " \n", "zebra é É", "the " * 300,
                                      "one two three four five", "the cat sat on the mat"] * 3)] + [(None, "no id here"), (5, "again"), (5, "again")]


@pytest.mark.parametrize("vocabulary,head,flush", [(510, 1 << 18, 300_000), (3, 6, 4), (0, 0, 300_000)])
def test_base_and_counts(spark, documents, monkeypatch, vocabulary, head, flush):
    monkeypatch.setattr(words, "FLUSH", flush)
    got = lm.score_documents(documents(ROWS), vocabulary=vocabulary, head=head).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, got), key=key), sorted(brute(ROWS), key=key)
    assert [r[:5] for r in got] == [w[:5] for w in want]
    assert np.allclose([r[5] for r in got], [w[5] for w in want], rtol=1e-9) and all(r[6] < 0 for r in got)


def test_probabilities_add_up(spark, documents):
    """Over every known word, the end and one unknown word, after a given text."""
    rows = [(i, t) for i, t in enumerate(["a b c", "a b d", "b a e f", "a a b"] * 6)]
    docs = documents(rows)
    known = sorted({w for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1 for w in t.split()})
    start = "a b"
    probes = [f"{start} {w}" for w in known + ["unseen"]]
    training = lm.training_rows(docs.select("doc_id", "text"))
    counts = lm.count_corpus(training)
    frequent = sorted(((bytes(r.word), r.n) for r in counts.table.collect()), key=lambda w: (-w[1], w[0]))
    model = lm.fit(training, counts, frequent[:2])
    z = model.log_normalisers()
    a, b = 0, 1
    outputs = np.exp((model.far[a] + model.near[b]) @ model.output.T + model.bias - z[a, b])
    assert math.isclose(outputs.sum(), 1, rel_tol=1e-5)
    # The end's probability after a text: that of the text over that of all its continuations.
    scored = {r.doc_id: r.score for r in lm.score(documents(list(enumerate([start] + probes))).select("doc_id", "text"),
                                                 counts, model, frequent).collect()}
    ends = {w: math.log10(np.exp((model.far[1] + model.near[min(i, 2)]) @ model.output[3] + model.bias[3] - z[1, min(i, 2)]))
            for i, w in enumerate([w.decode() for w, _ in frequent] + ["unseen"])}
    first = scored[0] - math.log10(outputs[3])
    total = outputs[3] + sum(10 ** (scored[i + 1] - first - ends[p.split()[-1]]) for i, p in enumerate(probes))
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.score_documents(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "sum(n_tokens) n").first()
    print((r.s - r.b) / r.n)
    assert r.s > r.b


def test_learns_an_order(spark):
    rows = [(i, "x y z " * 60) for i in range(60)]
    r = lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").first()
    assert r.score > r.base_score + 0.1 * r.n_tokens


def test_empty(spark, documents):
    assert lm.score_documents(documents([(1, "x")]).where("doc_id > 1")).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm.score_documents(documents([(held, "a b")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


def test_classes_add_up():
    rng = np.random.default_rng(5)
    model = lm.LogBilinear([b"%d" % i for i in range(40)], rng.random(42) + 0.1, shortlist=3)
    for p in model.parameters():
        p[...] = rng.normal(0, 1, p.shape)
    tokens = np.arange(model.end + 1)
    for far, near in [(0, 1), (model.start, 39), (model.other, model.other)]:
        context = np.full(len(tokens), far), np.full(len(tokens), near)
        assert math.isclose(np.exp(model.log_probabilities(*context, tokens)).sum(), 1, rel_tol=1e-5)


def test_vocabulary_follows_the_data(spark):
    """Each of 1,200 words is followed by one word; the order can only be learnt with all of them."""
    rng = np.random.default_rng(3)
    text = lambda: " ".join(f"a{i} b{i}" for i in rng.integers(0, 600, 400))
    docs = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id bigint, text string")
    r = lm.score_documents(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "sum(n_tokens) n").first()
    print((r.s - r.b) / r.n)
    assert r.s > r.b + 0.3 * r.n


def plain_train(model, far, near, token, rng, squares):
    """The steps of ``LogBilinear.train``, written plainly."""
    def sums(index, rows):
        order = np.argsort(index, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], index[order][1:] != index[order][:-1]]))
        return index[order][starts], np.add.reduceat(rows[order], starts, axis=0)

    def descend(p, s, rows, grads, size):
        grads = grads / size
        s[rows] = s[rows] + grads * grads
        p[rows] -= lm.RATE * grads / (np.sqrt(s[rows]) + lm.EPSILON)

    order = rng.permutation(len(token))
    step = min(lm.STEP, max(lm.LEAST_STEP, len(order) // lm.LEAST_STEPS))
    for rows in np.split(order, range(step, len(order), step)):
        a, b, c = far[rows], near[rows], token[rows]
        context = model.far[a] + model.near[b]
        g_context = np.zeros_like(context)
        tail = np.flatnonzero((c >= model.short) & (c < model.other))
        for vectors, biases, k, q, chosen, outputs in [
                (model.output, model.bias, 0, model.of_class, slice(None), model.classes[c]),
                (model.inner, model.inner_bias, 1, model.of_tail, tail, c[tail] - model.short)]:
            upto, log_noise = np.cumsum(q), np.log(lm.NOISE * q).astype(np.float32)
            noise = np.minimum(np.searchsorted(upto, rng.random(lm.NOISE) * upto[-1], "right"), len(upto) - 1)
            x, own, others = context[chosen], vectors[outputs], vectors[noise]
            true = np.einsum("ij,ij->i", x, own) + biases[outputs] - log_noise[outputs]
            false = x @ others.T + (biases[noise] - log_noise[noise])
            g_true = -1 / (1 + np.exp(np.clip(true, -30, 30)))
            g_false = 1 / (1 + np.exp(np.clip(-false, -30, 30)))
            g_context[chosen] += g_true[:, None] * own + g_false @ others
            found, grads = sums(np.concatenate([outputs, noise]), np.column_stack([
                np.concatenate([g_true[:, None] * x, g_false.T @ x]), np.concatenate([g_true, g_false.sum(0)])]))
            descend(vectors, squares[k], found, grads[:, :-1], len(rows))
            descend(biases, squares[4 + k], found, grads[:, -1], len(rows))
        for p, s, index in ((model.near, squares[2], b), (model.far, squares[3], a)):
            descend(p, s, *sums(index, g_context), len(rows))


def test_training_steps_cost_less_than_plain_ones():
    """The same steps to the same model, in less CPU time."""
    rng = np.random.default_rng(1)
    token = np.minimum(rng.zipf(1.2, 800_000) - 1, 50_000).astype(np.int32)
    far, near = np.roll(token, 2), np.roll(token, 1)
    models, seconds = [], []
    for train in (plain_train, lm.LogBilinear.train):
        took = []
        for _ in range(2):
            model = lm.LogBilinear([b"%d" % i for i in range(50_000)], np.bincount(token, minlength=50_002) + 0.5)
            begin = time.thread_time()
            train(model, far, near, token, np.random.default_rng(2), [np.zeros_like(p) for p in model.parameters()])
            took.append(time.thread_time() - begin)
        models.append(model)
        seconds.append(min(took))
    for p, q in zip(*(m.parameters() for m in models)):
        assert np.allclose(p, q, rtol=1e-3, atol=1e-3)
    print(seconds)
    assert seconds[1] < 0.85 * seconds[0]


@pytest.mark.parametrize("size", [1 << 23, 16, 1])
def test_words_of(monkeypatch, size):
    monkeypatch.setattr(words, "TEXT", size)
    texts = ["skipped", "A b\x0bC\x1cd\xa0\u00c9 [Z@", None, "", " \t\n\v\f\r ", "one", "two", "x" * 50, " lead and trail ", "w " * 40, ""]
    for kind in (pa.string(), pa.large_string(), pa.binary()):
        array = pa.array([t if t is None or kind != pa.binary() else t.encode() for t in texts], kind)[1:]
        for lower in (True, False):
            got, text = [], []
            for found, numbers, whole in words.words_of(array, lower):
                assert sum(numbers) == len(found) and (whole or len(numbers) == 1)
                cuts = np.split(np.array(found.to_pylist(), object), np.cumsum(numbers)[:-1])
                for cut in cuts:
                    text += cut.tolist()
                    if whole:
                        got.append(text)
                        text = []
            assert got == [(t.lower() if lower else t).split() for x in texts[1:] for t in [(x or "").encode()]]
    assert list(words.words_of(pa.array([], pa.string()), True)) == []


def test_texts_in_pieces(spark, documents, monkeypatch):
    """Pieces of texts and passes give the same scores as whole texts."""
    docs = documents(ROWS)
    def scores():
        return sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 4)) for r in lm.score_documents(docs).collect())
    whole = scores()
    monkeypatch.setattr(words, "TEXT", 16)
    assert scores() == whole
    sequences = lm.Sequences(lm.LogBilinear([b"a", b"b"], np.ones(4)))
    parts = [sequences(np.array(ids), np.array(n), w) for ids, n, w in [([0, 1], [2], False), ([1, 0, 1], [1, 0, 2], True)]]
    far, near, token, _ = (np.concatenate(x).tolist() for x in zip(*parts))
    assert token == [0, 1, 1, 3, 3, 0, 1, 3]
    assert near == [4, 0, 1, 1, 4, 4, 0, 1] and far == [4, 4, 0, 1, 4, 4, 4, 0]
