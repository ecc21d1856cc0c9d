import zlib

import numpy as np
import pytest

from tidemark.llm import quality

SF = "/root/testdata/sf0.01"
TEXTS = ["", " ", "one", "a b c", "É漢 word!! THE", "same same same same", "x " * 5000, "To To\nTo | end |"]


def brute_features(text):
    words = text.encode().split()
    wrap = lambda v: v & (2 ** 64 - 1)
    out = []
    for i, w in enumerate(words):
        m = "<" + w.decode() + ">"
        out.append(zlib.crc32(w) % quality.BUCKETS)
        for n in (2, 3, 4):
            for j in range(len(m) - n + 1):
                h = ord(m[j]) + n
                for c in m[j + 1:j + n]:
                    h = wrap(h * int(quality._MIX) + ord(c))
                out.append((wrap(h * int(quality._MIX)) >> 24) % quality.BUCKETS)
        if i and words[i - 1] == w:
            out.append(zlib.crc32(quality._REPEAT) % quality.BUCKETS)
    return out


def test_scorer_is_the_model(monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(*quality.text_features(t.encode()), i % 2) for i, t in enumerate(TEXTS)]
    model = quality.train(rows, epochs=3)
    model.vectors += rng.normal(0, 1, model.vectors.shape).astype(np.float32)
    for cache in (200_000, 8):
        monkeypatch.setattr(quality, "CACHE_WORDS", cache)
        scorer = quality.Scorer(*model.reduced())
        for t in TEXTS * 2:
            f = brute_features(t)
            found, counts = quality.text_features(t.encode())
            want = np.bincount(f, minlength=quality.BUCKETS) if f else np.zeros(quality.BUCKETS, int)
            assert np.array_equal(np.flatnonzero(want), found) and np.array_equal(want[found], counts)
            scores = model.vectors[f].mean(0) @ model.output + model.bias if f else model.bias
            p = np.exp(scores[1]) / np.exp(scores).sum()
            assert abs(scorer(t.encode()) - p) < 1e-4 and abs(model.probability(found, counts) - p) < 1e-4


@pytest.fixture(scope="module")
def scored(spark):
    from tidemark.llm.catalog import op3_quality_classifier
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = op3_quality_classifier(spark, SF)
    return out, out.join(labels, "doc_id").toPandas()


def test_held_out_accuracy(spark, scored):
    out, frame = scored
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rest = frame[frame.held_out]
    bad, good = rest[rest.quality == 0].score.values, rest[rest.quality == 1].score.values
    auc = np.mean(bad[:, None] < good[None, :])
    right = np.mean(rest.predicted == rest.quality)
    print("auc", auc, "accuracy", right, len(bad), len(good))
    assert auc > 0.97 and right > 0.95
    assert np.mean(good >= 0.5) > 0.97
    assert list(frame.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in frame.doc_id]
    assert ((frame.score >= 0.5) == (frame.predicted == 1)).all()


def test_edges(spark, documents):
    docs = documents([(0, "good words here"), (0, "good words here"), (1, None), (2, ""), (3, "bad bad bad"), (None, "x")])
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (3, 0, 0), (2, None, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs.select("doc_id", "text"), labels)
    got = quality.score_quality(docs, model, score="n").collect()
    assert len(got) == 6 and all(0 <= r.n <= 1 for r in got)
    by = {(r.doc_id, r.text): r.n for r in got}
    assert by[(1, None)] == by[(2, "")]
    none = quality.fit(docs.select("doc_id", "text"), labels.where("doc_id > 99"))
    assert {r.n for r in quality.score_quality(docs, none, score="n").collect()} == {0.5}
    assert quality.score_quality(docs.where("doc_id > 99"), model).count() == 0
