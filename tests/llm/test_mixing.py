import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.common import numbered, stored


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(cap * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        target = {s: cap * sizes[s] if s in capped else weight[s] * rest / w for s in names}
        above = {s for s in names if target[s] > cap * sizes[s]}
        if not above:
            return target
        capped |= above


def brute_tilt(xs, target, cap=3):
    mean = sum(xs) / len(xs)
    low, high = -1e4, 1e4
    words = lambda a: sum(x * min(cap, math.exp(min(50, a * x / mean))) for x in xs)
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if words(mid) < target else (low, mid)
    return [min(cap, math.exp(min(50, low * x / mean))) for x in xs]


@pytest.fixture(scope="module")
def table():
    rng = random.Random(5)
    rows, i = [], 0
    for source, n in (("big", 1500), ("a", 40), ("Z", 3), (None, 60), ("é", 200), ("tiny", 1), ("blank", 5)):
        for _ in range(n):
            words = 0 if source == "blank" else rng.choice([0, 1, 5, 30, 30, 30, 200, rng.randint(1, 900)])
            rows.append((i, " ".join(["w"] * words), source))
            i += 1
    rows.append((i, None, "a"))
    return rows


def test_against_brute_force(spark, documents, table, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 64)
    docs = documents(table)
    got = [r.asDict() for r in mixing.mix(docs).collect()]
    assert len(got) == len(table)
    text = {d: t for d, t, _ in table}
    by = defaultdict(list)
    for r in got:
        assert r["size"] == len((text[r["doc_id"]] or "").split()) and 0 <= r["copies"] <= 3
        assert r["taken"] == r["copies"] * r["size"] and abs(r["copies"] - r["rate"]) < 2
        by[r["source"]].append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    targets = brute_targets(sizes)
    for s, rs in by.items():
        assert {r["source_size"] for r in rs} == {sizes[s]}
        assert all(math.isclose(r["target"], targets[s], rel_tol=1e-9, abs_tol=1e-9) for r in rs)
        if sizes[s]:
            rates = brute_tilt([r["size"] for r in rs], targets[s])
            assert all(math.isclose(r["rate"], w, rel_tol=1e-4) for r, w in zip(rs, rates))
            spare = max(r["size"] for r in rs) / 2 if len(rs) < 5 else max(2, 0.01 * targets[s])
            assert abs(sum(r["taken"] for r in rs) - targets[s]) <= spare, s
    again = [r.asDict() for r in mixing.mix(docs.repartition(7)).collect()]
    key = lambda r: r["doc_id"]
    assert sorted(again, key=key) == sorted(got, key=key)
    short = mixing.mix_sizes(docs).select("doc_id", "taken").collect()
    assert sorted((r.doc_id, r.taken) for r in short) == sorted((r["doc_id"], r["taken"]) for r in got)
    clashing = docs.withColumnsRenamed({"n_chars": "size", "n": "copies"})
    out = mixing.take_mix(clashing)
    assert out.columns == clashing.columns
    taken = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert taken == {r["doc_id"]: r["copies"] for r in got if r["copies"]} and out.where("size <> length(text)").isEmpty()


def test_empty_blank_and_repeated(spark, documents):
    assert mixing.mix(documents([(1, "x")]).where("doc_id > 1")).count() == 0
    blank = mixing.mix(documents([(1, ""), (2, None, None), (None, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 3
    rows = [(1, "a b c", "s")] * 4 + [(None, "a b", "s"), (2, "a b", "t")]
    assert mixing.mix(documents(rows)).count() == 6


@pytest.mark.parametrize("ids,same_text", [(lambda i: None, False), (lambda i: i % 3, True)])
def test_targets_are_met_whatever_the_ids(spark, documents, monkeypatch, ids, same_text):
    monkeypatch.setattr(mixing, "SLICE", 64)
    rows = [(ids(i), " ".join([f"w{0 if same_text else i}"] * 30), "a") for i in range(1000)]
    rows += [(ids(i), " ".join([f"v{0 if same_text else i}"] * 30), "b") for i in range(1000)]
    docs = documents(rows)
    order = lambda df: sorted((tuple(r) for r in df.select("doc_id", "source", "taken", "target").collect()), key=str)
    got = order(mixing.mix_sizes(docs))
    for source, target in (("a", 20_000), ("b", 40_000)):
        own = [r for r in got if r[1] == source]
        assert {r[3] for r in own} == {target} and abs(sum(r[2] for r in own) - target) <= 30
    # Reruns agree, also when rows are dealt out another way.
    out = mixing.take_mix(docs.repartition(7))
    assert out.columns == docs.columns
    assert [r["count"] * 30 for r in out.groupBy("source").count().orderBy("source").collect()] == [
        sum(r[2] for r in got if r[1] == source) for source in "ab"]


def test_numbers_among_equal_rows(spark):
    rows = spark.range(0, 900, 1, 6).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), F.monotonically_increasing_id().alias("_row"))
    rows = stored(rows.unionByName(spark.createDataFrame([(77, -1), (78, -2)], "k bigint, _row bigint")))
    got = numbered(rows, ["k"], "nth").collect()
    assert len(got) == 902
    for k in {r.k for r in got}:
        nth = sorted(r.nth for r in got if r.k == k)
        assert nth == list(range(len(nth)))


def test_an_unsolved_source_raises(spark, documents):
    docs = documents([(i, "a b c " * i, "ab"[i % 2]) for i in range(1, 40)])
    cells = stored(mixing.with_size(docs).groupBy("source", "size").agg(F.count("*").alias("n")))
    targets = mixing.source_targets(cells)
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    placed = cells.join(targets, "source").select("rank", "source", "size", "n", x.alias("x"))
    assert mixing.solve_tilts(placed, targets).count() == 2
    with pytest.raises(RuntimeError, match="not met"):
        mixing.solve_tilts(placed, targets, max_steps=1)
