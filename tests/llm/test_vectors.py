import math

import numpy as np
import pytest
from test_simhash import brute_components

from tidemark.llm import embedding_dedup as dedup
from tidemark.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, rank int, block int"
ODD = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0], [1e38] * 8, [1e-30] * 8]


@pytest.fixture
def table(spark):
    def build(vectors, first=0):
        rows = [(i + first if i is not None else None, v, 0, "x", 1, 2) for i, v in vectors]
        return spark.createDataFrame(rows, SCHEMA)
    return build


def families(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    rows = np.concatenate([base, *[base[: n // 3] + rng.normal(size=(n // 3, dims)) * s for s in spread], np.repeat(base[:1], 40, 0)])
    return rows.astype(np.float32).astype(float).tolist()


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def brute_top(rows, k=20):
    """Rows are told apart by their place, whatever their ids."""
    whole = [(at, i, [math.floor(64 * x) for x in v]) for at, (i, v) in enumerate(rows) if usable(v)]
    out = []
    for at, q, v in whole:
        if q is not None and q % 20 == 0:
            scores = sorted((-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), c is None, c or 0)
                            for other, c, w in whole if other != at)
            out += [(q, r + 1, None if none else c, -s) for r, (s, none, c) in enumerate(scores[:k])]
    return plain(out)


@pytest.mark.parametrize("block_bytes", [4 << 20, 7 * 64, 100])
def test_top_k(table, monkeypatch, block_bytes):
    f32 = lambda v: None if v is None else [None if x is None else float(np.float32(x)) for x in v]
    monkeypatch.setattr(topk, "STRIP", 3)
    rows = [(i - 40, f32(v)) for i, v in enumerate(families(1, 60, 8, (0.1,)) + ODD)] + [(None, [1.0] * 8), (None, [9.0] * 8)]
    got = topk.top_k(table(rows), block_bytes=block_bytes)
    assert plain(got.collect()) == brute_top(rows)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_top_k_of_rows_that_repeat_an_id(table):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [5.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0])]
    got = topk.top_k(table(rows)).collect()
    assert plain(got) == brute_top(rows) and len(got) == 3 * 4
    assert topk.top_k(table(rows[:1])).count() == 0 and topk.top_k(table(rows).where("vec_id > 9")).count() == 0
    # Every vector under an id counts: id 1 has one that is like query 0.
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]
    assert tuple(topk.top_k(table(rows)).orderBy("rank").first()) == (0, 1, 1, 4096)


def test_top_k_of_wide_vectors(table):
    rng = np.random.default_rng(8)
    rows = [(i, np.float32(rng.normal(size=900)).astype(float).tolist()) for i in range(45)]
    assert plain(topk.top_k(table(rows), block_bytes=1 << 14).collect()) == brute_top(rows)


def brute_links(rows, t=0.9):
    """(vec_id, links, component, kept) of every row; rows are told apart by their place."""
    ok = {at: np.array(v) for at, (_, v) in enumerate(rows) if usable(v) and any(v)}
    width = max(map(len, ok.values()), default=0)
    wide = {}
    for at, v in ok.items():
        v = np.pad(v, (0, width - len(v)))
        v = v / np.abs(v).max()
        wide[at] = v / np.linalg.norm(v)
    near = lambda a, b: a in wide and b in wide and wide[a] @ wide[b] >= t
    places = list(range(len(rows)))
    root = brute_components(places, near)
    low = {}
    for at in places:
        if rows[at][0] is not None:
            low[root[at]] = min(low.get(root[at], rows[at][0]), rows[at][0])
    return plain((i, sum(near(at, j) for j in places if j != at), low.get(root[at]), i is not None and low.get(root[at]) == i)
                 for at, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block,rows_,columns", [(None, 1024, 2048), (16, 8, 4), (3, 8, 4)])
def test_near_duplicates(table, monkeypatch, block, rows_, columns):
    monkeypatch.setattr(dedup, "ROWS", rows_)
    monkeypatch.setattr(dedup, "COLUMNS", columns)
    rows = [(1000 - i, v) for i, v in enumerate(families(2, 90, 8, (0.1, 0.2, 0.3)) + ODD)]
    rows += [(None, rows[0][1]), (None, [1.0] * 8), (None, [1.0] * 8), (905, rows[4][1]), (3, rows[7][1])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert plain(dedup.near_duplicates(table(rows), block=block).collect()) == brute_links(rows)


def test_near_duplicates_empty_and_repeated(table):
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [1.0, 0.01]), (7, [0.0, 1.0])]
    got = plain(dedup.near_duplicates(table(rows)).collect())
    assert got == brute_links(rows) == [(3, 2, 3, True), (3, 2, 3, True), (5, 2, 3, False), (7, 0, 7, True)]
    # Every vector under an id is compared: 0 and one of 1, 2 and the other of 1.
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]
    assert plain(dedup.near_duplicates(table(rows)).collect()) == [(0, 1, 0, True), (1, 1, 0, False), (1, 1, 1, True), (2, 1, 1, False)]
    assert dedup.near_duplicates(table(rows).where("vec_id > 9")).count() == 0
    assert [tuple(r) for r in dedup.near_duplicates(table([(1, None)])).collect()] == [(1, 0, 1, True)]


def test_near_duplicates_in_double_precision(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 6))
    vectors = np.concatenate([base, base + rng.normal(size=base.shape) * 0.2, base * 1e-200, base * 1e200]).tolist()
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert plain(dedup.near_duplicates(df, block=16).collect()) == brute_links(rows)


def test_blocks_cover_every_close_pair():
    counts = {0: 10, 1: 3, 500: 40, 501: 2, 2000: 1, 4095: 9}
    table = {b: (first, n, last) for b, first, n, last in dedup.block_table(counts, 0.9, 8)}
    used = set()
    for first, n, last in table.values():
        used |= set(range(first, first + n))
        assert last >= first + n - 1
    assert used == set(range(len(used)))
    assert table[500][1] == 5 and table[0][2] < table[4095][0]
    for a, b in ((a, b) for a in table for b in table if a <= b and (b - a - 1) * 2 / dedup.BINS <= math.sqrt(0.2)):
        assert table[a][2] >= table[b][0] + table[b][1] - 1
