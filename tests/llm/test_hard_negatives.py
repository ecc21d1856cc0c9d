import math

import numpy as np
import pytest

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, slot int, id string, anchor int"


def brute(rows, modulus, positives=5, negatives=5):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by comparing all rows."""
    usable = [(at, i, [math.floor(256 * x) for x in v], g) for at, (i, v, g) in enumerate(rows)
              if g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def place(r):
        return -r[0], r[1] is None, r[1] if r[1] is not None else 0, r[2]
    out = []
    for at, i, v, g in usable:
        if i is None or i % modulus:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, k, h) for k, j, w, h in usable if k != at]
        for score, j, _, _ in sorted((s for s in scored if s[3] == g), key=place)[:positives]:
            window = [s for s in scored if s[3] != g and 80 * score <= 100 * s[0] <= 100 * score]
            out += [(i, j, rank, n[1], score, n[0]) for rank, n in enumerate(sorted(window, key=place)[:negatives], 1)]
    return out


def plain(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.fixture
def table(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, g, "x", 1, "y", 2) for i, v, g in rows], SCHEMA)
    return build


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (33, 64, 35), (70, 65, 129), (3, 0, 4)])
def test_strassen_is_the_matrix_product(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = (rng.integers(-10**6, 10**6, s) for s in (shape[:2], shape[1:]))
    for leaf in (1, 4, 32):
        assert (hn.strassen(a, b, leaf) == a @ b).all()
    big = a.astype(object) * 10**30
    assert shape[1] == 0 or (hn.strassen(big, b.astype(object), 4) == big @ b.astype(object)).all()


def test_additions_that_wrap_cancel_out():
    a = np.full((64, 64), 1 << 40)
    b = np.zeros((64, 64), np.int64)
    b[0] = 1 << 22
    assert (hn.strassen(a, b, 4) == np.int64(1 << 62)).all()


def test_heap_keeps_the_best_whatever_the_order_of_merges():
    rng = np.random.default_rng(3)
    scores, orders, keys = rng.integers(0, 6, 200), rng.integers(0, 9, 200), np.arange(200)
    want = sorted(zip((-scores).tolist(), orders.tolist(), keys.tolist()))[:5]
    for parts in (1, 4, 50):
        heap = hn.Heap(5)
        for at in np.array_split(rng.permutation(200), parts):
            heap.merge(scores, orders, keys, np.ones(200, bool), at)
        assert sorted((-s, -o, -k) for s, o, k, _ in heap.rows) == want


def test_against_all_rows(table):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 12))
    # few directions, so that windows and ties are full, one label with a third of all rows
    rows = [(i, [float(x) for x in np.float32(base[i % 6] + rng.integers(0, 2) * 0.25)], 0 if i % 3 else i % 5) for i in range(240)]
    rows += [(7, rows[3][1], 1), (7, rows[4][1], 1), (None, rows[5][1], 0), (None, rows[6][1], 3), (20, rows[0][1], 0)]
    want = brute(rows, 20)
    assert len(want) > 100
    for block_bytes in (1 << 20, 12 * 8 * 16):
        got = hn.mine(table(rows), modulus=20, block_bytes=block_bytes)
        assert plain(got.collect()) == plain(want)


def test_rows_that_take_no_part(table):
    v = [1.0, 2.0]
    odd = [(i, w, 1) for i, w in enumerate([None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0]], 1)]
    rows = [(0, v, 1), (100, v, None), *odd, (5, v, 1), (6, v, 2), (8, [], 2), (9, [1.0], 2), (11, [3.0, 1.0, 5.0], 1)]
    got = hn.mine(table(rows)).collect()
    assert plain(got) == plain(brute(rows, 100)) and len(got) > 0
    assert hn.mine(table([])).collect() == []
    assert hn.mine(table([(1, v, 1)])).collect() == []
    assert hn.mine(table([(0, v, 1), (1, v, 2)])).collect() == []      # no positive
    assert hn.mine(table([(0, [1.0], 1), (1, [-1.0], 1), (2, [-1.0], 2)])).collect() == []  # negative scores: empty window


def test_large_components_are_exact(table):
    rows = [(0, [1e12, 3.0], 1), (1, [0.0, 1e9], 1), (2, [0.0, 0.9e9], 2), (3, [0.0, 0.99e9], 2), (4, [1e9, -7.0], 2)]
    rows = [(i, [float(np.float32(x)) for x in v], g) for i, v, g in rows]
    got, want = hn.mine(table(rows)).collect(), brute(rows, 100)
    assert [r[3] for r in want] == [3, 2] and plain(got) == plain(want)


def test_scores_saturate(table):
    rows = [(0, [1e12], 1), (1, [1e9], 1), (3, [2e9], 2), (2, [0.9e9], 2)]
    got = hn.mine(table(rows)).collect()
    assert plain(got) == [(0, 1, 1, 2, hn.MOST, hn.MOST), (0, 1, 2, 3, hn.MOST, hn.MOST)]
