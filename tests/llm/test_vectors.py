"""Vector searches against brute force on a table with odd rows."""

import math
import random

import numpy as np
import pytest

from lakeforge.llm import hard_negatives, top_k, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, rid long, id string, v string, norm string, score int, rank int"


def odd_rows(n=400, dim=6, seed=3):
    """Ties, copies, repeated and null ids, short, empty, null and non-finite vectors, null labels."""
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-3, 3) / 4 * (1 + i % 5) for _ in range(dim)], rng.randint(0, 9)) for i in range(n)]
    rows += [(0, rows[0][1], rows[0][2]), (100, rows[7][1], 3), (100, rows[100][1], None), (None, rows[100][1], 4), (None, rows[1][1], 1)]
    rows += [(1000, None, 1), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1100, [math.nan] * dim, 2), (1150, [math.inf] + [0.0] * 5, 2), (1400, [1e300] * dim, 2)]
    rows += [(1200, [0.5, 0.25], 3), (1300, [], 4), (-100, [0.75] * dim, 5), (-50, [-0.75] * dim, 6), (70, [0.0] * dim, 7)]
    return [(*r, 1, "mine", "mine", "mine", 5, 6) for r in rows]


def taking_part(rows, labels=False):
    dim = max((len(r[1]) for r in rows if r[1] is not None), default=1)
    out = []
    for vec_id, e, label, *_ in rows:
        if e is None or any(x is None or not math.isfinite(x) or abs(x) > 1e200 for x in e) or labels and label is None:
            continue
        v = [math.floor(256 * x) for x in e] + [0] * (dim - len(e))
        out.append((vec_id, v, (label + 1) % 10 if labels and vec_id is not None and vec_id % 7 == 0 else label))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def order(pair):
    score, vec_id = pair
    return (-score, vec_id is None, vec_id or 0)


def plain_top_k(rows, k=5, every=50):
    rows, out = taking_part(rows), []
    for r, (q, v, _) in enumerate(rows):
        if q is not None and q % every == 0:
            best = sorted(((dot(v, w), c) for s, (c, w, _) in enumerate(rows) if s != r), key=order)[:k]
            out += [(q, i + 1, c, s) for i, (s, c) in enumerate(best)]
    return out


def plain_negatives(rows, every=100):
    rows, out = taking_part(rows, labels=True), []
    for r, (q, v, label) in enumerate(rows):
        if q is None or q % every:
            continue
        scored = [(dot(v, w), c, l == label) for s, (c, w, l) in enumerate(rows) if s != r]
        for p, c in sorted(((s, c) for s, c, same in scored if same), key=order)[:5]:
            far = sorted(((s, n) for s, n, same in scored if not same and 30 * p <= 100 * s <= 90 * p), key=order)[:10]
            out += [(q, c, i + 1, n, p, s) for i, (s, n) in enumerate(far)]
    return out


def some(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("sizes", [(2048, 4096, 4096), (3, 16, 8)])
def test_top_k_of_odd_rows(spark, monkeypatch, sizes):
    for name, size in zip(("QUERIES", "ROWS", "HEAD"), sizes):
        monkeypatch.setattr(top_k, name, size)
    rows = odd_rows()
    got = [tuple(r) for r in top_k.top_k(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert some(got) == some(plain_top_k(rows))
    assert top_k.top_k(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("sizes", [(1024, 4096), (2, 32)])
def test_hard_negatives_of_odd_rows(spark, monkeypatch, sizes):
    for name, size in zip(("ANCHORS", "ROWS"), sizes):
        monkeypatch.setattr(hard_negatives, name, size)
    rows = odd_rows()
    got = [tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = plain_negatives(rows)
    assert len(want) > 50
    assert some(got) == some(want)
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fewer_rows_than_asked_for(spark):
    rows = [(r[0], r[1], 1, *r[3:]) for r in odd_rows()[:3]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert some(tuple(r) for r in top_k.top_k(df).collect()) == some(plain_top_k(rows))
    assert hard_negatives.mine(df).collect() == []


def test_segment_bounds_hold_and_shorter_vectors_are_left_out():
    rng = np.random.default_rng(5)
    v = rng.integers(-200, 200, (60, 24)) + rng.integers(-300, 300, (60, 1))
    score = v @ v.T
    before = None
    for s in hard_negatives.segment_counts(24):
        mean, off = hard_negatives.summary(v, s)
        assert (mean @ mean.T + off @ off.T + 1e-6 >= score).all() and (mean @ mean.T - off @ off.T - 1e-6 <= score).all()
        width = (off @ off.T).sum()
        assert before is None or width <= before  # finer segments bound closer
        before = width


def test_bounds_spare_work_on_clustered_vectors():
    """Rows of one sign pattern far away from the anchors are settled by their summaries."""
    import pandas as pd

    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(90, 110, (50, 16)), -rng.integers(90, 110, (500, 16))])
    made = np.concatenate([x for s in hard_negatives.segment_counts(16) for x in hard_negatives.summary(v, s)], axis=1)
    pdf = pd.DataFrame({"v": [x.tobytes() for x in v.astype(np.int64)], "norm": np.linalg.norm(v, axis=1), "rid": range(550), "label": 0, "summary": [x.tobytes() for x in made]})
    a, c = hard_negatives.Side(pdf[:10], 16), hard_negatives.Side(pdf, 16)
    f = hard_negatives.Filter(a, c)
    x, y, s = f.pairs(np.arange(10), np.arange(550), np.ones((10, 550), bool), np.zeros(10), np.full(10, np.inf))
    assert sorted(set(y.tolist())) == list(range(50)) and f.seen[0, 1] == 500
    assert (s == (v[x] * v[y]).sum(1)).all()


def test_rotation_keeps_products_and_puts_weight_first():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 8)) * np.array([1, 9, 1, 1, 5, 1, 1, 1])
    b = top_k.basis_of(x, 8)
    assert np.allclose(b @ b.T, np.eye(8)) and np.allclose((x @ b) @ (x @ b).T, x @ x.T)
    weight = ((x @ b) ** 2).sum(0)
    assert (np.diff(weight) <= 1e-6 * weight[0]).all()


def test_scores_beyond_doubles_stay_exact():
    a = np.array([[1 << 30, 1], [3, 5]], np.int64)
    c = np.array([[1 << 30, 1], [7, 9]], np.int64)
    norm = np.sqrt((a.astype(float) ** 2).sum(1))
    assert vectors.block_scores(a, c, norm, norm)[0, 0] == (1 << 60) + 1
    assert vectors.pair_scores(a, c, np.array([0, 1]), np.array([0, 1])).tolist() == [(1 << 60) + 1, 66]
