"""Ranked lexical search against a plain walk over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeforge.llm import ranked_search as rs

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, item int, id string, no_id string, body string, terms string, score int, name string"
ITEMS = "item_id long, text string, item int, body string, name string, terms string"


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def plain(docs, items, k=50):
    counted = [(d, Counter(terms(t))) for d, t, *_ in docs]
    counted = [(d, c, c.total()) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text, *_ in items:
        found = []
        for d, c, n in counted:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return out


def some(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def tables(n=300, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "über", "É9", "日本", "don't", "a_b", "ÄB-c", "x y"]
    pick = lambda k: " ".join(rng.choice(words[: rng.choice([5, 20, 68])]) for _ in range(k))
    docs = [(i, pick(rng.choice([1, 3, 20, 80]))) for i in range(n)]
    docs += [(7, docs[7][1]), (None, docs[9][1]), (None, docs[9][1]), (1000, None), (1001, ""), (1002, "... --- !!"), (1003, "w1 " * 5000), (1004, docs[11][1])]
    items = [(i, pick(rng.choice([1, 4, 30]))) for i in range(25)]
    items += [(3, items[3][1]), (None, "w1 w2"), (50, None), (51, ""), (52, "never seen"), (53, docs[4][1].upper())]
    return [(*d, 1, "mine", "mine", "mine", "mine", 2, "mine") for d in docs], [(*i, 1, "mine", "mine", "mine") for i in items]


@pytest.mark.parametrize("shard, at_once, table", [(4096, 1 << 16, 8 << 20), (16, 40, 1 << 10)])
def test_search_of_odd_rows(spark, monkeypatch, shard, at_once, table):
    monkeypatch.setattr(rs, "SHARD", shard)
    monkeypatch.setattr(rs, "TERMS_AT_ONCE", at_once)
    monkeypatch.setattr(rs, "TABLE_BYTES", table)
    docs, items = tables()
    got = rs.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=20)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert some(tuple(r) for r in got.collect()) == some(plain(docs, items, 20))


def test_empty_tables(spark):
    docs, items = tables(20)
    some_docs, some_items = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert rs.search(some_docs.limit(0), some_items).collect() == []
    assert rs.search(some_docs, some_items.limit(0)).collect() == []


def test_range_maxima_name_value_and_document():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 64, 100):
        x = rng.integers(0, 1000, (n, 5))
        table = rs.RangeMaxima(x)
        spans = [(a, b) for a in range(n) for b in range(a + 1, n + 1)]
        bound, split = table.best(np.array([s[0] for s in spans]), np.array([s[1] for s in spans]))
        for (a, b), y, at in zip(spans, bound, split):
            assert y == x[a:b].max(0).sum() and a <= at < b and x[at].max() == x[a:b].max()


def test_search_scores_few_documents_when_bounds_are_sharp():
    """One document stands out: the search ends after a few splits."""
    impacts = np.ones((1024, 3), np.int64)
    impacts[500] = 1000
    seen = []
    kept = rs.Kept(1)
    add = kept.add
    kept.add = lambda score, no_id, id_: (seen.append(len(score)), add(score, no_id, id_))
    rs.search_range(impacts, np.zeros(1024, bool), np.arange(1024), kept)
    assert kept.id.tolist() == [500] and sum(seen) == 1
