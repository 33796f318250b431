"""Passages that do not keep to lines."""

import random

import numpy as np

import corpus_pipeline
from lakeforge.llm import passages
from tests.llm.test_operators import frame


def words(name, n):
    return " ".join(f"{name}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n))


def test_passages_go_whatever_their_lines(spark):
    run, short = words("run", 51), words("brief", 50)
    first, *rest = run.split(" ")
    texts = [
        f"{words('one', 30)} {run} {words('uno', 30)}\n{short} {words('end', 9)}",
        f"{words('two', 8)} {first}\n{' '.join(rest[:20])}\n{' '.join(rest[20:])} {words('dos', 8)}\nx {short}",  # over line ends, beside other words
        None, f"{words('three', 4)} {run}", f"{words('three', 4)} {run}",  # copies lose the same
    ]
    docs = frame(spark, texts, [1, 2, 3, 4, 5])
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.recurring_lines(spark, docs, None).collect()}
    assert got[1] == (texts[0], 0) and got[3] == (None, 0)
    left = f"{words('two', 8)}\n{words('dos', 8)}\nx {short}"
    assert got[2] == (left, len(left))
    assert got[4] == got[5] == (words("three", 4), len(words("three", 4)))


def test_near_copies_keep_their_passages(spark):
    base = words("near", 120).split(" ")
    texts = [" ".join(base), " ".join(base[:60] + ["changed"] + base[61:]), f"{words('own', 90)} {' '.join(base[2:56])} tail"]
    got = {r.doc_id: r.text for r in corpus_pipeline.recurring_lines(spark, frame(spark, texts, [1, 2, 3]), None).collect()}
    assert got == {1: texts[0], 2: texts[1], 3: f"{words('own', 90)} tail"}


def test_texts_that_share_a_window_share_a_fingerprint():
    rng = random.Random(1)
    for _ in range(50):
        run = [f"w{rng.randrange(10**6)}" for _ in range(51)]
        a, b = ([f"{x}{rng.randrange(10**6)}" for _ in range(rng.randrange(60))] + run + [f"{x}{rng.randrange(10**6)}" for _ in range(rng.randrange(60))] for x in "ab")
        (ga, wa), (gb, wb) = (passages.run_hashes(" ".join(t), passages.GRAM, passages.WINDOW) for t in (a, b))
        assert len(np.intersect1d(wa, wb)) == 1 and np.isin(passages.least(ga), passages.least(gb)).any()
