"""Every link of the n-gram join."""

import random
import re

import duckdb
import pytest

from lakeforge.llm import ngram_join, queries
from lakeforge.llm.common import ROW
from tests.llm.test_operators import frame


@pytest.mark.parametrize("block,blocks", [(256, 64), (4, 64), (4, 1)])
def test_links_of_a_group_are_all_counted(spark, monkeypatch, block, blocks):
    monkeypatch.setattr(ngram_join, "BLOCKS", blocks)
    rng = random.Random(8)
    base = [f"v{k}" for k in range(150)]
    texts = ["", None, "one", "One"]
    for _ in range(14):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(150)] = f"x{rng.randrange(99)}"
        texts.append(" ".join(copy))
    texts += texts[-3:]
    sets = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if (w := re.findall("[^ ]+", (t or "").lower())) else set() for t in texts]
    link = lambda a, b: bool(a and b) and 100 * len(a & b) >= 90 * len(a | b)
    want = {i: sum(link(s, t) for j, t in enumerate(sets) if j != i) for i, s in enumerate(sets)}
    got = {r[0]: r[1] for r in ngram_join.link_counts(frame(spark, texts), block=block, keep=["doc_id"]).select(f"{ROW}.doc_id", "n_links").collect()}
    assert got == want and max(want.values()) > 5


def test_link_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.ORACLES["op8_ngram_links"]).fetchall()
    assert sorted(map(tuple, queries.op8_ngram_links(spark, sf).collect())) == sorted(want)
