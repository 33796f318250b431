"""The corpus pipeline stage by stage."""

import uuid

from pyspark.sql import functions as F

import corpus_pipeline
from lakeforge.llm import components, ngram_join
from tests.llm.test_operators import ODD, ODD_IDS, brute_components, frame

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out = spark.createDataFrame(out.collect(), out.schema)
        if name != "bpe":
            assert out.columns == docs.columns
        if name == "ngram_jaccard_join":
            rows = docs.select("doc_id", "text").collect()
            want = brute_components([r.text for r in rows], [r.doc_id for r in rows], *ngram_join.NEAR)
            assert {r.doc_id for r in out.collect()} == {i for i, n, c in want if n == 0 or i == c}
        if name == "line_dedup":
            assert out.count() == docs.count()
            assert out.where(F.length("text") != F.col("n_chars")).count() == docs.where(F.length("text") != F.col("n_chars")).count()
        docs = out
    assert {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(docs.columns)


def test_stages_take_odd_rows(spark):
    docs = frame(spark, ODD, ODD_IDS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 0


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_on_an_empty_table_and_with_a_clashing_column(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, empty, SF)
        assert made.collect() == [] and made.columns[: len(empty.columns)] == empty.columns, name
    for clash in ("key", "__key", "group"):
        docs = documents(spark, [(1, "one two three", "en", "a", 13), (2, None, None, None, None), (2, "", "en", "a", 0)]).withColumn(clash, F.lit("mine"))
        made = corpus_pipeline.recurring_lines(spark, docs, SF)
        assert sorted(map(str, made.collect())) == sorted(map(str, docs.collect()))


def test_toxicity_stage_takes_out_what_the_model_rejects(spark):
    from lakeforge.llm import toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    machine = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = sorted(r.doc_id for r in docs.collect() if machine.score(r.text or "") < 0.7)
    got = sorted(r.doc_id for r in corpus_pipeline.toxic_documents(spark, docs, SF).collect())
    assert got == want and 0 < len(got) < docs.count()


def test_line_stage_takes_out_planted_lines_and_passages(spark):
    import random

    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    own = lambda n: " ".join(word() for _ in range(n))
    passage, line = own(60), "Subscribe to our daily letter now"
    rows = [(k, f"{own(90)}\n{line}\n{own(20)} {passage if k % 3 == 0 else own(5)} {own(20)}", "en", "a", 0) for k in range(12)]
    got = {r.doc_id: r for r in corpus_pipeline.recurring_lines(spark, documents(spark, rows), SF).collect()}
    assert sorted(got) == list(range(12))
    for k, text, *_ in rows:
        assert (line in got[k].text) == (k == 0) and (passage in got[k].text) == (k == 0)
        plain = text if k == 0 else text.replace(f"{line}\n", "").replace(f"{passage} ", "")
        assert got[k].text == plain and got[k].n_chars == (0 if k == 0 else len(plain))


def test_mixing_stage_repeats_documents_as_the_mix_takes_them(spark):
    from collections import Counter

    from lakeforge.llm import mixing
    from lakeforge.llm.common import ROW

    docs = spark.read.parquet(f"{SF}/documents.parquet").dropDuplicates(["doc_id"])
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).select(f"{ROW}.doc_id", "copies").collect()}
    got = Counter(r.doc_id for r in corpus_pipeline.mixed_sources(spark, docs, SF).collect())
    assert got == Counter({k: int(n) for k, n in taken.items() if n}) and len(got) < len(taken) < sum(got.values()) + len(taken)


def test_bpe_stage_equals_the_library(spark):
    import hashlib

    import numpy as np

    from lakeforge.llm import bpe

    tok = bpe.tokenizer(corpus_pipeline.tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for r in corpus_pipeline.encoded(spark, docs, SF).collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def jobs_of(spark, run):
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_line_dedup_runs_few_jobs(spark):
    """The driver keeps plans, metrics and threads of every execution: their number must stay low."""
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(words[i * 40 : i * 40 + 90]) + f"\nthis line recurs in every single text\nown line of text number {i}" for i in range(12)]
    texts += [t + " more" for t in texts[:4]] + texts[:2]
    docs = documents(spark, [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)])
    made = []
    jobs = jobs_of(spark, lambda: made.extend(corpus_pipeline.recurring_lines(spark, docs, SF).collect()))
    assert len(made) == len(texts) and any(len(r.text) < len(texts[r.doc_id]) for r in made)
    assert jobs <= 225, jobs


def test_components_write_once_a_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "materialise", lambda df, name, f=components.materialise: written.append(name) or f(df, name))
    for edges, writes in (([(1, 2), (3, 4), (1, 5)], 2), ([], 2), ([(2, 1), (2, 3)], 3)):
        written.clear()
        got = sorted(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
        assert got == sorted((i, 3 if i in (3, 4) and len(edges) > 2 else 1) for i in {i for e in edges for i in e})
        assert len(written) == writes
