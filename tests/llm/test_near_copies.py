"""Near copies stay near copies through line dedup."""

import os
import random

import corpus_pipeline
from pyspark.sql import functions as F

from lakeforge.llm import common, ngram_join
from lakeforge.session import shared_dir
from tests.llm.test_operators import brute_components, frame
from tests.llm.test_passages import words


def test_lines_of_other_holders_do_not_part_near_copies(spark):
    shared = [words(n, 60) for n in ("first", "second", "third")]
    copy = [*shared, words("own", 60)]
    # each shared line has an earlier holder of its own; the copies differ in one word in the first line
    texts = [f"{words(n, 60)}\n{line}" for n, line in zip(("one", "two", "six"), shared)]
    texts += ["\n".join(copy), "\n".join([copy[0].replace("firstab", "firstly"), *copy[1:]])]
    # a quarter of a text shared with the holder of the first line, less than that on each line
    small = [words("w" + chr(97 + k), 20) for k in range(10)]
    texts += ["\n".join(small), "\n".join([*small[:3], "new", *small[3:]]), f"{words('z', 30)}\n{small[4]}", f"{words('y', 30)}\n{small[4]}"]
    docs = frame(spark, texts, list(range(1, len(texts) + 1)))
    got = {r.doc_id: r.text for r in corpus_pipeline.recurring_lines(spark, docs, None).collect()}
    ids = sorted(got)
    before = {i: c for i, _, c in brute_components(texts, ids, *ngram_join.NEAR)}
    after = {i: c for i, _, c in brute_components([got[i] for i in ids], ids, *ngram_join.NEAR)}
    assert before[4] == before[5] == 4 and before[6] == before[7] == 6
    assert after == before
    assert got[8] == words("z", 30) and got[9] == words("y", 30)


def test_a_group_that_cuts_would_part_stays_whole(spark):
    own, passage = words("own", 24), words("pass", 200)
    texts = [f"{words('old', 60)} {passage}", f"{own} {passage}", f"{words('else', 24)} {passage}"]
    docs = frame(spark, texts, [1, 2, 3])
    before = {i: c for i, _, c in brute_components(texts, [1, 2, 3], *ngram_join.NEAR)}
    assert before == {1: 1, 2: 2, 3: 2}
    got = {r.doc_id: r.text for r in corpus_pipeline.recurring_lines(spark, docs, None).collect()}
    assert got == {1: texts[0], 2: texts[1], 3: texts[2]}


def test_no_working_table_holds_texts_when_a_stage_has_returned(spark):
    run = words("run", 60)
    texts = [f"{words(x, 20)}\n{run}\n{words(x + x, 20)}" for x in "abcdef"]
    docs = common.materialise(frame(spark, texts, list(range(1, 7))), "stage_docs")
    top = "/" + shared_dir(spark, "llm").removeprefix("file:").lstrip("/")
    there = lambda: {f"{name}/{x}" for name in os.listdir(top) for x in os.listdir(f"{top}/{name}")}
    for stage in (corpus_pipeline.recurring_lines, corpus_pipeline.near_duplicates):
        before = there()
        made = stage(spark, docs, None)
        left = {x.split("/")[0] for x in there() - before}
        assert left <= {"line_drops", "line_mask", "line_whole", "passage_places", "passage_mask", "ngram_odd", "ngram_mask"}
        assert made.count() == len(texts)


def test_shuffle_files_go_with_the_write(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for x in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in x}
    before = shuffled()
    made = common.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "few")
    assert shuffled() <= before and made.count() == 7
    assert spark.conf.get(common.CLEANUP) == "false"


def test_equal_words_alone_have_equal_hashes():
    rng = random.Random(4)
    for _ in range(300):
        data = "".join(rng.choice("ab \n\t\x0b\x1c\xe9" + "cd" * rng.randrange(9)) for _ in range(rng.randrange(1200))).encode()
        made, start = ngram_join.word_hashes(data)
        want = data.split()
        assert [data[a : a + len(w)] for a, w in zip(start.tolist(), want, strict=True)] == want
        assert len(set(zip(want, made.tolist()))) == len(set(want)) == len(set(made.tolist()))
        assert (ngram_join.word_hashes(b" \n " + data)[0] == made).all()
