"""Corpus pipeline: toxicity, line dedup, near duplicates, source mix, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
rows that the stage before it kept, and its result is written and read again
before the next one.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import bpe, line_dedup, mixing, ngram_join, passages, toxicity
from lakeforge.llm.common import ROW, WORD, materialise, table, temporary, text_key, text_of, unwrap
from lakeforge.llm.queries import tokenizer_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents with a score of 0.7 or more go; the model learns from the table's labels.

    Null and empty texts get the score of a text without terms; repeated rows go or stay
    together; an empty table stays empty.
    """
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return unwrap(toxicity.score(docs, machine).where("predicted = 0"))


def recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: recurring lines and passages go from the texts (n_chars follows); every document stays.

    A passage is a run of over 50 words that different texts share, whatever their lines.
    Near copies keep or lose lines and passages alike, and a group of them that
    would no longer be one for the next stage stays whole.

    What recurs stays with the text of the smallest doc_id (null first, then by
    content); null and empty texts stay as they are; exact copies count as one
    text and stay equal; an empty table stays empty.
    """
    rows = line_dedup.keyed(docs)
    with temporary() as hold:
        groups = ngram_join.groups(docs, *ngram_join.NEAR)
        drop = line_dedup.drops(rows, groups=groups)
        # a text meets its lines and its group at once: every join is one more plan that the driver keeps
        some, none = line_dedup.dealt(rows, materialise(drop.join(groups, "key", "full"), "line_marks"), "line_mask")
        held = line_dedup.less(some.unionByName(none)).select(
            "key", "doc_id", "group", F.xxhash64(F.coalesce("group", "key")).alias("holder"), text_of("clean").alias("body")
        )
        held = materialise(held, "line_rows")
        places = passages.places_to_drop(held.select("key", "doc_id", "holder", "body"))
        # of all tables only what goes is kept, no texts: the texts are cut again from the documents
        edits = drop.join(places, "key", "full").join(apart(held, places), "key", "left_anti")
        edits = hold(materialise(edits.select("key", "gone", "places"), "line_drops"))
    some, none = line_dedup.dealt(rows, edits, "line_mask")
    some = line_dedup.less(some).select(
        ROW, passages.less_places("clean", "places").alias("text"), (F.col("gone").isNotNull() | F.col("places").isNotNull()).alias("less")
    )
    cut = none.select(ROW, "text", F.lit(False).alias("less")).unionByName(some)
    out = []
    for c in docs.columns:
        if c == "text":
            out.append("text")
        elif c == "n_chars":
            out.append(F.when(F.col("less"), F.length("text").cast("long")).otherwise(F.col(f"{ROW}.n_chars")).alias("n_chars"))
        else:
            out.append(F.col(f"{ROW}.`{c}`").alias(c))
    return cut.select(*out)


def apart(held: DataFrame, places: DataFrame) -> DataFrame:
    """(key) of the texts whose group of near copies would no longer be one group after the cuts: they stay whole.

    ``held``: key, doc_id, group and body, the text without recurring lines; ``places``: of the passages that go from it.
    """
    some, none = line_dedup.dealt(held.where("group is not null").select("key", "group", "doc_id", "body"), places, "passage_mask")
    near = none.select("key", "group", "doc_id", F.col("body").alias("text"))
    near = materialise(near.unionByName(some.select("key", "group", "doc_id", passages.less_places("body", "places").alias("text"))), "line_near")
    after = ngram_join.groups(near.select("doc_id", "text"), *ngram_join.NEAR).select(F.col("key").alias("now"), F.col("group").alias("now_group"))
    seen = near.select("key", "group", text_key(text_of()).alias("now"), F.col("text").rlike(WORD).alias("any")).distinct().join(after, "now", "left")
    # a text without words is linked with nothing
    broken = seen.groupBy("group").agg(F.count_distinct(F.coalesce("now_group", "now")).alias("parts"), F.min("any").alias("any")).where("parts > 1 or not any")
    return near.select("key", "group").distinct().join(broken, "group", "left_semi").select("key")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of linked documents the one with the smallest id stays.

    Documents without words are linked with nothing and stay.
    """
    return ngram_join.distinct(docs, *ngram_join.NEAR)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each document as often as the mix takes it (0 to 2 times).

    A null source is a source of its own, the last; texts without words have size 0 and take no room;
    repeated rows are taken each by itself; an empty table stays empty.
    """
    made = mixing.mix(docs)
    return unwrap(made.select(ROW, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(ROW))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token counts and digests beside the documents' columns.

    Null and empty texts have no tokens; repeated rows get equal results; an empty table stays empty.
    """
    made = bpe.encode(docs, tokenizer_path())
    return made.select(
        f"{ROW}.*", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", recurring_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary() as keep:  # a stage's working tables go when its result is written
            docs = keep(materialise(stage(spark, docs, sf_dir), f"stage_{name}"))
    return docs


#: A learned model and a tokenizer are not SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None
