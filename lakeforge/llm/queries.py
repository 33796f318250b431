"""Queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import bpe, fingerprints, hard_negatives, html_text, line_dedup, mixing, ngram_join, oracles, pii, quality, ranked_search, secrets, top_k, toxicity
from lakeforge.llm.common import ROW, table

DOC_ID = f"{ROW}.doc_id"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), machine).select(DOC_ID, toxicity.held_out(f"{ROW}.doc_id").alias("held_out"), "score", "predicted")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), remember=True)
    return made.select(
        DOC_ID, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_dedup.dedup(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select(DOC_ID, F.col("clean").alias("text"), "n_lines", "n_dropped")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = html_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return made.select(f"{ROW}.page_id", f"{ROW}.url", F.col("main").alias("text"), F.length("main").cast("long").alias("n_chars"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(DOC_ID, "size", "source_size", "target", "taken")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality.score(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select(DOC_ID, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_words_left")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.protect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(DOC_ID, F.col("clean").alias("text"), F.size("kinds").cast("long").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(DOC_ID, "n_shingles", "component_id")


def op8_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_counts(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(DOC_ID, "n_shingles", "n_links")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return made.select(
        DOC_ID, *[of(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"), secrets.as_text(F.col("secrets")).alias("spans"),
    )


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        DOC_ID, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.size("changed_edited").cast("long").alias("n_changed_edited"), F.size("changed_next").cast("long").alias("n_changed_next"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity, op2_bpe, op3_line_dedup, op4_html_extraction, op5_mixing, op6_quality_rules, op7_pii, op8_ngram_jaccard_join, op8_ngram_links, op9_secret_scan, op10_document_fingerprints,
              op11_hard_negatives, op12_ranked_search, op13_top_k)
}

ORACLES: dict[str, str] = {"op5_mixing": mixing.ORACLE, "op6_quality_rules": oracles.QUALITY, "op8_ngram_jaccard_join": oracles.NGRAM_JOIN, "op8_ngram_links": oracles.NGRAM_LINKS, "op3_line_dedup": oracles.LINE_DEDUP,
                           "op11_hard_negatives": hard_negatives.ORACLE, "op12_ranked_search": ranked_search.ORACLE, "op13_top_k": top_k.ORACLE}
