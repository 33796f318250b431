"""Operator 6: quality rules from cross-document line frequency.

Normalised lines are hashed; per host (the document's source) the distinct
documents that hold a line are counted; lines above the limit are boilerplate
and are taken out; documents that lose too much with them are rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, WORD, WS, key_mask, let, masked, materialise, text_key, text_of, wrap

#: characters counted as symbols
SYMBOLS = "#*$%&|<>"
WS_CHARS = " \t\n\x0b\x0c\r"


def without(col: Column, chars: str) -> Column:
    return F.translate(col, chars, "")


def repeat_words() -> Column:
    """Words inside any 5-word window that occurs at least twice in the text.

    Window hashes are compared within the row.  Only a text that has a repeated
    window is sorted: the windows with their places, then the places, whose
    gaps (5 at most each) add up to the covered words.
    """
    hashes = "transform(regexp_extract_all(body, word_re, 0), w -> xxhash64(w))"
    windows = "transform(slice(h, 1, greatest(size(h) - 4, 0)), (x, i) -> xxhash64(x, h[i + 1], h[i + 2], h[i + 3], h[i + 4]))"
    twice = "filter(o, (x, k) -> coalesce(x.v = get(o, k - 1).v, false) or coalesce(x.v = get(o, k + 1).v, false))"
    starts = f"array_sort(transform({twice}, x -> x.p))"
    covered = "aggregate(transform(s, (p, k) -> least(5, coalesce(get(s, k + 1) - p, 5))), 0, (a, x) -> a + x)"
    ordered = let("o", "array_sort(transform(v, (x, i) -> struct(x as v, i as p)))", let("s", starts, covered))
    return F.expr(let("h", hashes, let("v", windows, f"if(size(array_distinct(v)) = size(v), 0, {ordered})"))).cast("long")


def measures(rows: DataFrame) -> DataFrame:
    """Base measures of each row's ``body`` (null text: empty)."""
    lines = F.filter(F.split("body", "\n", -1), lambda x: x.rlike(f"[^{WS}]"))
    return (
        rows.withColumn("word_re", F.lit(WORD))
        .withColumn("n_words", F.regexp_count("body", F.lit(WORD)).cast("long"))
        .withColumn("word_chars", F.length(without(F.col("body"), WS_CHARS)).cast("long"))
        .withColumn("n_symbols", (F.length("body") - F.length(without(F.col("body"), SYMBOLS))).cast("long"))
        .withColumn("n_dup_lines", F.aggregate(F.array(lines), F.lit(0), lambda _, x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", repeat_words())
        .withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))
        .drop("word_re")
    )


def normalised(line: Column) -> Column:
    """Lower case, every digit 0, white space runs one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), f"[{WS}]+", " "))


def line_rows(rows: DataFrame, min_words: int) -> DataFrame:
    """(host, key, line, words, times) per document and distinct normalised line of enough words."""
    lines = F.transform(F.split("body", "\n", -1), lambda x: normalised(x))
    counted = (
        rows.select("host", "key", F.explode(lines).alias("norm"))
        .where(F.col("norm") != "")
        .withColumn("words", F.regexp_count("norm", F.lit("[^ ]+")))
        .where(F.col("words") >= min_words)
    )
    return counted.select("host", "key", F.xxhash64("norm", F.lit(1)).alias("line"), "words")


def score(
    docs: DataFrame, min_docs: int = 3, max_share: float = 0.05, min_line_words: int = 3,
    min_left: int = 10, min_left_share: float = 0.3, keep: Sequence[str] | None = None,
) -> DataFrame:
    """The caller's columns (one struct; ``keep``: only these), the base measures, n_words_left and kept.

    A line of ``min_line_words`` words or more is above the limit when more
    than ``max_share`` of its host's distinct documents hold it, and
    ``min_docs`` of them or more: one rule for hosts of every size.  Exact copies count as one
    document.  A document is depleted when fewer than ``min_left`` words or
    less than ``min_left_share`` of its words remain without such lines.

    Null text counts as empty, null source is a host of its own; repeated rows
    get equal results; an empty table gives an empty result.
    """
    rows = wrap(docs, "text", "source", keep=keep).select(
        ROW, text_of().alias("body"), F.coalesce(F.concat(F.lit("h"), F.col("source").cast("string")), F.lit("")).alias("host"),
    ).withColumn("key", text_key(F.col("body")))
    hosts = rows.groupBy("host").agg(F.count_distinct("key").alias("host_docs"))
    lines = line_rows(rows, min_line_words)
    held = lines.groupBy("host", "line").agg(F.count_distinct("key").alias("held")).where(F.col("held") >= min_docs)
    common = materialise(
        held.join(hosts, "host").where(F.col("held") > F.col("host_docs") * max_share).select("host", "line"), "quality_lines"
    )
    spot = F.struct("host", "line")
    cut = (
        masked(lines.select("host", "key", "line", "words"), spot, key_mask(common, spot))
        .join(common, ["host", "line"], "left_semi")
        .groupBy("host", "key").agg(F.sum("words").alias("cut_rows"), F.count("*").alias("n_cut"))
    )
    # copies of one text each add their lines to the sums of (host, key): divide by their number
    copies = rows.groupBy("host", "key").agg(F.count("*").alias("copies"))
    cut = materialise(
        cut.join(copies, ["host", "key"]).select("host", "key", (F.col("cut_rows") / F.col("copies")).cast("long").alias("n_words_cut")), "quality_cut"
    )
    judged = measures(rows).join(cut, ["host", "key"], "left").withColumn("n_words_left", F.col("n_words") - F.coalesce("n_words_cut", F.lit(0)))
    depleted = (F.col("n_words_left") < min_left) | (F.col("n_words_left") < F.col("n_words") * min_left_share)
    return judged.select(
        ROW, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_words_left",
        (~F.col("base_failed") & ~depleted).alias("kept"),
    )
