"""Operator 3: line dedup with a log-template tree.

A line descends a tree of fixed depth: its token count, then its leading
tokens (a token with a digit is a variable field).  A leaf's template has, at
each place, the token that at least half of its lines share, or a variable.  A
line that fits the leaf's template takes it; any other line is its own template
(with its digit fields variable).  A template that recurs in enough different
texts is boilerplate: all its lines go but the first.  Long lines are passages
and recur from two texts on.  A text that is a near copy of the one that keeps
the first line is no place of recurrence: it keeps its lines, whole, for the
removal of near duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, WORD, key_mask, let, masked, materialise, text_key, text_of, wrap

VARIABLE = "<*>"


def shape(words: Column) -> Column:
    """Single-spaced words with variables in place of those that hold a digit."""
    return F.when(words.rlike("[0-9]"), F.regexp_replace(words, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", VARIABLE)).otherwise(words)


def template_lines(rows: DataFrame, depth: int, min_words: int) -> DataFrame:
    """(doc_id, key, line_no, words, n, lead) of every line long enough to be a template."""
    odd = F.col("text").startswith(" ") | F.col("text").endswith(" ")
    for c in ("  ", "\n ", " \n", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains("text", F.lit(c))
    # white space is put in order once per text, and only where it is not
    single = F.regexp_replace("text", "[ \t\x0b\x0c\r]+", " ")
    neat = F.when(odd, F.trim(F.replace(F.replace(single, F.lit("\n "), F.lit("\n")), F.lit(" \n"), F.lit("\n")))).otherwise(F.col("text"))
    return (
        rows.select("doc_id", "key", F.posexplode(F.split(neat, "\n", -1)).alias("line_no", "words"))
        .withColumn("n", F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1)
        .where(F.col("n") >= min_words)
        .withColumn("lead", shape(F.substring_index("words", " ", depth)))
    )


def shingle_set(text: str) -> Column:
    """Hashes of the distinct five-word shingles of a text."""
    windows = "transform(slice(h, 1, greatest(size(h) - 4, 0)), (x, i) -> xxhash64(x, h[i + 1], h[i + 2], h[i + 3], h[i + 4]))"
    return F.expr(let("h", f"transform(regexp_extract_all({text}, word_re, 0), w -> xxhash64(w))", f"array_distinct({windows})"))


def near_copies(rows: DataFrame, shared: DataFrame, share: float = 0.25, percent: int = 80) -> DataFrame:
    """(key, first_key) of ``shared`` whose texts have five-word shingles in common to ``percent`` or more.

    Only pairs that share lines of ``share`` of the text's length are compared,
    each text with the holder of the first line: never all pairs of a group.
    """
    sizes = rows.groupBy("key").agg(F.max(F.length(text_of())).alias("size"))
    pairs = shared.groupBy("key", "first_key").agg(F.sum("chars").alias("chars")).join(sizes, "key")
    pairs = materialise(pairs.where(F.col("chars") >= F.col("size") * share).select("key", "first_key"), "line_pairs")
    asked = pairs.select("key").unionByName(pairs.select(F.col("first_key").alias("key"))).distinct()
    texts = masked(rows.select("key", text_of().alias("body")), F.col("key"), key_mask(asked, F.col("key"))).join(asked, "key", "left_semi")
    # texts move, not their shingles: hashes take more room and do not compress
    texts = materialise(texts.groupBy("key").agg(F.first("body").alias("body")), "line_texts")
    both = pairs.join(texts.select(F.col("key").alias("first_key"), F.col("body").alias("first_body")), "first_key").join(texts, "key")
    sets = both.withColumn("word_re", F.lit(WORD)).select("key", "first_key", shingle_set("body").alias("set"), shingle_set("first_body").alias("first_set"))
    common = F.size(F.array_intersect("set", "first_set"))
    return sets.where(common * 100 >= (F.size("set") + F.size("first_set") - common) * percent).select("key", "first_key")


def recurring(rows: DataFrame, depth: int, min_words: int, min_docs: int, similarity: float, passage: int, groups: DataFrame | None = None) -> DataFrame:
    """(key, line_no) of the lines to drop."""
    lines = template_lines(rows, depth, min_words)
    leaf = F.xxhash64("n", "lead")
    # leaves with lines of at least two texts: one shuffle, combined before it
    text = F.xxhash64("key")
    leaves = materialise(
        lines.groupBy(leaf.alias("leaf")).agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a <> b").select("leaf"), "line_leaves"
    )
    mask = materialise(key_mask(leaves, F.col("leaf")), "line_mask", files=1)
    shared = masked(lines.withColumn("leaf", leaf), F.col("leaf"), mask).join(leaves, "leaf", "left_semi")
    # exact copies of a text count once
    held = materialise(
        shared.groupBy("key", "line_no", "n", "lead", "words").agg(F.min("doc_id").alias("doc_id"))
        .select("key", "line_no", "n", "lead", shape(F.col("words")).alias("shape"), F.length("words").alias("chars"), "doc_id"), "line_shapes"
    )

    # tokens are counted per distinct shape, weighted by its lines; a leaf of one shape needs no template of its own
    shapes = held.groupBy("n", "lead", "shape").agg(F.count("*").alias("times"))
    sizes = shapes.groupBy("n", "lead").agg(F.sum("times").alias("lines"), F.count("*").alias("shapes")).where("shapes > 1")
    mixed = materialise(shapes.join(sizes, ["n", "lead"]).select("n", "lead", "shape", "times", "lines"), "line_mixed")
    tokens = mixed.select("n", "lead", "lines", "times", F.posexplode(F.split("shape", " ")).alias("place", "token"))
    common = (
        tokens.groupBy("n", "lead", "lines", "place", "token").agg(F.sum("times").alias("times"))
        .groupBy("n", "lead", "lines", "place").agg(F.max(F.struct("times", "token")).alias("top"))
        .where(F.col("top.times") * 2 >= F.col("lines"))
        .groupBy("n", "lead").agg(F.collect_list(F.struct("place", F.col("top.token").alias("token"))).alias("constants"))
    )
    fits = F.expr(let("w", "split(shape, ' ')", "aggregate(constants, 0, (a, c) -> a + if(get(w, c.place) <=> c.token, 1, 0))"))
    fitting = mixed.join(common, ["n", "lead"]).where(fits >= F.col("n") * F.lit(similarity)).select("n", "lead", "shape", F.lit(True).alias("fits"))
    template = F.when(F.col("fits"), F.concat_ws(" ", F.lit("leaf"), F.col("n").cast("string"), "lead")).otherwise(F.concat_ws(" ", F.lit("line"), "shape"))
    fitted = held.join(fitting, ["n", "lead", "shape"], "left").select("key", "line_no", "doc_id", "n", "chars", text_key(template).alias("template"))
    if groups is not None:
        return alike(fitted, groups, min_docs, passage)
    fitted = materialise(fitted, "line_templates")
    place = F.struct("doc_id", "key", "line_no")
    templates = (
        fitted.groupBy("template").agg(F.count_distinct("key").alias("texts"), F.min(place).alias("first"), F.max("n").alias("words"))
        .where(F.col("texts") >= F.when(F.col("words") > passage, min(2, min_docs)).otherwise(min_docs)).select("template", "first")
    )
    found = materialise(
        fitted.join(templates, "template").where(place != F.col("first")).select("key", "line_no", "chars", F.col("first.key").alias("first_key")), "line_found"
    )
    copies = near_copies(rows, found.where("key <> first_key"))
    return found.join(copies, ["key", "first_key"], "left_anti").select("key", "line_no")


def alike(fitted: DataFrame, groups: DataFrame, min_docs: int, passage: int) -> DataFrame:
    """(key, line_no) of the lines to drop when a group of near copies counts as one text.

    The group of a template's first line keeps it, each of its texts its own
    first line; all other groups and texts lose it.
    """
    held = materialise(fitted.join(groups, "key", "left").withColumn("holder", F.coalesce("group", "key")).drop("group"), "line_held")
    templates = (
        held.groupBy("template").agg(F.count_distinct("holder").alias("texts"), F.min(F.struct("doc_id", "key", "line_no", "holder")).alias("first"), F.max("n").alias("words"))
        .where(F.col("texts") >= F.when(F.col("words") > passage, min(2, min_docs)).otherwise(min_docs)).select("template", F.col("first.holder").alias("first_holder"))
    )
    found = materialise(held.join(templates, "template").select("key", "line_no", "template", (F.col("holder") == F.col("first_holder")).alias("own")), "line_found")
    again = found.where("own").groupBy("template", "key").agg(F.array_sort(F.collect_list("line_no")).alias("nos")).where(F.size("nos") > 1)
    return found.where("not own").select("key", "line_no").unionByName(again.select("key", F.explode(F.expr("slice(nos, 2, size(nos) - 1)")).alias("line_no")))


def dedup(
    docs: DataFrame, depth: int = 3, min_words: int = 5, min_docs: int = 3, similarity: float = 0.7, passage: int = 50,
    keep: Sequence[str] | None = None, groups: DataFrame | None = None,
) -> DataFrame:
    """The caller's columns but the text (one struct; ``keep``: only these),
    ``clean`` (the text without the dropped lines), n_lines and n_dropped.

    Lines of fewer than ``min_words`` tokens are never templates.  A template
    recurs when ``min_docs`` different texts hold it, with more than
    ``passage`` tokens when two do; its first line (lowest doc_id, null first)
    stays, and so do the lines of a text that is a near copy (five-word
    shingles, 0.8) of the first line's text.  Exact copies count as one text and lose the
    same lines, so they stay exact copies.  With ``groups`` (key, group: the
    near copies by content key) a group counts as one text too: its texts keep
    or lose a template alike, and nothing else is compared.  Null text stays null, empty texts
    and repeated rows are kept as rows; an empty table gives an empty result.
    """
    rows = keyed(docs, keep)
    return without(rows, drops(rows, depth, min_words, min_docs, similarity, passage, groups)).drop("key")


def keyed(docs: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """The caller's columns but the text (one struct; ``keep``: only these), doc_id, text and its content key."""
    keep = [c for c in docs.columns if c != "text"] if keep is None else keep
    return wrap(docs, "doc_id", "text", keep=keep).withColumn("key", text_key(text_of()))


def drops(
    rows: DataFrame, depth: int = 3, min_words: int = 5, min_docs: int = 3, similarity: float = 0.7, passage: int = 50, groups: DataFrame | None = None
) -> DataFrame:
    """(key, gone): the line numbers that go from the texts of ``keyed`` rows, as a written table."""
    found = recurring(rows, depth, min_words, min_docs, similarity, passage, groups)
    return materialise(found.groupBy("key").agg(F.collect_list("line_no").alias("gone")), "line_drops")


def without(rows: DataFrame, drop: DataFrame) -> DataFrame:
    """``keyed`` rows as ``dedup`` gives them, and their key."""
    some, none = dealt(rows.drop("doc_id"), drop, "line_mask")
    return less(some.unionByName(none)).select(ROW, "key", "clean", "n_lines", "n_dropped")


def dealt(rows: DataFrame, marks: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the columns that ``marks`` (one row a key) has for their key, else null: rows whose key
    may be there, which move to meet it, and rows whose key surely is not, which stay where they are."""
    mask = materialise(key_mask(marks, F.col("key")), name, files=1)
    some = masked(rows, F.col("key"), mask).join(marks, "key", "left")
    none = masked(rows, F.col("key"), mask, inside=False)
    return some, none.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in marks.schema if f.name != "key"])


def less(rows: DataFrame) -> DataFrame:
    """The rows (text, and gone: the line numbers that go, or null) with clean, n_lines and n_dropped."""
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("gone", i)), "\n")
    return rows.select(
        "*",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("clean"),
        (F.length(text_of()) - F.length(F.replace(text_of(), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    )
