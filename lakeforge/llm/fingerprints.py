"""Operator 10: document fingerprints as invertible Bloom lookup sketches.

Paragraphs (lines, in runs of at most PARAGRAPH words) are hashed to digests.
Every digest goes into one cell of each of three subtables; a cell holds the
number of its digests, their xor and the xor of their checks.  The sketches of
two versions subtract cell by cell: what both have cancels, and peeling (take a
cell with one digest, remove it from its other cells, repeat) recovers the
digests that differ.  A sketch that cannot be peeled is tried again larger: the
digests are split into sections of their own tables, and a section that fails
gets a larger table.

Everything is an expression over one row; only finding each document's next one
moves texts, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, let, text_key, text_of, wrap

PARAGRAPH = 32  # words
CELLS = 24  # of a fingerprint and of a section's table, a multiple of 3
ROUNDS = 8
_RUN = f"[^ \t-\r]++(?:[ \t]++[^ \t-\r]++){{0,{PARAGRAPH - 1}}}+"


def digests(col: str):
    """Distinct paragraph digests of a text column, an array of longs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(col, F.lit(_RUN), F.lit(0)), lambda p: F.xxhash64(p)))


def entries(values: str, sign: int, cells: int, salt: int) -> str:
    """SQL: each digest with its sign, its three cells and its check."""
    third = cells // 3
    place = ", ".join(f"cast(pmod(xxhash64(x, {salt * 8 + j}), {third}) as int) + {j * third} as p{j}" for j in range(3))
    return f"transform({values}, x -> struct({sign} as s, x as x, {place}, xxhash64(x, 1000) & 4294967295L as k))"


def cells_of(ent: str, cells: int) -> str:
    """SQL: the table of cells (n, x, k) of an array of entries."""
    add = "aggregate(filter(%s, e -> e.p0 = c or e.p1 = c or e.p2 = c), struct(0 as n, 0L as x, 0L as k), (u, e) -> struct(u.n + e.s as n, u.x ^ e.x as x, u.k ^ e.k as k))"
    return f"transform(sequence(0, {cells - 1}), c -> {add % ent})"


def subtract(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (p, q) -> struct(p.n - q.n as n, p.x ^ q.x as x, p.k ^ q.k as k))"


def peel(table: str, cells: int, salt: int) -> str:
    """SQL: the digests left in a table of differences, null when it cannot be peeled."""
    third = cells // 3
    place = ", ".join(f"cast(pmod(xxhash64(q.x, {salt * 8 + j}), {third}) as int) + {j * third} as p{j}" for j in range(3))
    pure = (
        f"array_distinct(transform(filter(t.cells, q -> (q.n = 1 or q.n = -1) and q.k = (xxhash64(q.x, 1000) & 4294967295L)), "
        f"q -> struct(q.n as s, q.x as x, {place}, q.k as k)))"
    )
    gone = "aggregate(filter(r, e -> e.p0 = c or e.p1 = c or e.p2 = c), q, (u, e) -> struct(u.n - e.s as n, u.x ^ e.x as x, u.k ^ e.k as k))"
    step = let("r", pure, f"if(size(r) = 0, t, struct(transform(t.cells, (q, c) -> {gone}) as cells, concat(t.found, transform(r, e -> e.x)) as found))")
    done = "forall(t.cells, q -> q.n = 0 and q.x = 0 and q.k = 0)"
    peeled = f"aggregate(sequence(1, {ROUNDS}), struct({table} as cells, cast(array() as array<bigint>) as found), (t, i) -> {step})"
    return let("t", peeled, f"if({done}, t.found, null)")


def recovered(a: str, b: str, cells: int, salt: int) -> str:
    """SQL: digests in which two arrays differ, through one table; null on failure."""
    return let("w", f"concat({entries(a, 1, cells, salt)}, {entries(b, -1, cells, salt)})", peel(cells_of("w", cells), cells, salt))


def section(a: str, b: str) -> str:
    """SQL: the same for a section, retried in larger tables; past these, by comparison of the arrays."""
    tries = ", ".join(recovered(a, b, CELLS * 4**k, k + 1) for k in range(3))
    return f"if(size({a}) + size({b}) = 0, cast(array() as array<bigint>), coalesce({tries}, concat(array_except({a}, {b}), array_except({b}, {a}))))"


def larger(a: str, b: str) -> str:
    """SQL: all differing digests, in sections of about six digests each."""
    n = f"cast(pow(2, ceil(log2(greatest((size({a}) + size({b})) / 6.0, 1.0)))) as int)"
    dealt = lambda v: f"transform({v}, x -> struct(x as x, pmod(xxhash64(x, 7), g) as h))"
    part = lambda v: f"transform(filter({v}, y -> y.h = h), y -> y.x)"
    one = let("sa", part("da"), let("sb", part("db"), section("sa", "sb")))
    return let("g", n, let("da", dealt(a), let("db", dealt(b), f"flatten(transform(sequence(0, g - 1), h -> {one}))")))


def sketch(values: str) -> str:
    return let("w", entries(values, 1, CELLS, 0), cells_of("w", CELLS))


def as_text(values: str, table: str) -> str:
    """SQL: a sketch as hexadecimal text, the number of digests first."""
    cell = "concat(lpad(lower(hex(q.n)), 4, '0'), lpad(lower(hex(q.x)), 16, '0'), lpad(lower(hex(q.k)), 8, '0'))"
    return f"concat(lpad(lower(hex(size({values}))), 8, '0'), array_join(transform({table}, q -> {cell}), ''))"


def likeness(a: str, b: str, differing: str) -> str:
    """SQL: share of digests that both sides have (1 when both have none)."""
    return f"if(size({a}) + size({b}) = 0, 1.0D, 1.0D - size({differing}) / cast(size({a}) + size({b}) as double))"


def next_rows(rows: DataFrame, per_bucket: int = 1024, most: int = 1 << 14) -> DataFrame:
    """Rows (doc_id, key, body, ...) with ``next_body``: the text of the next row by doc_id.

    Null ids come first, rows of one id follow by content, the last row's next
    is the first.  Ids are cut into buckets at their quantiles, so a bucket is
    a bounded share of the rows; the first row of each bucket is also added to
    the bucket before it.  The list of buckets (at most ``most``) is bounded.
    """
    n = rows.count()
    buckets = int(max(64, min(most, n // per_bucket)))
    cuts = rows.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 100 * buckets).alias("q")).first()["q"] or []
    cuts = sorted(set(cuts))
    if cuts:
        # binary search: how many cuts are not above the id
        steps = len(cuts).bit_length()
        bound = F.array(*[F.lit(c).cast("long") for c in cuts]) if len(cuts) < 64 else F.from_json(F.lit("[" + ",".join(map(str, cuts)) + "]"), "array<bigint>")
        rows = rows.withColumn("cuts", bound).withColumn("bucket", F.expr(
            f"aggregate(sequence(1, {steps}), struct(0 as lo, {len(cuts)} as hi), (s, i) -> if(s.lo >= s.hi, s, "
            f"if(cuts[cast((s.lo + s.hi) / 2 as int)] <= doc_id, struct(cast((s.lo + s.hi) / 2 as int) + 1 as lo, s.hi as hi), "
            f"struct(s.lo as lo, cast((s.lo + s.hi) / 2 as int) as hi)))).lo")).withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("bucket"))).drop("cuts")
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    first = rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "key")).alias("f"))
    order = Window.orderBy("bucket")  # one row per bucket
    halo = first.select(
        F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias("to"),
        F.col("f.doc_id").alias("f_id"), F.col("f.key").alias("f_key"),
    )
    heads = (
        rows.select("doc_id", "key", "body")
        .join(F.broadcast(halo), F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("key") == F.col("f_key")))
        .groupBy(F.col("to").alias("bucket"), "doc_id", "key").agg(F.first("body").alias("body"))
        .withColumn("head", F.lit(True))
    )
    both = rows.withColumn("head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    nearby = Window.partitionBy("bucket").orderBy("head", F.col("doc_id").asc_nulls_first(), "key")
    return both.withColumn("next_body", F.lead("body").over(nearby)).where(~F.col("head")).drop("head", "bucket")


def fingerprints(docs: DataFrame) -> DataFrame:
    """The caller's columns (one struct), n_chars, edited (the text whose last
    quarter comes from the next document), fingerprint, edited_fingerprint, the
    recovered digests changed_edited and changed_next, near_edited, near_next.

    Null text counts as empty; a text without words has an empty sketch, and
    two such texts are alike (1.0).  Null ids come first, repeated ids follow
    by content.  An empty table gives an empty result.
    """
    rows = wrap(docs, "doc_id", "text").select(ROW, "doc_id", text_of().alias("body")).withColumn("key", text_key(F.col("body")))
    n, q = F.length("body"), F.floor(F.length("body") / 4).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), n - q), F.substring("next_body", F.lit(1), q))
    made = next_rows(rows).select(ROW, n.cast("long").alias("n_chars"), edited.alias("edited"), digests("body").alias("va"), "next_body")
    made = made.withColumn("vb", digests("edited")).withColumn("vc", digests("next_body")).drop("next_body")
    for v in "abc":
        made = made.withColumn(f"s{v}", F.expr(sketch(f"v{v}")))
    for v, name in (("b", "edited"), ("c", "next")):
        made = made.withColumn(f"changed_{name}", F.expr(f"coalesce({peel(subtract('sa', f's{v}'), CELLS, 0)}, {larger('va', f'v{v}')})"))
    return made.select(
        ROW, "n_chars", "edited",
        F.expr(as_text("va", "sa")).alias("fingerprint"), F.expr(as_text("vb", "sb")).alias("edited_fingerprint"),
        "changed_edited", "changed_next",
        F.expr(likeness("va", "vb", "changed_edited")).alias("near_edited"), F.expr(likeness("va", "vc", "changed_next")).alias("near_next"),
    )
