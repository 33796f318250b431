"""Operator 12: ranked lexical search over range-maximum tables.

1. One pass over the documents makes shards: for some thousand documents their
   lengths and the postings of the items' terms, and sums up the corpus counts.
2. In a shard each term of an item has its posting list laid out over the shard's
   documents with a sparse table of range maxima, so the largest impact of the
   term in any interval of documents, and the document that has it, is two
   lookups.  The sum over the terms bounds every document of the interval.
3. Intervals are taken best bound first, some at a time, and split at the document
   with the largest single impact: that one is scored exactly, what is left and
   right of it goes back with bounds of its own.  Intervals below the k-th best score
   so far are dropped.  Scores of some shards, searched first, are the floors that
   all others start from.
4. The best of the tasks are ranked together.

Impacts are 64-bit integers, so bounds and scores are exact.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import materialise, text_of
from lakeforge.llm.vectors import ranked, whole_id

K = 50
SHARD, POSTINGS = 4_096, 1 << 21  # documents and postings of a shard, at most
TERMS_AT_ONCE = 1 << 16  # terms of the items of one pass, about; more items take more passes
SEEDS = 6  # shards that set the first floors
TABLE_BYTES = 8 << 20  # of one item's range-maximum table; documents are searched in ranges that fit
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # after bytes.lower(): in UTF-8 every byte of a non-ASCII character is 0x80 or more


def terms_of(text: str) -> list[bytes]:
    return _TERM.findall(text.encode("utf-8", "replace").lower())


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(terms=[sorted({t.decode() for t in terms_of(x)}) for x in pdf.pop("body")])


def _shards(vocabulary) -> Callable:
    """Shards of documents, and at the end of a partition its part of the corpus counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {t.encode(): i for i, t in enumerate(vocabulary.value)}
        held = np.zeros(len(place), np.int64)
        texts = total = 0
        docs: list[tuple[int, bool, int]] = []
        terms: list[np.ndarray] = []
        times: list[np.ndarray] = []
        postings = 0

        def shard() -> pd.DataFrame:
            nonlocal docs, terms, times, postings
            ends = np.cumsum([0, *[len(t) for t in terms]])
            made = pd.DataFrame({
                "ids": [np.array([d[0] for d in docs], np.int64).tobytes()], "no_ids": [np.array([d[1] for d in docs], bool).tobytes()],
                "sizes": [np.array([d[2] for d in docs], np.int64).tobytes()], "ends": [ends.astype(np.int64).tobytes()],
                "terms": [np.concatenate(terms).astype(np.int32).tobytes()], "times": [np.concatenate(times).astype(np.int32).tobytes()],
                "texts": [0], "total": [0], "held": [[]],
            })
            docs, terms, times, postings = [], [], [], 0
            return made

        for pdf in batches:
            for id_, no_id, body in zip(pdf["id"], pdf["no_id"], pdf["body"]):
                found = terms_of(body)
                if not found:
                    continue
                texts, total = texts + 1, total + len(found)
                here = [(place[t], c) for t, c in Counter(found).items() if t in place]
                if not here:
                    continue
                t, c = np.array(here, np.int64).T
                held[t] += 1
                if docs and (len(docs) == SHARD or postings + len(t) > POSTINGS):
                    yield shard()
                docs.append((id_, no_id, len(found)))
                terms.append(t)
                times.append(c)
                postings += len(t)
        if docs:
            yield shard()
        there = np.flatnonzero(held)
        yield pd.DataFrame({
            **{c: [None] for c in ("ids", "no_ids", "sizes", "ends", "terms", "times")}, "texts": [texts], "total": [total],
            "held": [[{"term": int(i), "n": int(held[i])} for i in there]],
        })

    return run


class Kept:
    """The k best documents of one item so far; ``floor``: the score that a document must reach."""

    def __init__(self, k: int, floor: int = 1):
        self.k, self.floor = k, floor
        self.score, self.no_id, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, no_id: np.ndarray, id_: np.ndarray) -> None:
        in_ = score >= self.floor
        if not in_.any():
            return
        score, no_id, id_ = (np.concatenate([x, y[in_]]) for x, y in ((self.score, score), (self.no_id, no_id), (self.id, id_)))
        best = np.lexsort((id_, no_id, -score))[: self.k]
        self.score, self.no_id, self.id = score[best], no_id[best], id_[best]
        if len(best) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))


class RangeMaxima:
    """Sparse tables of the columns of ``impacts`` (documents x terms): level l holds the maxima of 2^l documents."""

    def __init__(self, impacts: np.ndarray):
        n = len(impacts)
        self.bits = max(1, (n - 1).bit_length())
        self.levels = np.zeros((n.bit_length(), *impacts.shape), np.int64)
        # impact and document in one number, so that a maximum names its document
        self.levels[0] = (impacts << self.bits) | np.arange(n)[:, None]
        for k in range(1, len(self.levels)):
            half = 1 << (k - 1)
            np.maximum(self.levels[k - 1][: n - 2 * half + 1], self.levels[k - 1][half : n - half + 1], out=self.levels[k][: n - 2 * half + 1])

    def best(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each interval [lo, hi): the sum of the terms' maxima, and the document of the largest."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        top = np.maximum(self.levels[level, lo], self.levels[level, hi - (1 << level)])
        return (top >> self.bits).sum(1), top.max(1) & ((1 << self.bits) - 1)


def search_range(impacts: np.ndarray, no_id: np.ndarray, id_: np.ndarray, kept: Kept) -> None:
    """Best-first search of one range of documents (rows of ``impacts``)."""
    table = RangeMaxima(impacts)
    lo, hi = np.zeros(1, np.int64), np.full(1, len(impacts), np.int64)
    bound, split = table.best(lo, hi)
    many = 16
    while True:
        alive = bound >= kept.floor  # a document as good as the k-th may still win by its id
        if not alive.all():
            lo, hi, bound, split = lo[alive], hi[alive], bound[alive], split[alive]
        if not len(lo):
            return
        if len(lo) > many:
            order = np.argpartition(-bound, many)
            take, leave = order[:many], order[many:]
        else:
            take, leave = np.arange(len(lo)), np.zeros(0, np.int64)
        at = split[take]
        kept.add(impacts[at].sum(1), no_id[at], id_[at])
        left, right = np.concatenate([lo[take], at + 1]), np.concatenate([at, hi[take]])
        some = right > left
        left, right = left[some], right[some]
        more, where = table.best(left, right) if len(left) else (left, left)
        lo, hi = np.concatenate([lo[leave], left]), np.concatenate([hi[leave], right])
        bound, split = np.concatenate([bound[leave], more]), np.concatenate([split[leave], where])
        many = min(1024, 2 * many)


def _search(items, weights, texts: int, total: int, k: int, floors) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = {item: Kept(k, floors.get(item, 1)) for item, _ in items.value}
        w = weights.value
        for pdf in batches:
            for row in pdf.itertuples():
                no_id, id_ = np.frombuffer(row.no_ids, bool), np.frombuffer(row.ids, np.int64)
                size, ends = np.frombuffer(row.sizes, np.int64), np.frombuffer(row.ends, np.int64)
                term, tf = np.frombuffer(row.terms, np.int32), np.frombuffer(row.times, np.int32).astype(np.int64)
                m = 100 - 50 + (50 * size * texts) // total
                doc = np.repeat(np.arange(len(size)), np.diff(ends))
                impact = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                order = np.argsort(term, kind="stable")
                doc, impact = doc[order], impact[order]
                start = np.searchsorted(term[order], np.arange(len(w) + 1))
                for item, wanted in items.value:
                    lists = [(doc[start[t] : start[t + 1]], impact[start[t] : start[t + 1]]) for t in wanted if start[t] < start[t + 1]]
                    if sum(int(x.max()) for _, x in lists) < kept[item].floor:
                        continue
                    impacts = np.zeros((len(size), len(lists)), np.int64)
                    for c, (at, x) in enumerate(lists):
                        impacts[at, c] = x
                    span = 1 << max(4, (TABLE_BYTES // (8 * 12 * len(lists))).bit_length() - 1)
                    for at in range(0, len(size), span):
                        part = slice(at, at + span)
                        search_range(impacts[part], no_id[part], id_[part], kept[item])
        for item, best in kept.items():
            if len(best.id):
                yield pd.DataFrame({"item": item, "score": best.score, "no_id": best.no_id, "id": best.id})

    return run


def weight(texts: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * texts + 2) / (2 * held + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0.

    A term is a run of characters other than ASCII ones that are no letter or
    digit, A-Z folded.  Null and empty texts have no terms: such documents
    count nowhere, such items get no rows.  Equal scores go by ascending doc_id,
    null ids last.  Repeated rows are documents (and items) of their own.  Either
    table empty gives an empty result.

    The items' terms are broadcast, about TERMS_AT_ONCE of them in a pass (one item is
    never parted); every pass reads all documents.
    """
    spark = docs.sparkSession
    asked = items.select("item_id", text_of().alias("body")).withColumn("item", F.monotonically_increasing_id())
    asked = materialise(asked.select("item", F.col("item_id").cast("string").alias("name"), "body").mapInPandas(_item_terms, "item long, name string, terms array<string>"), "search_items")
    passes = max(1, -(-int(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // TERMS_AT_ONCE))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.col("doc_id").isNull().alias("no_id"), text_of().alias("body"))
    found = [_one_pass(rows, asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == n), k) for n in range(passes)]
    made = found[0]
    for f in found[1:]:
        made = made.unionByName(f)
    best = ranked(made.withColumn("rid", F.lit(0)), ["item"], k)
    item_type = dict(items.dtypes)["item_id"]
    return best.join(asked.select("item", "name"), "item").select(
        F.col("name").cast(item_type).alias("item_id"), F.col("rank").cast("int").alias("rank"), whole_id().alias("doc_id"), "score"
    )


def _one_pass(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    wanted = asked.select("item", "terms").collect()  # about TERMS_AT_ONCE terms
    vocabulary = sorted({t for r in wanted for t in r["terms"]})
    place = {t: i for i, t in enumerate(vocabulary)}
    made = rows.mapInPandas(
        _shards(sc.broadcast(vocabulary)),
        "ids binary, no_ids binary, sizes binary, ends binary, terms binary, times binary, texts long, total long, held array<struct<term:int,n:long>>",
    )
    made = materialise(made, "search_shards")
    texts, total = (int(x or 0) for x in made.agg(F.sum("texts"), F.sum("total")).first())
    held = np.zeros(len(vocabulary), np.int64)
    for r in made.select(F.inline("held")).groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most one row for each term
        held[r["term"]] = r["n"]
    weights = sc.broadcast(np.array([weight(texts, int(h)) for h in held], np.int64))
    items = sc.broadcast([(r["item"], np.array([place[t] for t in r["terms"]], np.int64)) for r in wanted])
    shards = made.where("ids is not null").select("ids", "no_ids", "sizes", "ends", "terms", "times")
    search_ = lambda part, floors: part.mapInPandas(_search(items, weights, texts, max(total, 1), k, floors), "item long, score long, no_id boolean, id long")
    # the k-th best score of any documents is a floor for all: it spares work and drops nothing
    seeds = search_(shards.limit(SEEDS), {}).groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = {r["item"]: r["least"] for r in seeds.collect() if r["n"] >= k}
    return search_(shards, floors)


ORACLE = """
WITH words AS (SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
               FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
d AS (SELECT r, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM words WHERE len(t) > 0),
c AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(t) AS term FROM d) GROUP BY r, doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nn) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY term),
q AS (SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
      FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
s AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term), c GROUP BY i, item_id, r, doc_id)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS k FROM s WHERE score > 0) WHERE k <= 50
"""
