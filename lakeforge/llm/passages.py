"""Operator 3, second part: runs of over 50 words that different texts share, wherever they stand.

1. Winnowing: of any 32 successive 20-word hashes the smallest is a fingerprint.
   A window of 51 words holds 32 of them, so texts that share a window share a
   fingerprint, whatever their lines.
2. Only windows whose fingerprint another holder has move, as hashes.  A window
   of two holders or more stays with the first one (lowest doc_id); in all
   others its words go, so that a run goes to its full length.

A holder is a group of near copies or, without one, a text: near copies share
their passages and keep or lose them alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeforge.llm.common import WORD, key_mask, masked, materialise, temporary
from lakeforge.llm.ngram_join import word_hashes

WINDOW, GRAM = 51, 20  # words
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_BACK = pow(_BASE, -1, 1 << 64)
_WORDS = re.compile(WORD)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(1 << 13, _BASE), _powers(1 << 13, _BACK)  # enough for most texts


def _first_powers(n: int, base: int) -> np.ndarray:
    return (_UP if base == _BASE else _DOWN)[:n] if n <= len(_UP) else _powers(n, base)


def run_hashes(text: str, *lengths: int) -> list[np.ndarray]:
    """Per length the hashes of all runs of so many words, in order."""
    made = word_hashes(text.encode("utf-8", "replace"))[0]
    n = len(made)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(made * _first_powers(n, _BASE), out=sums[1:])
    back = _first_powers(n, _BACK)  # so that a run's place does not count
    out = []
    for k in lengths:
        if n < k:
            out.append(np.zeros(0, np.uint64))
            continue
        x = (sums[k:] - sums[:-k]) * back[: n - k + 1]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        out.append(x ^ (x >> np.uint64(29)))
    return out


def least(grams: np.ndarray) -> np.ndarray:
    """The fingerprint of every window of ``WINDOW`` words."""
    span = WINDOW - GRAM + 1
    if len(grams) < span:
        return np.zeros(0, np.uint64)
    out, held = grams, 1  # the least of ``held`` hashes from each place on
    while held < span:
        more = min(held, span - held)
        out, held = np.minimum(out[:-more], out[more:]), held + more
    return out


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 256):
            p = pdf.iloc[at : at + 256]
            prints = [least(run_hashes(t, GRAM)[0]) for t in p["body"]]
            prints = [np.unique(x[np.r_[True, x[1:] != x[:-1]][: len(x)]]).view(np.int64) for x in prints]
            k = [len(x) for x in prints]
            if sum(k):
                yield pd.DataFrame({
                    "print": np.concatenate(prints), "key": np.repeat(p["key"].to_numpy(object), k),
                    "holder": np.repeat(p["holder"].to_numpy(np.int64), k),
                    "doc_id": np.repeat(p["doc_id"].to_numpy(object), k),
                })


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 64):
            p = pdf.iloc[at : at + 64]
            found = []
            for t, prints in zip(p["body"], p["prints"]):
                grams, windows = run_hashes(t, GRAM, WINDOW)
                place = np.flatnonzero(np.isin(least(grams).view(np.int64), np.asarray(prints, np.int64)))
                found.append((windows[place].view(np.int64), place.astype(np.int32)))
            k = [len(x) for _, x in found]
            if sum(k):
                yield pd.DataFrame({
                    "run": np.concatenate([w for w, _ in found]), "place": np.concatenate([x for _, x in found]),
                    "key": np.repeat(p["key"].to_numpy(object), k), "holder": np.repeat(p["holder"].to_numpy(np.int64), k),
                    "doc_id": np.repeat(p["doc_id"].to_numpy(object), k),
                })


def without(text: str, places: np.ndarray) -> str:
    """The text without the windows that begin at these words.

    White space behind a run goes with it; where the run passed a line end, one line end stays.
    """
    if not len(places):
        return text
    spans = [m.span() for m in _WORDS.finditer(text)]
    step = np.zeros(len(spans) + 1, np.int64)
    places = np.unique(places)
    np.add.at(step, places, 1)
    np.add.at(step, places + WINDOW, -1)
    gone = np.cumsum(step[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    out, at = "", 0
    for a, b in zip(edges[::2], edges[1::2]):
        out += text[at : spans[a][0]]
        at = spans[b][0] if b < len(spans) else len(text)
        if b == len(spans):
            out = out.rstrip(" \t\n\x0b\x0c\r")
        elif "\n" in text[spans[a][0] : at] and out and not out.endswith("\n"):
            out = out.rstrip(" \t\x0b\x0c\r") + "\n"
    return out + text[at:]


@F.pandas_udf(StringType())
def _without(texts: pd.Series, places: pd.Series) -> pd.Series:
    return pd.Series([without(t, np.asarray(p, np.int64)) for t, p in zip(texts, places)], dtype=object)


def shared_places(rows: DataFrame) -> DataFrame:
    """(key, places) of the windows to drop; ``rows``: key, doc_id, holder (long), body."""
    # ids pass through pandas as strings: beside nulls they would be floats
    rows = rows.select("key", F.col("doc_id").cast("string").alias("doc_id"), "holder", "body")
    made = materialise(rows.mapInPandas(_fingerprints, "print long, key binary, holder long, doc_id string"), "passage_all")
    shared = materialise(
        made.groupBy("print").agg(F.min("holder").alias("a"), F.max("holder").alias("b")).where("a <> b").select("print"), "passage_prints"
    )
    mask = materialise(key_mask(shared, F.col("print")), "passage_mask", files=1)
    hits = masked(made, F.col("print"), mask).join(shared, "print", "left_semi")
    hits = materialise(hits.groupBy("key").agg(F.min(F.col("doc_id").cast("long")).alias("first_id"), F.collect_set("print").alias("prints")), "passage_hits")
    near = materialise(key_mask(hits, F.col("key")), "passage_mask", files=1)
    texts = masked(rows, F.col("key"), near).join(hits, "key").select("key", F.col("first_id").cast("string").alias("doc_id"), "holder", "body", "prints")
    windows = texts.mapInPandas(_windows, "run long, place int, key binary, holder long, doc_id string")
    windows = materialise(windows.withColumn("doc_id", F.col("doc_id").cast("long")), "passage_windows")
    first = (
        windows.groupBy("run").agg(F.min("holder").alias("a"), F.max("holder").alias("b"), F.min(F.struct("doc_id", "key", "holder")).alias("first"))
        .where("a <> b").select("run", F.col("first.holder").alias("first_holder"))
    )
    return windows.join(first, "run").where("holder <> first_holder").groupBy("key").agg(F.collect_set("place").alias("places"))


def places_to_drop(rows: DataFrame) -> DataFrame:
    """(key, places) of the passages that another holder has first, as a written table.

    ``rows``: key, doc_id, holder (long) and body; rows of one key have one body and one holder.
    """
    with temporary() as hold:
        return hold(materialise(shared_places(rows), "passage_places"))


def less_places(body: str, places: str) -> Column:
    """The text ``body`` without the windows at ``places`` (null: none); rows go to Python."""
    return F.when(F.col(places).isNull(), F.col(body)).otherwise(_without(F.coalesce(body, F.lit("")), F.coalesce(places, F.array().cast("array<int>"))))
