"""Operator 1: toxicity by a factorization machine over hashed terms.

A term is a lower-cased word or one of its leading pieces, hashed.  The model
has a weight per term and a short vector per term; the product of two terms'
vectors weighs their meeting in one text (an insult beside a group's name),
which a sum of weights cannot express.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, text_of, wrap

#: Labelled documents to learn from, about (the bound on the sample); hash buckets;
#: terms kept by the screening; length of a term's vector.
SAMPLE, BUCKETS, TERMS, FACTORS = 12_000, 1 << 18, 1024, 6
LOCAL_BYTES = 24 << 20  # of words whose terms a worker remembers, while it works on one partition

_WORD = re.compile(r"[^\W\d_]+")


def terms(word: str) -> list[int]:
    """Hash buckets of a word and of its leading 3 to 7 letters."""
    out = [zlib.crc32(b"w" + word.encode()) % BUCKETS]
    out += [zlib.crc32(b"p" + word[:k].encode()) % BUCKETS for k in range(3, min(8, len(word) + 1))]
    return out


def counts(text: str) -> tuple[Counter, int]:
    words = _WORD.findall(text.lower())
    return Counter(words), len(words)


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash buckets, values) of a whole text: occurrences by the root of the length."""
    seen, n = counts(text)
    out: dict[int, float] = {}
    for w, k in seen.items():
        for b in terms(w):
            out[b] = out.get(b, 0.0) + k
    return np.fromiter(out.keys(), np.int32, len(out)), np.fromiter(out.values(), np.float32, len(out)) / max(n, 1) ** 0.5


def screen(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Buckets that separate the labels best: difference of mean values by its deviation."""
    stats = np.zeros((2, 3, BUCKETS))
    for (b, v), y in zip(vectors, labels):
        v = np.minimum(v, 1.0)
        for k, x in enumerate((np.ones_like(v), v, v * v)):
            stats[y, k][b] += x
    n = np.maximum(np.bincount(labels, minlength=2), 1)
    mean = stats[:, 1] / n[:, None]
    var = np.maximum(stats[:, 2] / n[:, None] - mean**2, 0)
    z = np.abs(mean[1] - mean[0]) / np.sqrt(var[1] / n[1] + var[0] / n[0] + 1e-6)
    z[stats[:, 0].sum(0) < 5] = 0
    top = np.argsort(-z, kind="stable")[:TERMS]
    return np.sort(top[z[top] > 0])


class Machine:
    """Bias, weight and vector per kept bucket."""

    def __init__(self, buckets: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.buckets, self.bias, self.weights, self.vectors = buckets, bias, weights, vectors
        self.place = {int(b): i for i, b in enumerate(buckets)}
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, list[int]] = {}
        self.room = LOCAL_BYTES

    def score(self, text: str) -> float:
        seen, n = counts(text)
        x: dict[int, float] = {}
        for w, k in seen.items():
            at = self.memo.get(w)
            if at is None:
                at = [self.place[b] for b in terms(w) if b in self.place]
                self.room -= 2 * len(w) + 8 * len(at) + 240  # the objects and their place in the table
                if self.room < 0:
                    self.forget()
                self.memo[w] = at
            for i in at:
                x[i] = x.get(i, 0.0) + k
        logit = self.bias
        if x:
            i = np.fromiter(x.keys(), np.int64, len(x))
            v = np.minimum(np.fromiter(x.values(), np.float64, len(x)) / n**0.5, 1.0)
            vx = self.vectors[i] * v[:, None]
            logit += float(v @ self.weights[i] + 0.5 * ((vx.sum(0) ** 2).sum() - (vx**2).sum()))
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))))


def fit(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 250, rate: float = 0.05, decay: float = 1e-3) -> Machine:
    """Screening, then logistic loss by Adam over all rows; the start is fixed, so refits agree."""
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-4, 1 - 1e-4))
        return Machine(np.zeros(0, np.int64), float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    kept = screen(vectors, labels)
    place = np.full(BUCKETS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    x = np.zeros((len(labels), len(kept)), np.float32)
    for r, (b, v) in enumerate(vectors):
        at = place[b]
        x[r, at[at >= 0]] = np.minimum(v[at >= 0], 1.0)
    y = labels.astype(np.float32)
    share = y.mean()
    pull = np.where(y == 1, min(5.0, np.sqrt((1 - share) / share)), 1.0).astype(np.float32)  # the rarer label counts more
    x2 = x * x
    rng = np.random.default_rng(7)
    par = [np.array([np.log(share / (1 - share))], np.float32), np.zeros(len(kept), np.float32), (0.05 * rng.standard_normal((len(kept), FACTORS))).astype(np.float32)]
    mom = [np.zeros_like(p) for p in par]
    sq = [np.zeros_like(p) for p in par]
    for t in range(1, steps + 1):
        xv = x @ par[2]
        logit = par[0] + x @ par[1] + 0.5 * ((xv**2).sum(1) - (x2 @ (par[2] ** 2)).sum(1))
        g = pull * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        gx2 = x2.T @ g
        grad = [np.array([g.sum()], np.float32), x.T @ g + decay * par[1] / 10, x.T @ (g[:, None] * xv) - gx2[:, None] * par[2] + decay * par[2] / 10]
        for p, d, m, s in zip(par, grad, mom, sq):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return Machine(kept, float(par[0][0]), par[1].astype(np.float64), par[2].astype(np.float64))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from (a null id is not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        made = [vector(t) for t in pdf["body"]]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "b": [b.tobytes() for b, _ in made], "v": [v.tobytes() for _, v in made]})


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [r for pdf in batches for r in zip(pdf["doc_id"], pdf["b"], pdf["v"], pdf["label"])]
    rows.sort()  # the order of arrival must not change the model
    m = fit([(np.frombuffer(b, np.int32), np.frombuffer(v, np.float32)) for _, b, v, _ in rows], np.array([r[3] for r in rows], np.int64))
    yield pd.DataFrame({"buckets": [np.asarray(m.buckets, np.int64).tobytes()], "bias": [m.bias], "weights": [m.weights.tobytes()], "vectors": [m.vectors.tobytes()]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on about ``sample`` labelled texts (fewer if there are fewer), chosen by a hash of the id.

    The sample is the only bounded part: it goes to one task, and the model
    (TERMS buckets) comes back.  Of rows that repeat an id one text counts, the
    first by content.  The sampled labels, whose number the bound limits, are broadcast.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").cast("long").alias("label"))
    n = known.count()
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select("doc_id", text_of().alias("body")).join(F.broadcast(some), "doc_id").groupBy("doc_id", "label").agg(F.min("body").alias("body"))
    made = texts.mapInPandas(_vectors, "doc_id long, label long, b binary, v binary").repartition(1)
    row = made.mapInPandas(_train, "buckets binary, bias double, weights binary, vectors binary").first()
    return Machine(np.frombuffer(row["buckets"], np.int64), row["bias"], np.frombuffer(row["weights"]), np.frombuffer(row["vectors"]).reshape(-1, FACTORS))


def score(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """The caller's columns (one struct), score and predicted.

    Whole texts are scored row by row: nothing is shuffled.  Null and empty
    texts get the model's bias; repeated rows get equal scores; an empty table
    gives an empty result.  Without labels of both kinds the score is constant.
    """
    machine.forget()

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                yield pd.Series([machine.score(t) for t in texts], dtype="float64")
        finally:
            machine.forget()  # workers are reused

    rows = wrap(docs, "text").select(ROW, scored(text_of()).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
