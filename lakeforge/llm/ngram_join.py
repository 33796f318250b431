"""Operator 8: Jaccard join on word n-grams with rare-first prefix filtering.

1. A text's set is its distinct n-grams, hashed.  Equal sets are one class.
2. Set members are ordered by how often they occur in the corpus, rarest first
   (ties by hash).  Two sets that are similar enough share a member of their
   short prefixes.
3. Classes meet in the groups of their prefix members.  An entry stays only if
   sizes (length filter) and what remains behind its place (positional filter)
   allow a partner.  Groups that hang together are one neighbourhood, so a set
   moves once, not once for each prefix member that it shares.
4. A neighbourhood is joined in blocks of bounded size: within a block pair, sets
   that share a prefix member at allowed places are candidates, once per pair; a
   suffix filter (how many members fall into each part of the hash space) rejects
   most, the rest is counted exactly.  Neighbourhoods of too many blocks are
   joined group by group instead.
5. Links give components; copies get the component of their class.

The order only steers the work: counts may be kept in a fixed-size table of
counters (shared by members of one slot) without changing any result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, key_mask, masked, materialise, temporary, text_key, text_of, wrap
from lakeforge.llm.components import components

NGRAM, NUM, DEN = 3, 90, 100  # words; similarity as a fraction
NEAR = (80, 100, 5)  # near duplicates: similarity 0.8 on five words
SLOT_BITS, PART_BITS = 23, 16  # counters; counters in a part that moves as one row
PAIRED = 16  # entries of a group up to which its pairs are tested one by one
BLOCK, BLOCKS = 256, 64  # classes in a block; blocks of a neighbourhood, beyond which its groups are joined one by one
CHUNK, LONG = 1 << 17, 256  # bytes of texts whose words are hashed at once; bytes of a word, beyond which it is hashed by itself
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)

_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k of eight bytes


def _eights(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one integer."""
    word, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
    return (data[word] >> shift) | ((data[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of the words: equal bytes have equal hashes; only ASCII white space splits."""
    raw = np.frombuffer(b"".join((data, b" " * (16 - len(data) % 8))), np.uint8)
    space = (raw == 32) | (raw - np.uint8(9) < 5)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.r_[0, edges]
    start, size = edges[::2], edges[1::2] - edges[::2]
    eights = raw.view("<u8")
    out = size.astype(np.uint64) * _MIX[0]
    at, left, h = start, size, out
    live = None  # words with bytes left; all at first
    for _ in range(LONG // 8):
        h = (h ^ (_eights(eights, at) & _MASKS[np.minimum(left, 8)])) * _MIX[1]
        h ^= h >> np.uint64(32)
        h *= _MIX[2]
        h ^= h >> np.uint64(29)
        if live is None:
            out, live = h, np.arange(len(h))
        else:
            out[live] = h
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        live, at, left, h = live[more], at[more] + 8, left[more] - 8, h[more]
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = xxhash.xxh64_intdigest(data[start[k] : start[k] + size[k]])
    return out, start


def shingle_sets(texts: Iterable[str], n: int = NGRAM) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its word n-grams; fewer words: the whole sequence as one."""
    texts = iter(texts)
    while True:
        parts, size = [], 0
        for t in texts:
            parts.append(t.encode("utf-8", "replace"))
            size += len(parts[-1]) + 1
            if size > CHUNK:
                break
        if not parts:
            return
        a, start = word_hashes(b"\n".join(parts).lower())  # bytes: only A-Z fold
        first = np.searchsorted(start, np.cumsum([0] + [len(p) + 1 for p in parts])).tolist()
        grams = np.zeros(max(0, len(a) - n + 1), np.uint64)
        for k in range(n):
            x = a[k : len(grams) + k]
            grams = (grams ^ (x >> np.uint64(29)) ^ x) * _MIX[k % 4] + np.uint64(k + 1)
        grams ^= grams >> np.uint64(32)
        for p, lo, hi in zip(parts, first, first[1:]):
            if hi - lo >= n:
                s = np.sort(grams[lo : hi - n + 1])
                yield s[np.r_[True, s[1:] != s[:-1]]]
            elif hi > lo:
                yield np.array([xxhash.xxh64_intdigest(b" ".join(p.lower().split()), seed=hi - lo)], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def shingles(text: str, n: int = NGRAM) -> np.ndarray:
    return next(shingle_sets([text], n))


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(s.tobytes())


def _slots(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _read(ngram: int) -> Callable:
    """Per text its class and size; at the end of the partition its counters, in parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(1 << SLOT_BITS, np.uint32)
        for pdf in batches:
            cls, n = [], []
            for s in shingle_sets(pdf["body"], ngram):  # one set at a time, never those of a whole batch
                counters[_slots(s)] += np.uint32(1)
                cls.append(set_key(s))
                n.append(len(s))
            yield pd.DataFrame({"rid": pdf["rid"], "doc_id": pdf["doc_id"], "cls": cls, "n": n, "part": None, "counts": None})
        for part, c in enumerate(counters.reshape(-1, 1 << PART_BITS)):
            if c.any():
                yield pd.DataFrame({"rid": [None], "doc_id": [None], "cls": [None], "n": [None], "part": [part], "counts": [zlib.compress(c.tobytes(), 1)]})

    return run


def _sum_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for pdf in batches:
        for part, data in zip(pdf["part"], pdf["counts"]):
            c = np.frombuffer(zlib.decompress(data), np.uint32).astype(np.uint64)
            sums[part] = sums[part] + c if part in sums else c
    if sums:
        # the order needs no more than the leading 16 bits of a logarithm
        yield pd.DataFrame({"part": list(sums), "rank": [(np.log2(c + 1.0) * 1024).astype(np.uint16).tobytes() for c in sums.values()]})


def prefix_length(n: int, num: int = NUM, den: int = DEN) -> int:
    return n - -(-n * num // den) + 1


def _rarest(s: np.ndarray, ranks: np.ndarray, p: int) -> np.ndarray:
    """The p first members by rank, ties by hash."""
    r = ranks[_slots(s)]
    low = np.arange(len(s))
    if p < len(s):
        edge = np.partition(r, p - 1)[p - 1]
        low = np.flatnonzero(r < edge)
        low = np.concatenate([low, np.flatnonzero(r == edge)[: p - len(low)]])
    return s[low[np.lexsort((s[low], r[low]))]]


def _prefixes(ranks, ngram: int, num: int, den: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()  # classes of this task
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                made = []
                for s in shingle_sets(pdf["body"].iloc[at : at + 512], ngram):
                    c = set_key(s)
                    if len(s) and c not in seen:
                        seen.add(c)
                        made.append((c, len(s), _rarest(s, ranks.value, prefix_length(len(s), num, den))))
                if made:
                    k = [len(m) for _, _, m in made]
                    yield pd.DataFrame({
                        "member": np.concatenate([m for _, _, m in made]).view(np.int64),
                        "cls": np.repeat(np.array([c for c, _, _ in made], object), k),
                        "n": np.repeat(np.array([n for _, n, _ in made], np.int32), k),
                        "place": np.concatenate([np.arange(x, dtype=np.int32) for x in k]),
                    })

    return run


def _sets(ranks, ngram: int) -> Callable:
    """Whole sets, rarest member first, of each class that a task meets once (repeated rows meet in one task)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for pdf in batches:
            pdf = pdf[~pdf["cls"].isin(seen)].drop_duplicates("cls")
            seen.update(pdf["cls"])
            for at in range(0, len(pdf), 128):
                p = pdf.iloc[at : at + 128]
                sets = shingle_sets(p["body"], ngram)
                yield pd.DataFrame({"cls": p["cls"], "members": [_rarest(s, ranks.value, len(s)).tobytes() for s in sets], "spots": p["spots"]})

    return run


def linked(a: list[np.ndarray], b: list[np.ndarray] | None, num: int, den: int, joined: Callable[[int, int], bool] = lambda i, j: False) -> Iterator[tuple[int, int]]:
    """Index pairs of similar sets (each rarest first), of ``a`` with ``b`` or
    (b None) within ``a``, but for pairs that are joined already."""
    both = a + (b or [])
    size = np.array([len(s) for s in both])
    values = [np.sort(s) for s in both]
    # suffix filter: members by part of the hash space; the differences add up to no more than the sets' difference
    parts = np.stack([np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=64) for s in both]).astype(np.int32)
    # prefix members, sorted so that those of one value are a run
    top = [s[: prefix_length(len(s), num, den)] for s in both]
    member = np.concatenate(top)
    owner = np.repeat(np.arange(len(both)), [len(t) for t in top])
    place = np.concatenate([np.arange(len(t)) for t in top])
    order = np.lexsort((owner, member))
    member, owner, place = member[order], owner[order], place[order]
    start = np.flatnonzero(np.r_[True, member[1:] != member[:-1]])
    end = np.r_[start[1:], len(member)]
    seen: set[int] = set()  # pairs are looked at once
    for s, e in zip(start[end - start > 1], end[end - start > 1]):
        own, at = owner[s:e], place[s:e]
        n = size[own]
        for k in range(len(own) - 1):
            i = int(own[k])
            if b is not None and i >= len(a):
                break
            js, m = own[k + 1 :], n[k + 1 :]
            need = -(-num * (n[k] + m) // (num + den))  # common members that a link takes
            ok = (np.minimum(n[k], m) * den >= np.maximum(n[k], m) * num) & (np.minimum(n[k] - at[k], m - at[k + 1 :]) >= need)
            if b is not None:
                ok &= js >= len(a)
            if not ok.any():
                continue
            js, need = js[ok], need[ok]
            js = js[np.abs(parts[js] - parts[i]).sum(1) <= n[k] + size[js] - 2 * need]
            for j in js.tolist():
                if i * len(both) + j in seen or joined(i, j):
                    continue
                seen.add(i * len(both) + j)
                common = len(np.intersect1d(values[i], values[j], assume_unique=True))
                if den * common >= num * (size[i] + size[j] - common):
                    yield i, j


def _linked(pdf: pd.DataFrame, num: int, den: int, every: bool) -> list[tuple[bytes, bytes]]:
    """Links of one block pair: all (``every``) or those that join what is not yet joined there."""
    pdf = pdf.drop_duplicates("cls").sort_values("cls")
    left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    apart = pdf["lo"].iloc[0] != pdf["hi"].iloc[0]
    if not len(left) or apart and not len(right):
        return []
    ids = [*left["cls"], *(right["cls"] if apart else [])]
    a = [np.frombuffer(m, np.uint64) for m in left["members"]]
    b = [np.frombuffer(m, np.uint64) for m in right["members"]] if apart else None
    if every:
        return [tuple(sorted((ids[i], ids[j]))) for i, j in linked(a, b, num, den)]
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in linked(a, b, num, den, lambda i, j: find(i) == find(j)):
        root[find(i)] = find(j)
        out.append((ids[i], ids[j]))
    return out


def _compare(num: int, den: int, every: bool) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_linked(pdf, num, den, every), columns=["a", "b"])

    return run


def links(docs: DataFrame, num: int = NUM, den: int = DEN, ngram: int = NGRAM, block: int = BLOCK, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members: rid, doc_id, cls, n; links: a, b between classes).

    ``docs`` has rid (any row identity), doc_id and body.  The links span every
    component of similar classes, which is all that components take; with
    ``every`` each similar pair of classes is listed, once, as a < b.
    """
    with temporary() as keep:
        members, found = _links(docs, num, den, ngram, block, every)
        return keep(members).select("rid", "doc_id", "cls", "n"), keep(found)


def _links(docs: DataFrame, num: int, den: int, ngram: int, block: int, every: bool) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    seen = materialise(docs.mapInPandas(_read(ngram), "rid binary, doc_id long, cls binary, n int, part int, counts binary"), "ngram_read")
    members = materialise(seen.where("cls is not null").select("rid", "doc_id", "cls", "n"), "ngram_members")
    summed = seen.where("part is not null").select("part", "counts").repartition("part").mapInPandas(_sum_parts, "part int, rank binary")
    table = np.zeros(1 << SLOT_BITS, np.uint16)  # 16 MB whatever the input
    for r in summed.collect():
        table[r["part"] << PART_BITS : (r["part"] + 1) << PART_BITS] = np.frombuffer(r["rank"], np.uint16)
    ranks = spark.sparkContext.broadcast(table)
    del table

    # copies: a task lists a class once, and the rest goes where entries of a member meet
    entries = docs.select("body").mapInPandas(_prefixes(ranks, ngram, num, den), "member long, cls binary, n int, place int").repartition("member").dropDuplicates(["member", "cls"])
    # common members that a pair needs: ceil(num * (n + m) / (num + den)); the smallest partner that the lengths allow
    need = lambda total: F.expr(f"({total} * {num} + {num + den - 1}) div {num + den}")
    pair = (F.col("least") * den >= F.col("most") * num) & (F.col("left") >= need("total"))
    alive = (F.expr("n - place") >= need(f"(n + greatest(least, (n * {num} + {den - 1}) div {den}))")) & ((F.col("size") > 2) | pair)

    def living(rows: DataFrame, *key: str) -> DataFrame:
        groups = rows.groupBy(*key).agg(
            F.count("*").alias("size"), F.min("n").alias("least"), F.max("n").alias("most"), F.sum("n").alias("total"), F.min(F.col("n") - F.col("place")).alias("left")
        ).where("size > 1")
        return rows.join(groups, list(key)).where(alive)

    with temporary() as keep:
        met = materialise(living(entries, "member").select("member", "cls", "n", "place"), "ngram_met")
        # sizes that may link are in the same or in neighbouring steps of the similarity: every entry is in two steps
        step = F.floor(F.ln("n") / F.lit(math.log(den / num) * 1.000001)).cast("int")
        kept = living(met.withColumn("step", F.explode(F.array(step, step + 1))), "member", "step")
        kept = keep(materialise(kept.select(F.xxhash64("member", "step").alias("member"), "cls", "n", "place", "size"), "ngram_entries"))
    # neighbourhoods: possible pairs of small groups; of others each class beside the first one
    few = kept.where(F.col("size") <= PAIRED).select("member", "cls", "n", "place")
    other = few.select("member", F.col("cls").alias("b"), F.col("n").alias("m"), F.col("place").alias("at"))
    possible = (
        (F.col("cls") < F.col("b")) & (F.least("n", "m") * den >= F.greatest("n", "m") * num) & (F.least(F.expr("n - place"), F.expr("m - at")) >= need("(n + m)"))
    )
    edges = few.join(other, "member").where(possible).select(F.col("cls").alias("a"), "b")
    many = kept.where(F.col("size") > PAIRED).select("member", "cls")
    hub = many.groupBy("member").agg(F.min("cls").alias("hub"))
    edges = edges.unionByName(many.join(hub, "member").where("cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b")))
    near = components(edges.distinct())
    sizes = near.groupBy("root").agg(F.count("*").alias("size"))
    near = materialise(near.join(sizes, "root").select(F.col("node").alias("cls"), F.col("root").alias("at"), F.ceil(F.col("size") / block).cast("int").alias("blocks")), "ngram_near")
    whole = near.where(F.col("blocks") <= BLOCKS).select("at", "cls", "blocks")
    large = kept.select("member", "cls").join(near.where(F.col("blocks") > BLOCKS).select("cls"), "cls")
    groups = large.groupBy("member").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("cls")).alias("h1"), F.bit_xor(F.xxhash64("cls", F.lit(5))).alias("h2")).where("size > 1")
    chosen = groups.groupBy("size", "h1", "h2").agg(F.min("member").alias("member"))  # of groups with the same classes, one
    single = large.join(chosen, "member").select(F.unhex(F.lpad(F.hex("member"), 16, "0")).alias("at"), "cls", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    work = materialise(whole.unionByName(single), "ngram_work")

    mine = F.pmod(F.xxhash64("cls", "at"), F.col("blocks")).cast("int")
    paired = work.withColumn("mine", mine).select("at", "cls", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spots = paired.groupBy("cls").agg(
        F.collect_list(F.struct("at", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), (F.col("mine") > F.col("other")).cast("int").alias("side"))).alias("spots")
    )
    # one text per class that has work, that of the smallest row identity, meets the blocks of its class; then its set is made and dealt out
    there = members.join(spots, "cls").groupBy("cls").agg(F.min("rid").alias("rid"), F.first("spots").alias("spots"))
    there = materialise(there.select("rid", "cls", "spots"), "ngram_active")
    mask = materialise(key_mask(there, F.col("rid")), "ngram_mask", files=1)
    texts = masked(docs.select("rid", "body"), F.col("rid"), mask).join(there, "rid")
    spot = "array<struct<at:binary,lo:int,hi:int,side:int>>"
    sets = texts.select("cls", "body", "spots").mapInPandas(_sets(ranks, ngram), f"cls binary, members binary, spots {spot}")
    found = sets.select("cls", "members", F.inline("spots")).groupBy("at", "lo", "hi").applyInPandas(_compare(num, den, every), "a binary, b binary")
    if every:  # groups joined one by one may meet a pair again
        found = found.distinct()
    found = materialise(found, "ngram_links")
    ranks.destroy()  # what is returned is read from files
    return members, found


def by_row(docs: DataFrame, num: int, den: int, ngram: int, block: int) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, times) per distinct row of ``docs``
    (rid, doc_id, body) that has a set; ``times``: how often the row repeats."""
    members, pairs = links(docs, num, den, ngram, block)
    nodes = components(pairs)  # node, root: only classes with links
    rows = members.where("n > 0").groupBy("rid", "doc_id", "cls", "n").agg(F.count("*").alias("times"))
    named = rows.join(nodes, rows["cls"] == nodes["node"], "left").withColumn("root", F.coalesce("root", "cls"))
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return materialise(
        named.select("rid", "doc_id", "n", "root", "times").join(names, "root")
        .select("rid", "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "root", "times"), "ngram_rows"
    )


def _identified(docs: DataFrame, keep: Sequence[str] | None) -> DataFrame:
    rows = wrap(docs, "doc_id", "text", keep=keep).select(ROW, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    return rows.withColumn("rid", F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "body").cast("binary"))))


def groups(docs: DataFrame, num: int = NUM, den: int = DEN, ngram: int = NGRAM, block: int = BLOCK) -> DataFrame:
    """(key, group) of the texts, by content key, that links join with a different text."""
    rows = _identified(docs, [])
    members, pairs = links(rows.select("rid", "doc_id", "body"), num, den, ngram, block)
    named = members.where("n > 0").select("rid", "cls").distinct().join(components(pairs), F.col("cls") == F.col("node"), "left")
    keys = rows.select("rid", text_key(F.col("body")).alias("key")).distinct()
    with temporary() as keep:
        placed = materialise(named.join(keys, "rid").select("key", F.coalesce("root", "cls").alias("group")).distinct(), "ngram_groups")
        many = placed.groupBy("group").agg(F.count("*").alias("size")).where("size > 1").select("group")
        return keep(materialise(placed.join(many, "group", "left_semi").select("key", "group"), "ngram_groups"))


def join(
    docs: DataFrame, num: int = NUM, den: int = DEN, ngram: int = NGRAM, block: int = BLOCK, keep: Sequence[str] | None = None
) -> DataFrame:
    """The caller's columns (one struct; ``keep``: only these), n_shingles and
    component_id: the smallest doc_id that links reach from the row, its own included.

    Null and empty texts have an empty set and link with nothing.  Rows with
    equal sets are linked; repeated rows share a component.  Null ids are
    passed over as component names (a component of null ids alone has none).
    An empty table gives an empty result.
    """
    rows = _identified(docs, keep)
    made = by_row(rows.select("rid", "doc_id", "body"), num, den, ngram, block).select("rid", "n_shingles", "component_id")
    return (
        rows.select(ROW, "doc_id", "rid").join(made, "rid", "left")
        .select(ROW, F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"), F.when(F.col("n_shingles").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )


def link_counts(
    docs: DataFrame, num: int = NUM, den: int = DEN, ngram: int = NGRAM, block: int = BLOCK, keep: Sequence[str] | None = None
) -> DataFrame:
    """The caller's columns (one struct; ``keep``: only these), n_shingles and
    n_links: how many other rows are linked with the row itself, copies included.

    Links between classes are summed by class, so copies are counted, not paired.
    """
    rows = _identified(docs, keep)
    members, pairs = links(rows.select("rid", "doc_id", "body"), num, den, ngram, block, every=True)
    held = materialise(members.where("n > 0").groupBy("cls").agg(F.count("*").alias("held")), "ngram_held")
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(held, F.col("b") == F.col("cls")).groupBy("a").agg(F.sum("held").alias("others"))
    counts = held.join(others, F.col("cls") == F.col("a"), "left").select("cls", (F.col("held") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    made = members.where("n > 0").select("rid", "cls", "n").distinct().join(counts, "cls").select("rid", "n", "n_links")
    return rows.select(ROW, "rid").join(made, "rid", "left").select(
        ROW, F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def distinct(docs: DataFrame, num: int = NUM, den: int = DEN, ngram: int = NGRAM, block: int = BLOCK) -> DataFrame:
    """One row of each component, with the caller's columns: that of the smallest
    doc_id, the first by content if ids repeat.  Rows without a set all stay.

    Texts of rows that surely stay do not move: only rows that may have to go
    (a filter of fixed size says which) meet the list of those that go.
    """
    rows = _identified(docs, None)
    with temporary() as keep:
        made = by_row(rows.select("rid", "doc_id", "body"), num, den, ngram, block)
        first = made.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid")).alias("f"))
        fate = made.join(first, "root").select("rid", (F.col("rid") == F.col("f.rid")).alias("stays"), "times")
        odd = keep(materialise(fate.where("not stays or times > 1").select("rid", "stays"), "ngram_odd"))
    mask = materialise(key_mask(odd, F.col("rid")), "ngram_mask", files=1)
    sure = masked(rows.select(ROW, "rid"), F.col("rid"), mask, inside=False)
    unsure = masked(rows.select(ROW, "rid"), F.col("rid"), mask).join(odd, "rid", "left")
    other = unsure.where("stays is null").select(ROW)
    repeated = unsure.where("stays").groupBy("rid").agg(F.first(ROW).alias(ROW)).select(ROW)
    return sure.select(ROW).unionByName(other).unionByName(repeated).select(f"{ROW}.*")
