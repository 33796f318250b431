"""Operator 2: BPE encoding and decoding with tree concatenation.

A long text is cut into halves, and these again, whether or not a cut falls
inside a word; the pieces are encoded in parallel.  At each join of the tree a
window around the cut is encoded anew and grows until its first tokens agree
with the left side and later tokens agree with the right side; only then are
the three parts put together.  Two BPE encodings that share a token at the same
place continue alike from there, so the result is the encoding of the whole.

Pieces and short texts are encoded by the tokenizers library: word by word from
a bounded memory, if the tokenizer's tokens never span ASCII white space, else whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, text_key, text_of, wrap

#: Texts of more code points are cut; window around a join at first, code points each side;
#: bytes of words and their tokens that a worker remembers, while it works on one partition, and if asked to keep them longer.
LEAF, WINDOW, REMEMBERED, HELD = 32_768, 64, 48 << 20, 128 << 20
RESULTS = 256  # texts whose results a worker holds at once

_MARK = re.compile(rb"([a-z])([.,|])(?=[ \t-\r]|$)")
_START, _MARKED = re.compile(r"(?<![^ \t-\r])[^ \t-\r]"), re.compile(r"([A-Za-z])[.,|](?=[ \t-\r]|$)")

Encoding = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, starts, ends in the whole text


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def encode_spans(tok, text: str, at: int = 0) -> Encoding:
    e = tok.encode(text, add_special_tokens=False)
    spans = np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e)).reshape(-1, 2) + at
    return np.array(e.ids, np.uint32), spans[:, 0], spans[:, 1]


def _apart(text: str, at: int) -> bool:
    """Normalisation never joins or reorders characters across this place."""
    if at <= 0 or at >= len(text):
        return True
    if unicodedata.combining(text[at]):
        return False
    both = text[at - 1 : at + 1]
    return both.isascii() or unicodedata.normalize("NFC", both) == unicodedata.normalize("NFC", both[0]) + unicodedata.normalize("NFC", both[1])


def _clean(text: str, enc: Encoding, i: int) -> bool:
    """Token i starts a character that no earlier token holds a part of."""
    return (i == 0 or enc[1][i] >= enc[2][i - 1]) and _apart(text, int(enc[1][i]))


def _same(a: Encoding, i: int, b: Encoding, j: int) -> bool:
    return a[0][i] == b[0][j] and a[1][i] == b[1][j] and a[2][i] == b[2][j]


def _agrees(text: str, a: Encoding, i: int, b: Encoding, j: int, upto: int) -> bool:
    """Two tokens in a row agree, both sides start cleanly, and both end before ``upto``."""
    return (
        i + 1 < len(a[0]) and j + 1 < len(b[0]) and a[2][i + 1] < upto and _same(a, i, b, j)
        and _same(a, i + 1, b, j + 1) and _clean(text, a, i) and _clean(text, b, j)
    )


def join(tok, text: str, left: Encoding, right: Encoding, lo: int, cut: int, hi: int, window: int = WINDOW) -> Encoding:
    """Encoding of text[lo:hi] from those of text[lo:cut] and text[cut:hi].

    ``guard`` places beside a cut, as many as the longest added token has, never
    count as agreement: a piece may hold a part of such a token there.
    """
    guard = max((len(t.content) for t in tok.get_added_tokens_decoder().values()), default=0)
    window = max(window, 2 * guard)
    while True:
        i = int(np.searchsorted(left[1], cut - window, side="right")) - 1
        while i > 0 and not _clean(text, left, i):
            i -= 1
        s = lo if i <= 0 else int(left[1][i])
        e = min(hi, cut + window)
        while e < hi and not _apart(text, e):
            e += 1
        mid = encode_spans(tok, text[s:e], s)
        left_ok = s == lo or _agrees(text, mid, 0, left, i, cut - guard)
        keep_left = 0 if s == lo else i
        if left_ok and e == hi:
            return tuple(np.concatenate([a[:keep_left], b]) for a, b in zip(left, mid))
        if left_ok:
            j = int(np.searchsorted(right[1], cut + guard))
            for k in range(int(np.searchsorted(mid[1], cut + guard)), len(mid[0])):
                while j < len(right[0]) and right[1][j] < mid[1][k]:
                    j += 1
                if _agrees(text, mid, k, right, j, e - guard):
                    return tuple(np.concatenate([a[:keep_left], b[:k], c[j:]]) for a, b, c in zip(left, mid, right))
        if s == lo and e == hi:
            raise AssertionError("the whole span was encoded")
        window *= 2


def tree(tok, text: str, parts: list[Encoding], cuts: list[int], window: int = WINDOW) -> Encoding:
    """Join neighbours level by level; ``cuts`` has one place more than there are parts."""
    while len(parts) > 1:
        paired = [
            join(tok, text, parts[k], parts[k + 1], cuts[k], cuts[k + 1], cuts[k + 2], window) if k + 1 < len(parts) else parts[k]
            for k in range(0, len(parts), 2)
        ]
        cuts = cuts[::2] if len(parts) % 2 == 0 else [*cuts[:-1:2], cuts[-1]]
        parts = paired
    return parts[0]


def halves(length: int, leaf: int = LEAF) -> list[int]:
    """Places at which a text of ``length`` is cut: halves of halves until none is longer than ``leaf``."""
    n = 1
    while length > leaf * n:
        n *= 2
    return [length * k // n for k in range(n + 1)]


class Memory:
    """Words and their tokens, up to a number of bytes.

    It has two halves.  When the newer one is full, the older one goes and the
    newer one becomes it; a word that is met again moves to the newer one, so
    words in use stay and words met once go.
    """

    def __init__(self, most: int = REMEMBERED):
        self.most = most
        self.forget()

    def __len__(self) -> int:
        return len(self.new) + len(self.old)

    def forget(self) -> None:
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.room = self.most // 2

    def _put(self, word: bytes, tokens: bytes) -> None:
        self.new[word] = tokens
        self.room -= len(word) + len(tokens) + 165  # the objects and their place in the table

    def meet(self, words: set[bytes], learn: Callable[[list[bytes]], Iterator[bytes]]) -> dict[bytes, bytes]:
        """A table that has these words; those not known are learned."""
        if self.room < 0:
            self.old, self.new, self.room = self.new, {}, self.most // 2
        new, old, unknown = self.new, self.old, []
        for w in words:
            if w not in new:
                tokens = old.pop(w, None)
                if tokens is None:
                    unknown.append(w)
                else:
                    self._put(w, tokens)
        if unknown:
            for w, tokens in zip(unknown, learn(unknown)):
                self._put(w, tokens)
        return new


class WordEncoder:
    """Encodes texts through a memory of white-space delimited words."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.memo, self.places = Memory(), Memory()  # tokens as ids; as id, start and end in the word (32 bits each)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        probe = lambda x: self.tok.encode(x, add_special_tokens=False).ids
        # whether a text's tokens are those of its words: not so where a token takes in the space before a word
        self.by_word = all(probe(x) == [i for w in x.split() for i in probe(w)] for x in ("a b", "the cat, sat.\n\n on  a\tmat", " x1 2 Y "))
        self.folds = probe("Ab, c1. D| e") == probe("ab , c1 . d | e")
        # without a decoder, the library puts the tokens together with spaces
        self.names = None if self.tok.decoder is not None else [self.tok.id_to_token(i) for i in range(size)]

    def _folded(self, data: bytes) -> bool:
        return self.folds and b"<|" not in data

    def _words(self, text: str) -> list[bytes]:
        """White-space delimited words; where the tokenizer splits and lower-cases
        them itself, a mark at a word's end stands alone and case is folded, so
        that fewer different words are met."""
        data = text.encode("utf-8", "replace")
        if self._folded(data):
            data = _MARK.sub(rb"\1 \2", data.lower())
        return data.split()

    def _learn(self, words: list[bytes], placed: bool = False) -> Iterator[bytes]:
        """Encode words in one call, one to a line, and split the tokens at the lines."""
        lines = [w.decode("utf-8", "replace") for w in words]
        ids, starts, ends = encode_spans(self.tok, "\n".join(lines))
        after = np.cumsum([len(x) + 1 for x in lines])
        upto = np.searchsorted(starts, after)
        if placed:
            base = np.repeat(np.r_[0, after[:-1]], np.diff(upto, prepend=0))
            ids = np.stack([ids, starts - base, ends - base], axis=1)
        data, a, size = ids.astype("<u4").tobytes(), 0, 12 if placed else 4
        for b in (size * upto).tolist():
            yield data[a:b]
            a = b

    def hold(self, most: int) -> None:
        """Remember up to so many bytes from here on."""
        self.memo.most = most

    def forget(self) -> None:
        self.memo.forget()
        self.places.forget()

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        if not self.by_word:
            for text in texts:
                ids = self.tok.encode(text, add_special_tokens=False).ids
                yield np.array(ids, "<u4").tobytes(), self.tok.decode(ids, skip_special_tokens=False)
            return
        for at in range(0, len(texts), 64):
            split = [self._words(t) for t in texts[at : at + 64]]
            memo = self.memo.meet(set().union(*split), self._learn)
            for words in split:
                ids = np.frombuffer(b"".join(map(memo.__getitem__, words)), "<u4")
                if self.names:
                    yield ids.tobytes(), " ".join(map(self.names.__getitem__, ids.tolist()))
                else:
                    yield ids.tobytes(), self.tok.decode(ids.tolist(), skip_special_tokens=False)

    def spans(self, text: str) -> Encoding:
        """The same as ``encode_spans``, word by word."""
        if not self.by_word:
            return encode_spans(self.tok, text)
        begin = [m.start() for m in _START.finditer(text)]
        if self._folded(text.encode("utf-8", "replace")):
            begin = sorted(begin + [m.end(1) for m in _MARKED.finditer(text)])
        words = self._words(text)
        memo = self.places.meet(set(words), lambda new: self._learn(new, placed=True))
        got = [memo[w] for w in words]
        made = np.frombuffer(b"".join(got), "<u4").reshape(-1, 3)
        place = np.repeat(np.array(begin, np.int64), np.array([len(g) // 12 for g in got], np.int64))
        return made[:, 0].copy(), made[:, 1] + place, made[:, 2] + place


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _leaf_task(path: str) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            for pdf in batches:
                for key, k, piece in zip(pdf["key"], pdf["k"], pdf["piece"]):
                    ids, a, b = _encoder(path).spans(piece)
                    yield pd.DataFrame({"key": [key], "k": [k], "piece": [piece], "ids": [ids.tobytes()], "a": [a.astype(np.int32).tobytes()], "b": [b.astype(np.int32).tobytes()]})
        finally:
            _encoder(path).places.forget()  # workers are reused

    return run


def _tree_task(path: str) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tok = _encoder(path).tok
        pdf = pdf.sort_values("k")
        cuts = [0, *np.cumsum([len(p) for p in pdf["piece"]]).tolist()]
        parts = [
            (np.frombuffer(i, np.uint32), np.frombuffer(a, np.int32).astype(np.int64) + at, np.frombuffer(b, np.int32).astype(np.int64) + at)
            for i, a, b, at in zip(pdf["ids"], pdf["a"], pdf["b"], cuts)
        ]
        ids = tree(tok, "".join(pdf["piece"]), parts, cuts)[0]
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "ids": [ids.astype("<u4").tobytes()], "decoded": [tok.decode(ids.tolist(), skip_special_tokens=False)]})

    return run


def encode(docs: DataFrame, path: str, leaf: int = LEAF, remember: bool = False) -> DataFrame:
    """The caller's columns (one struct), ``ids`` (binary: little-endian unsigned
    32-bit integers) and ``decoded``.

    Texts up to ``leaf`` code points are encoded where they are, without a
    shuffle.  Longer ones are worked on once per distinct text: their pieces
    are dealt out, and one task joins the pieces of one text (never more than
    the text itself).  Null text counts as empty: no ids, empty decoded text.
    Repeated rows get equal results; an empty table gives an empty result.
    ``remember``: a worker's next partitions find the words that it has met (up to ``HELD``
    bytes, which it then holds for as long as it lives; for jobs that leave workers no other work).
    """

    @F.pandas_udf("struct<ids:binary,decoded:string>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        _encoder(path).hold(HELD if remember else REMEMBERED)
        try:
            for texts in batches:  # results leave in small frames: a worker never holds those of a whole batch
                for at in range(0, len(texts), RESULTS):
                    made = _encoder(path).encode(list(texts.iloc[at : at + RESULTS]))
                    yield pd.DataFrame(list(made), columns=["ids", "decoded"])
        finally:
            if not remember:
                _encoder(path).forget()  # workers are reused

    rows = wrap(docs, "text").select(ROW, text_of().alias("body"))
    short = rows.where(F.length("body") <= leaf).withColumn("e", encoded("body")).select(ROW, "e.ids", "e.decoded")
    long = rows.where(F.length("body") > leaf).withColumn("key", text_key(F.col("body")))
    # halves of halves, as in halves(): a power of two of pieces
    n = F.pow(F.lit(2), F.ceil(F.log2(F.length("body") / F.lit(leaf)))).cast("int")
    cuts = long.groupBy("key").agg(F.first("body").alias("body")).withColumn("n", n)
    at = "cast(cast(length(body) as bigint) * %s div n as int)"
    pieces = cuts.select("key", F.posexplode(F.expr(f"transform(sequence(0, n - 1), i -> substring(body, {at % 'i'} + 1, {at % '(i + 1)'} - {at % 'i'}))")).alias("k", "piece"))
    leaves = pieces.repartition("key", "k").mapInPandas(_leaf_task(path), "key binary, k int, piece string, ids binary, a binary, b binary")
    joined = leaves.groupBy("key").applyInPandas(_tree_task(path), "key binary, ids binary, decoded string")
    return short.unionByName(long.join(joined, "key").select(ROW, "ids", "decoded"))
