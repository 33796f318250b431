"""Operator 9: secret scan with structural confirmation.

Patterns find candidates; base64 and hex candidates are decoded and parsed
(private key encodings with nested lengths, signed-token headers, armoured blocks)
before they are reported, so random long words are not, nor are public keys, certificates
and signatures.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lakeforge.llm.common import ROW, text_of, wrap

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "token", "key", "armour")

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_HINT = re.compile(r"(?ai:passw|secret|token|api_?key)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
# an encoded key starts with a sequence tag or the key file's magic
_KEY64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXk)[A-Za-z0-9+/_-]{18,}={0,2}")
_KEY16 = re.compile(r"(?<![0-9A-Za-z])30[0-9a-fA-F]{38,}(?![0-9A-Za-z])")
# line ends may be written out as \\n, as in JSON and shell settings; header lines may stand before the body
_ARMOUR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]{0,30}PRIVATE KEY)-----((?:\s|\\[nr])*)((?:[A-Za-z-]{3,30}: [^\n\\]{1,100}(?:\r?\n|\\n|\\r\\n))*)((?:[A-Za-z0-9+/=\s]|\\[nr]){16,}?)-----END \1-----"
)
_MAGIC = b"openssh-key-v1\0"
_SEQUENCE, _INTEGER, _BITS, _OCTETS, _OBJECT = 0x30, 0x02, 0x03, 0x04, 0x06


def _unbase64(s: str) -> bytes | None:
    s = re.sub(r"\\[nr]|[\s=]", "", s).replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the length-prefixed items that fill data[start:end] exactly."""
    out = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        start = at + size
    return out


def _is_der_key(data: bytes) -> bool:
    """A private key: PKCS#1, SEC1, DSA, PKCS#8, or encrypted PKCS#8; every constructed item nests exactly."""
    top = _items(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != _SEQUENCE:
        return False
    parts = _items(data, top[0][1], top[0][2])
    if not parts or len(parts) < 2:
        return False
    work = [p for p in parts if p[0] & 0x20]
    while work:
        _, a, b = work.pop()
        inner = _items(data, a, b)
        if inner is None:
            return False
        work += [p for p in inner if p[0] & 0x20]
    tags = [p[0] for p in parts]
    version = data[parts[0][1]] if tags[0] == _INTEGER and parts[0][2] - parts[0][1] == 1 else None
    if version in (0, 1):
        if tags[:9] == [_INTEGER] * 9 or version == 0 and tags == [_INTEGER] * 6:  # RSA and DSA: all numbers of the private form
            return min(p[2] - p[1] for p in parts[1:6]) > 0
        if version == 1 and tags[1] == _OCTETS:  # an elliptic curve's secret number, then its curve and public point
            return parts[1][2] - parts[1][1] >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
        return len(tags) > 2 and tags[1:3] == [_SEQUENCE, _OCTETS] and _names_an_algorithm(data, parts[1])
    return tags == [_SEQUENCE, _OCTETS] and _names_an_algorithm(data, parts[0])


def _names_an_algorithm(data: bytes, item: tuple[int, int, int]) -> bool:
    inner = _items(data, item[1], item[2])
    return bool(inner) and inner[0][0] == _OBJECT


def _is_key_file(data: bytes) -> bool:
    """The private key file of an SSH client: magic, cipher, key derivation, and as many keys as it says, filling the data."""
    if not data.startswith(_MAGIC):
        return False
    at, fields = len(_MAGIC), []
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if len(fields) == 3:  # the number of keys
            fields.append(n)
            continue
        if n > len(data) - at:
            return False
        fields.append(data[at : at + n])
        at += n
    return at == len(data) and len(fields) >= 6 and len(fields) == 5 + fields[3] and re.fullmatch(rb"[a-z0-9@.+\-]+", fields[0]) is not None


def _is_key(data: bytes | None) -> bool:
    return data is not None and (_is_key_file(data) or _is_der_key(data))


def _is_armoured(headers: str, body: str) -> bool:
    """The body is a key; or, with the headers of an encrypted one, whole cipher blocks."""
    data = _unbase64(body)
    if data is None:
        return False
    if re.search(r"Proc-Type: *4, *ENCRYPTED", headers):
        cipher = re.search(r"DEK-Info: *[A-Z0-9-]+, *([0-9A-Fa-f]+)", headers)
        block = len(cipher[1]) // 2 if cipher else 0
        return block in (8, 16) and len(data) >= block and len(data) % block == 0
    return _is_key(data)


def _is_token_header(part: str) -> bool:
    data = _unbase64(part)
    if not data or data[:1] != b"{":
        return False
    try:
        header = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    if not text:
        return []
    found = []
    if _ASSIGN_HINT.search(text):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if "." in text:
        found += [("token", *m.span()) for m in _TOKEN.finditer(text) if _is_token_header(m[1])]
    found += [("key", *m.span()) for m in _KEY64.finditer(text) if _is_key(_unbase64(m[0]))]
    if "30" in text:
        found += [("key", *m.span()) for m in _KEY16.finditer(text) if len(m[0]) % 2 == 0 and _is_key(bytes.fromhex(m[0]))]
    if "-----BEGIN " in text:
        found += [("armour", *m.span()) for m in _ARMOUR.finditer(text) if _is_armoured(m[3], m[4])]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))


@F.pandas_udf(_SPANS)
def _scan_column(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in texts], dtype=object)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """The caller's columns (one struct) and ``secrets``: spans of every kind.

    Each text is scanned whole, in its own task, with nothing shuffled.  Null
    and empty texts have no spans; repeated rows get equal spans; an empty
    table gives an empty result.
    """
    return wrap(docs, text).select(ROW, _scan_column(text_of(text)).alias("secrets"))


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
