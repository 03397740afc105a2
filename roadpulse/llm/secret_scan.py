"""Secret scans: pattern candidates, and structural confirmation of encoded keys
and signed tokens.

Three base kinds are plain patterns. The further kinds are reported only after
decoding: a base64 or hex run must decode to a private-key encoding whose
nested lengths fit exactly (ASN.1 DER or the OpenSSH container), a dotted token
must have a JSON header that names an algorithm and a JSON payload.

Each document is scanned in its own task; nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField,
                               StructType)

from .common import text_or_empty

# The base patterns, the shortest match each reports, and the
# order in which kinds are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("jwt", "pem", "key64", "keyhex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_MIN = 20
HEX_RUN = re.compile(r"[0-9a-f]{24,}")  # runs of [0-9a-f]+ of 24 and more characters
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Unbroken keys and hex runs hold such a run; a key that may be wrapped, such a start.
_LONG_RUN = re.compile(r"[A-Za-z0-9+/_-]{24}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*)-----((?:[^-]|-(?!----))++)-----END \1-----")
_PEM_HEADER = re.compile(r"^[\x20\t]*([A-Za-z][A-Za-z0-9-]*):[\x20\t]*(.*)$", re.MULTILINE)
_DEK_INFO = re.compile(r"[A-Z0-9-]+,[0-9A-Fa-f]{16,}")
_ESCAPE = re.compile(r"\\+(?:u([0-9A-Fa-f]{4})|([nrt/])|(?=\s))")
# A key starts with the tag and length of a DER sequence, or the container's name.
_KEY_START = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))(?:M[A-I]|b3BlbnNzaC1rZXktdj)[A-Za-z0-9+/_-]{10,}")
_MAYBE_KEY = re.compile(r"M[A-I][A-Za-z0-9+/_-]{10}|b3BlbnNzaC1rZXktdj")
_KEY_PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
_KEY_BREAK = re.compile(r"(?:\s|\\+[nrt]|\\+(?=\s))+")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
_URL_SAFE = str.maketrans("-_", "+/")
#: More parts than any private key has.
_MANY_PARTS = 16
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
_OPENSSH = b"openssh-key-v1\0"


def _tlv(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of the DER element at ``at``."""
    if at + 2 > len(data):
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > len(data):
            return None
        n, at = int.from_bytes(data[at:at + size], "big"), at + size
        if n < 0x80:
            return None  # DER takes the short form
    return (tag, at, at + n) if at + n <= len(data) else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[at:end]`` exactly."""
    out = []
    while at < end:
        x = _tlv(data, at)
        if x is None or x[2] > end or len(out) == _MANY_PARTS:
            return None
        out.append(x)
        at = x[2]
    return out


def is_private_key(data: bytes | _Decoded) -> bool:
    """A private key: PKCS#1, PKCS#8 or SEC 1 in DER, or an OpenSSH container,
    with every nested length consistent."""
    if data[:len(_OPENSSH)] == _OPENSSH:
        at = len(_OPENSSH)
        for _ in range(3):  # cipher, kdf, kdf options
            n = int.from_bytes(data[at:at + 4], "big")
            if at + 4 + n > len(data):
                return False
            at += 4 + n
        return at + 4 <= len(data) and int.from_bytes(data[at:at + 4], "big") >= 1
    top = _tlv(data, 0)
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _elements(data, top[1], top[2])
    if not parts or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return False
    tags = [p[0] for p in parts]
    if tags[1:3] == [0x30, 0x04]:  # PKCS#8: version, algorithm, key
        algorithm = _elements(data, *parts[1][1:])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags[:2] == [0x02, 0x04]:  # SEC 1: version 1, key, parameters
        return data[parts[0][1]] == 1 and parts[1][2] - parts[1][1] >= 16
    if len(tags) == 6 and set(tags) == {0x02}:  # DSA: version 0, p, q, g, y, x
        return data[parts[0][1]] == 0
    return len(tags) >= 9 and set(tags[:9]) == {0x02}  # PKCS#1: nine integers


def _decode64(text: str) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = _decode64(part.translate(_URL_SAFE))
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(header: str, payload: str) -> bool:
    head = _json_object(header)
    return bool(head) and isinstance(head.get("alg"), str) and _json_object(payload) is not None


def _unescaped(text: str) -> str:
    """Escaped line ends, slashes and code units as JSON and env files hold them."""
    return _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else {"/": "/", "n": "\n"}.get(m[2], " "), text)


def is_pem_key(label: str, body: str) -> bool:
    """A private key between PEM marks, also with header lines or escaped line
    ends. An encrypted one must name its cipher and fill whole blocks."""
    body = _unescaped(body)
    headers = {m[1]: m[2].strip() for m in _PEM_HEADER.finditer(body)}
    data = _decode64(re.sub(r"[\s\"',]+", "", _PEM_HEADER.sub("", body)))
    if not data or is_private_key(data):
        return bool(data)
    if "PRIVATE KEY" not in label:
        return False
    if "ENCRYPTED" in headers.get("Proc-Type", ""):
        return len(data) % 8 == 0 and bool(_DEK_INFO.fullmatch(headers.get("DEK-Info", "")))
    return "ENCRYPTED" in label and _tlv(data, 0) is not None


class _Run:
    """Pieces of base64 joined over line ends, from a key start on: each text
    position is in one run, which is read once for all key starts in it."""

    def __init__(self, text: str, at: int):
        parts, self.places, self.offsets, size = [], [], [], 0
        while m := _KEY_PIECE.match(text, at):
            parts.append(m[0])
            self.places.append(m.start())
            self.offsets.append(size)
            size += len(m[0])
            self.end = at = m.end()
            line_end = _KEY_BREAK.match(text, at)
            if not line_end:
                break
            at = line_end.end()
        self.chars = "".join(parts).translate(_URL_SAFE)
        self.offsets.append(size)

    def offset(self, place: int) -> int:
        """Characters before a piece's first."""
        return self.offsets[bisect_left(self.places, place)]

    def place_after(self, offset: int) -> int | None:
        """Text position after the first ``offset`` characters, if a piece ends there."""
        k = bisect_left(self.offsets, offset)
        if not 0 < k < len(self.offsets) or self.offsets[k] != offset:
            return None
        return self.places[k - 1] + offset - self.offsets[k - 1]


class _Decoded:
    """The first ``size`` bytes that base64 characters from ``start`` on stand
    for; only what is asked for is decoded."""

    def __init__(self, chars: str, start: int, size: int):
        self.chars, self.start, self.size = chars, start, size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at):
        if isinstance(at, slice):
            first, end, _ = at.indices(self.size)
            if first >= end:
                return b""
            begin = first // 3
            part = self.chars[self.start + begin * 4:self.start + -(-end // 3) * 4]
            return base64.b64decode(part + "=" * (-len(part) % 4))[first - begin * 3:end - begin * 3]
        return self[at:at + 1][0]


def _openssh_size(data: _Decoded) -> int | None:
    """Bytes of the container that ``data`` begins with, from the lengths of its
    fields, its public keys (none is empty) and its private part."""
    at = len(_OPENSSH)
    fields = 3  # cipher, kdf, kdf options
    keys = None
    while fields:
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at:at + 4], "big")
        if keys and not n:
            return None
        at, fields = at + 4 + n, fields - 1
        if not fields and keys is None:
            keys = int.from_bytes(data[at:at + 4], "big")
            at, fields = at + 4, keys + 1
    return at if at <= len(data) else None


def wrapped_keys(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of private keys in base64 of either alphabet, on one line or
    wrapped. The length that the encoding states tells where a key ends; of a
    candidate only the bytes that state lengths are decoded, so a text of many
    key starts takes linear time."""
    run = None
    for m in _KEY_START.finditer(text):
        if run is None or m.start() >= run.end:
            run = _Run(text, m.start())
        start = run.offset(m.start())
        data = _Decoded(run.chars, start, (len(run.chars) - start) * 3 // 4)
        if data[:9] == _OPENSSH[:9]:
            size = _openssh_size(data) if data[:len(_OPENSSH)] == _OPENSSH else None
        else:
            head = data[:9]
            more = head[1] & 0x7F if head[1] & 0x80 else 0
            begin = 2 + more
            size = begin + (int.from_bytes(head[2:begin], "big") if more else head[1])
            if head[0] != 0x30 or more > 4 or head[begin:begin + 2] != b"\x02\x01":  # a key begins with its version
                continue
        if size is None or size > len(data):
            continue
        end = run.place_after(start - (-size * 4 // 3))
        if end is not None and is_private_key(_Decoded(run.chars, start, size)):
            yield m.start(), end + min(2, len(text[end:end + 2]) - len(text[end:end + 2].lstrip("=")))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds; code points, end exclusive."""
    out = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_VALUE_MIN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if _LONG_RUN.search(text):
        out += [(m.start(), m.end(), "hex") for m in HEX_RUN.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what decoding confirms."""
    out = []
    if "-----BEGIN " in text:
        out += [(m.start(), m.end(), "pem") for m in _PEM.finditer(text) if is_pem_key(m[1], m[2])]
    out += _token_spans(text)
    if _LONG_RUN.search(text):
        out += _unbroken_keys(text)
    if _MAYBE_KEY.search(text):
        for start, end in wrapped_keys(text):
            # One span a key: not inside PEM marks, and not its first line alone.
            if not any(s <= start and end <= e for s, e, _ in out):
                out = [x for x in out if not (x[2] == "key64" and start <= x[0] and x[1] <= end)]
                out.append((start, end, "key64"))
    return out


def _token_spans(text: str) -> list[tuple[int, int, str]]:
    out, at = [], 0
    while "." in text and (m := _JWT.search(text, at)):
        at = m.start(2)  # a token may begin with the second part
        if is_signed_token(m[1], m[2]):
            out.append((m.start(), m.end(), "jwt"))
            at = m.end()
    return out


def _unbroken_keys(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _BASE64.finditer(text):
        data = _decode64(m[0])
        if data and is_private_key(data):
            out.append((m.start(), m.end(), "key64"))
    for m in _HEX_KEY.finditer(text):
        if is_private_key(bytes.fromhex(m[0])):
            out.append((m.start(), m.end(), "keyhex"))
    return out


def spans(text: str) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed, then end."""
    found = base_spans(text) + confirmed_spans(text)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of (kind, start, end) by
    start, in code points with the end exclusive.

    A null or empty text has no spans, a null id stays null, repeated rows each
    give a row, and other columns are not read. Texts are scanned whole.
    """
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("spans", ArrayType(SPAN))])
    read = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in spans(t.as_py())] for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return read.mapInArrow(run, schema)


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of ``secret_spans``: ``n_assign``, ``n_access``,
    ``n_hex``, ``base_sha256`` (of the base spans' text), ``spans``."""
    s = F.col("spans")
    base = F.filter(s, lambda x: x["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    return secret_spans(docs).select("doc_id", *map(count, BASE_KINDS),
                                     F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(s).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mark`` (overlapping and
    touching spans by one mark) and ``n_chars`` brought up to date. All rows
    and columns stay; a null text stays null."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    schema = docs.select(*others, "text").schema

    def masked(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for start, end, _ in spans(text):
            if start > at or not out and start == 0:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join(out) + text[at:] if out else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array([masked(t.as_py()) for t in b.column("text")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(c) for c in others] + [text], names=[*others, "text"])

    done = docs.select(*others, "text").mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))
    return done.select(*docs.columns)
