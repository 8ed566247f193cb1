"""Secret scan with structural confirmation.

Plain patterns give assignments, access keys and hex runs. Longer candidates in
base64, base64url or hex are decoded, and reported only where the bytes parse as
what they claim to be: nested ASN.1 lengths of private keys, length-prefixed
fields of OpenSSH keys, PEM armour around either, and signed tokens whose header
and claims are JSON objects. Spans are in code points, end exclusive.

Defined cases: null and empty texts have no findings; repeated rows are scanned
each; matches never cross rows; texts are scanned whole; overlapping findings of
several kinds are all kept; an empty table gives no rows. Only the named columns
are read, others are carried by ``redact`` alone.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in their order of listing: the plain ones, then the confirmed ones.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "jwt", "pem", "der", "openssh")

_WORDS = ("password", "passwd", "secret", "token", "api_?key")
_ANY_CASE = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in _WORDS)
ASSIGN = re.compile(rf"({_ANY_CASE})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+?)-----END \1-----")
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
BLOB = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_BLOB = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
#: Object identifiers of PKCS#5 and PKCS#12 encryption begin so.
ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
RUN = 24

Span = tuple[int, int, str]


def unbase64(text: str) -> bytes | None:
    """Bytes of base64 or base64url with or without padding, strictly."""
    body = "".join(text.split()).rstrip("=").translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; its length must fit in what surrounds it."""
    if at + 2 > end:
        return None
    size, start = data[at + 1], at + 2
    if size >= 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or start + width > end:
            return None
        size, start = int.from_bytes(data[start : start + width], "big"), start + width
    return (data[at], start, start + size) if start + size <= end else None


def is_der_key(data: bytes, named: bool = False) -> bool:
    """A private key: one sequence over all bytes; a small version, then the fields of PKCS#1, PKCS#8, DSA or SEC 1; or
    an algorithm, then the octets of an encrypted PKCS#8 key. Signed digests have that form, too, so the algorithm must be
    an encryption of PKCS#5 or PKCS#12, unless armour has ``named`` it an encrypted key."""
    outer = _der(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    tags, at = [], outer[1]
    while at < outer[2]:
        item = _der(data, at, outer[2])
        if item is None:
            return False
        tags.append(item)
        at = item[2]
    kinds = [t[0] for t in tags]
    if kinds == [0x30, 4]:
        scheme = _der(data, tags[0][1], tags[0][2])
        return scheme is not None and scheme[0] == 6 and (named or data[scheme[1] : scheme[2]].startswith(ENCRYPTION))
    if len(tags) < 2 or tags[0][0] != 2 or tags[0][2] - tags[0][1] != 1 or data[tags[0][1]] > 1:
        return False
    if len(kinds) >= 9 and all(k == 2 for k in kinds[:9]):
        return True
    if kinds == [2] * 6 and data[tags[0][1]] == 0:  # DSA: a version of 0, then p, q, g, y and x
        return True
    if kinds[1] == 4:  # an elliptic curve key holds its scalar right away
        return len(kinds) == 2 or kinds[2] in (0xA0, 0xA1)
    if len(kinds) < 3 or kinds[1] != 0x30 or kinds[2] != 4:
        return False
    algorithm = _der(data, tags[1][1], tags[1][2])
    return algorithm is not None and algorithm[0] == 6


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, derivation and options, a count, public keys and the private part, filling the bytes."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return 1 <= keys <= 64 and all(field() is not None for _ in range(keys + 1)) and at == len(data)


def _key_kind(data: bytes | None, named: bool = False) -> str | None:
    return None if not data else "der" if is_der_key(data, named) else "openssh" if is_openssh_key(data) else None


def _json(part: str) -> dict | None:
    try:
        found = json.loads(unbase64(part) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    head = _json(header)
    if head is None or not isinstance(head.get("alg"), str) or _json(claims) is None:
        return False
    return (signature == "") == (head["alg"].lower() == "none")


def scan(text: str, runs: bool = True) -> list[Span]:
    """(start, end, kind) of all findings by start, then kind; ``runs`` is False if no key-like run of ``RUN`` can occur."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if "PRIVATE KEY-----" in text:
        out += [(*m.span(), "pem") for m in PEM.finditer(text) if _key_kind(unbase64(m[2]), m[1].startswith("ENCRYPTED"))]
    if runs:
        out += [(*m.span(), "hex") for m in HEX.finditer(text) if len(m[0]) >= RUN]
        for m in BLOB.finditer(text):
            if kind := _key_kind(unbase64(m[0])):
                out.append((*m.span(), kind))
        for m in HEX_BLOB.finditer(text):
            if kind := _key_kind(bytes.fromhex(m[0])):
                out.append((*m.span(), kind))
    if "." in text:
        out += [(*m.span(), "jwt") for m in JWT.finditer(text) if is_signed_token(*m.groups())]
    return sorted(set(out), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_RUN_BYTES = np.zeros(256, bool)
_RUN_BYTES[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True


def with_runs(texts: pa.Array) -> np.ndarray:
    """For each text, whether it may hold a run of ``RUN`` key-like characters; looks at all bytes at once."""
    if not len(texts):
        return np.zeros(0, bool)
    wide = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    breaks = np.union1d(np.flatnonzero(~_RUN_BYTES[data]), offsets - 1)
    long = breaks[1:][np.diff(breaks) >= RUN] - 1  # inside the run
    return np.isin(np.arange(len(wide)), np.searchsorted(offsets, long, side="right") - 1)


FINDING = "array<struct<kind:string,start:bigint,end:bigint,text:string>>"


def findings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and ``findings``: kind, start, end and the text found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))
        for batch in batches:
            texts, out = batch.column(1), []
            for may, text in zip(with_runs(texts), texts):
                t = text.as_py() or ""
                out.append([{"kind": k, "start": a, "end": b, "text": t[a:b]} for a, b, k in scan(t, bool(may))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=[batch.schema.names[0], "findings"])

    slim = df.select(id_col, F.col(text_col).cast("string").alias("__text"))
    return slim.mapInArrow(run, slim.select(id_col, F.lit(None).cast(FINDING).alias("findings")).schema)


def spans(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the findings of some kinds, comma-joined."""
    kept = F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows with every finding replaced by ``[kind]``; overlapping ones go together under the first's kind."""

    def clean(text: str | None, may: bool) -> str | None:
        if not text or not (found := scan(text, may)):
            return text
        parts, at = [], 0
        for a, b, kind in found:
            if a >= at:
                parts += [text[at:a], f"[{kind}]"]
            at = max(at, b)
        return "".join(parts) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index(text_col)
            texts = batch.column(i)
            cleaned = [clean(t.as_py(), bool(may)) for t, may in zip(texts, with_runs(texts))]
            yield batch.set_column(i, batch.schema.field(i), pa.array(cleaned, batch.schema.field(i).type))

    return df.mapInArrow(run, df.schema)
