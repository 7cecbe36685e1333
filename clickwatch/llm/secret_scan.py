"""Secret scan: contract patterns, then encoded keys confirmed by decoding and parsing.

Base kinds (`assign`, `access`, `hex`) are plain patterns. The structural kinds are
reported only if the candidate decodes and its inside parses:

* `jwt`: `header.payload.signature`, header and payload are base64url JSON objects
  and the header names an `alg` (an empty signature only for `alg` none);
* `pem`: a private-key armour whose body is base64 of DER, of the OpenSSH private-key
  format, or a ciphertext whose length fits the cipher its headers name; lines may
  end in a written-out backslash-n, as in JSON. A footer closes the header right
  before it, so text is read once however many headers stay open;
* `der`: a base64 or hex run that is one DER SEQUENCE of exactly its stated
  length, nested lengths adding up, with a key's shape (version INTEGER and further
  integers, or an algorithm identifier with an object identifier and an octet string);
* `pub`: a public key, no secret itself but a pointer to one: DER of algorithm and bits, or
  SSH wire form (length-prefixed fields that fill the blob exactly, the first naming a
  key type).

Spans are code points, end exclusive. A structural span that equals another of the
same kind is reported once; kinds may overlap (a hex run may be `hex` and `der`).
A run inside a confirmed `pem` block is reported as `pem` only.

Defined cases: null and empty texts have no spans; repeated rows stay repeated
rows; only the key and text columns are read.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed by the contract; in this order at equal starts
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run, so the least length can stand in the pattern
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "pub")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: base64url of a brace and a quote or white space begins with ey or ew
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
_MARK = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
_BODY = re.compile(r"[A-Za-z0-9+/=\s:,\\-]*")
_CIPHER = re.compile(r"DEK-Info: *[A-Z0-9-]+,([0-9A-Fa-f]+)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_BLOB = re.compile(r"[0-9A-Fa-f]{48,}")
_SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-", b"sk-ssh-", b"sk-ecdsa-")
_OPENSSH = b"openssh-key-v1\0"
_INTEGER, _BITS, _OCTETS, _OID, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def _unbase64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(text: str) -> dict | None:
    raw = _unbase64(text)
    if raw is None:
        return None
    try:
        value = json.loads(raw)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    head = _json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or _json_object(payload) is None:
        return False
    return bool(signature) or head["alg"].lower() == "none"


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The DER elements that fill `data` exactly, as (tag, content)."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width], "big")
            at += width
            if size < 0x80:
                return None  # DER takes the shortest form
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def _sequence(blob: bytes) -> list[tuple[int, bytes]]:
    """The elements of a blob that is one SEQUENCE of the stated length; else none."""
    top = _elements(blob) if blob[:1] == b"\x30" else None
    return (_elements(top[0][1]) or []) if top and len(top) == 1 else []


def is_public_key(blob: bytes) -> bool:
    """Algorithm and bits, or SSH wire form."""
    parts = _sequence(blob)
    if [t for t, _ in parts] == [_SEQUENCE, _BITS]:
        return _is_algorithm(parts[0][1])
    return is_ssh_key(blob)


def is_der_key(blob: bytes) -> bool:
    """A SEQUENCE whose elements look like a private key."""
    parts = _sequence(blob)
    if len(parts) < 2:
        return False
    tags = [t for t, _ in parts]
    if tags == [_SEQUENCE, _OCTETS]:  # encrypted: algorithm, ciphertext
        return _is_algorithm(parts[0][1])
    if tags[0] != _INTEGER or len(parts[0][1]) != 1:
        return False
    if tags[1] == _SEQUENCE and len(parts) > 2 and tags[2] == _OCTETS:  # version, algorithm, key
        return _is_algorithm(parts[1][1])
    if tags[1] == _OCTETS:  # elliptic-curve key
        return len(parts[1][1]) >= 16
    return len(parts) >= 4 and all(t == _INTEGER for t in tags)  # version and numbers


def _is_algorithm(content: bytes) -> bool:
    parts = _elements(content)
    return bool(parts) and parts[0][0] == _OID and len(parts[0][1]) >= 3


def is_ssh_key(blob: bytes) -> bool:
    """Length-prefixed fields that fill the blob, the first being a key type."""
    fields, at = [], 0
    while at < len(blob):
        if at + 4 > len(blob):
            return False
        size = int.from_bytes(blob[at : at + 4], "big")
        at += 4
        if at + size > len(blob):
            return False
        fields.append(blob[at : at + size])
        at += size
    return len(fields) >= 2 and fields[0].startswith(_SSH_TYPES)


def _is_private_body(body: str) -> bool:
    lines = body.replace("\\r", "").replace("\\n", "\n").split("\n")
    raw = _unbase64("".join("".join(x for x in lines if ":" not in x).split()))  # a colon is in headers only
    if not raw:
        return False
    for start in map(_CIPHER.match, lines):
        if start:  # ciphertext: whole blocks, whose size is that of the initial vector
            block = len(start[1]) // 2
            return block in (8, 16) and len(raw) % block == 0
    return raw.startswith(_OPENSSH) or is_der_key(raw)


def _armours(text: str) -> Iterator[tuple[int, int]]:
    """Spans of armoured private keys, in order."""
    header = None
    for mark in _MARK.finditer(text):
        if mark[1] == "BEGIN":
            header = mark
        elif header is not None and header[2] == mark[2]:
            if _BODY.fullmatch(text, header.end(), mark.start()) and _is_private_body(text[header.end() : mark.start()]):
                yield header.start(), mark.end()
            header = None


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    if ":" in text or "=" in text:  # nothing else can follow the keyword
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def _kind_of(blob: bytes | None) -> str | None:
    if not blob:
        return None
    return "der" if is_der_key(blob) else "pub" if is_public_key(blob) else None


def structural_spans(text: str) -> list[tuple[str, int, int]]:
    inside = list(_armours(text)) if "PRIVATE KEY-----" in text else []
    spans, starts = [("pem", *span) for span in inside], [a for a, _ in inside]
    if "." in text:
        spans += [("jwt", *m.span()) for m in _JWT.finditer(text) if is_signed_token(m[1], m[2], m[3])]
    found = set()
    for m in _BASE64.finditer(text):
        at = bisect_right(starts, m.start()) - 1
        if at >= 0 and m.end() <= inside[at][1]:
            continue
        if kind := _kind_of(_unbase64(m[0])):
            found.add((kind, *m.span()))
    for m in _HEX_BLOB.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := _kind_of(bytes.fromhex(m[0]))):
            found.add((kind, *m.span()))
    return spans + sorted(found)


def joined(spans: list[tuple[str, int, int]]) -> str:
    """`kind:start:end` by start, then kind as listed, then end."""
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_<kind> of every kind, base_spans and spans (all kinds) as joined text."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = [structural_spans(t) for t in texts]
            counts = [
                pa.array([sum(s[0] == kind for s in b + m) for b, m in zip(base, more)], pa.int64()) for kind in KINDS
            ]
            listed = [
                pa.array([joined(b) for b in base], pa.string()),
                pa.array([joined(b + m) for b, m in zip(base, more)], pa.string()),
            ]
            names = ["key", *[f"n_{kind}" for kind in KINDS], "base_spans", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, *listed], names=names)

    kind_of_key = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind_of_key}, {', '.join(f'n_{k} long' for k in KINDS)}, base_spans string, spans string"
    return rows.mapInArrow(search, schema).withColumnRenamed("key", key)
