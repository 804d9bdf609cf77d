"""Secret scan with structural confirmation.

Base kinds by pattern, leftmost and non-overlapping per kind: ``assign`` (a named value of 12+ characters), ``access``
(an AKIA key of 18+ characters), ``hex`` (16+ hexadecimal digits). The method adds spans of candidates that hold
up when decoded:

* ``jwt``: three base64url parts whose first decodes to a JSON object with ``alg`` (and whose second is JSON);
* ``der``: base64 or hex that decodes to an ASN.1 SEQUENCE whose nested lengths fit to the last byte;
* ``sshkey``: base64 or hex of an OpenSSH public or private key, with length-prefixed fields that fit.

Base64 may run over lines, indented or with escaped newlines; a key ends at the line where its own lengths end.

Positions are code points, ends exclusive. Null and empty texts give no span; texts of any length are scanned whole;
repeated rows each give a row; an empty table an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
from bisect import bisect_left
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from courtview.llm.common import small_batches

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "der", "sshkey")
# fixed values of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=(e[A-Za-z0-9_-]{7,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*))")  # at every part: '{' in base64url
BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")  # newlines may be escaped, lines indented
BASE64 = re.compile(r"(?:(?<=\\)n)?([A-Za-z0-9+/]{40,}(?:" + BREAK.pattern + r"[A-Za-z0-9+/]+)*={0,2})")
HEX_ANY = re.compile(r"[0-9A-Fa-f]{40,}")
MAGIC = b"openssh-key-v1\x00"
MAX_FIELDS = 16  # a public key has 2 to 5, a certificate 13
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end)."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _length(raw: bytes, at: int) -> tuple[int, int] | None:
    """A DER length and the offset behind it."""
    if at >= len(raw):
        return None
    n = raw[at]
    if n < 0x80:
        return n, at + 1
    k = n & 0x7F
    if not 1 <= k <= 4 or at + 1 + k > len(raw) or raw[at + 1] == 0:
        return None
    return int.from_bytes(raw[at + 1:at + 1 + k], "big"), at + 1 + k


def is_der(raw: bytes) -> bool:
    """A SEQUENCE of well-formed elements that fills ``raw``; constructed elements are walked without recursion."""
    if len(raw) < 16 or raw[0] != 0x30:
        return False
    head = _length(raw, 1)
    if head is None or head[1] + head[0] != len(raw):
        return False
    todo, integers, elements = [(head[1], len(raw))], 0, 0
    while todo:
        at, end = todo.pop()
        while at < end:
            tag = raw[at]
            size = _length(raw, at + 1)
            if tag in (0x00, 0xFF) or size is None or size[1] + size[0] > end:
                return False
            elements += 1
            integers += tag in (0x02, 0x03, 0x04, 0x06)
            if tag in (0x30, 0x31) or 0xA0 <= tag <= 0xA3:
                todo.append((size[1], size[1] + size[0]))
            at = size[1] + size[0]
    return elements >= 2 and integers >= 1


def is_ssh_key(raw: bytes) -> bool:
    """The private key's magic, or length-prefixed fields of a public key that fill ``raw``."""
    if raw[:15] == MAGIC:
        return len(_field_ends(raw, 15, 3)) == 3
    ends = _field_ends(raw, 0, MAX_FIELDS)
    return len(ends) >= 2 and ends[-1] == len(raw) and raw[4:ends[0]].startswith(SSH_NAMES)


def _field_ends(raw: bytes, at: int, most: int) -> list[int]:
    """Ends of the fields of 4-byte lengths from ``at`` on, as many as fit, at most ``most``."""
    out = []
    while len(out) < most and at + 4 <= len(raw):
        at += 4 + int.from_bytes(raw[at:at + 4], "big")
        if at > len(raw):
            break
        out.append(at)
    return out


def _json_object(part: str) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _decoded(kind: str, value: str) -> bytes | None:
    try:
        if kind == "hex":
            return bytes.fromhex(value) if len(value) % 2 == 0 else None
        flat = value.rstrip("=")
        return base64.b64decode(flat + "=" * (-len(flat) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


def _kind(raw: bytes | None) -> int | None:
    if raw is None:
        return None
    return 4 if is_der(raw) else 5 if is_ssh_key(raw) else None


class _Decoded:
    """The bytes of a run of base64 letters from ``start`` on, decoded where they are looked at."""

    def __init__(self, letters: str, start: int, end: int) -> None:
        self.letters, self.start, self.n = letters, start, (end - start) * 3 // 4

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at: int | slice):
        if not isinstance(at, slice):
            return self[at:at + 1][0]
        a, b = min(at.start or 0, self.n), self.n if at.stop is None else min(at.stop, self.n)
        if a >= b:
            return b""
        part = self.letters[self.start + a // 3 * 4:self.start + -(-b // 3) * 4]
        return base64.b64decode(part + "=" * (-len(part) % 4) if len(part) % 4 != 1 else part[:-1])[a % 3:a % 3 + b - a]


def _is_head(raw: _Decoded) -> bool:
    return raw[:1] == b"\x30" or raw[:15] == MAGIC or raw[4:16].startswith(SSH_NAMES)


def _sizes(raw: _Decoded) -> list[int]:
    """The sizes in bytes that a key at the head may have, by its own lengths, largest first."""
    if raw[:1] == b"\x30":
        head = _length(raw, 1)
        return [head[0] + head[1]] if head else []
    if raw[:15] == MAGIC:
        ends = _field_ends(raw, 15, 3)  # cipher, derivation and its options
        if len(ends) < 3:
            return []
        count = int.from_bytes(raw[ends[2]:ends[2] + 4], "big")
        keys = _field_ends(raw, ends[2] + 4, count + 1) if count < MAX_FIELDS else []  # public keys, then the private part
        return [keys[-1]] if len(keys) == count + 1 else [len(raw)]  # cut short: to the last line
    return [e for e in _field_ends(raw, 0, MAX_FIELDS)[1:]][::-1]


def _base64_spans(text: str) -> list[tuple[int, int, int]]:
    """Keys in runs of base64 lines: a key may begin at any line of 40 letters and end before the run does.

    A key's end is read from its own lengths, and its lines are found by their running number of letters: the work
    at a line does not grow with the lines behind it, unless a key's elements do fit.
    """
    found = []
    for m in BASE64.finditer(text):
        at, places = m.start(1), []
        for b in BREAK.finditer(text, m.start(1), m.end(1)):
            places.append((at, b.start()))
            at = b.end()
        places.append((at, m.end(1)))
        letters = "".join(text[a:b] for a, b in places).rstrip("=")
        ends, n = [], 0
        for a, b in places:
            n = min(n + b - a, len(letters))
            ends.append(n)
        i = 0
        while i < len(places):
            start, key = ends[i - 1] if i else 0, None
            if ends[i] - start >= 40:
                rest = _Decoded(letters, start, len(letters))
                for size in _sizes(rest) if _is_head(rest) else ():
                    k = bisect_left(ends, start + -(-size * 4 // 3), i)  # the line in which so many bytes end
                    if k < len(ends) and (ends[k] - start) % 4 != 1:
                        kind = _kind(_Decoded(letters, start, ends[k]))
                        if kind is not None:
                            key = k, kind
                            break
            if key is not None:
                found.append((places[i][0], key[1], places[key[0]][1]))
                i = key[0]
            i += 1
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates that their own structure confirms."""
    found = []
    if "." in text:
        for m in JWT.finditer(text):
            head = _json_object(m[1])
            if head is not None and isinstance(head.get("alg"), str) and _json_object(m[2]) is not None:
                found.append((m.start(), 3, m.end(3)))
    found += _base64_spans(text)
    for m in HEX_ANY.finditer(text):
        kind = _kind(_decoded("hex", m[0]))
        if kind is not None:
            found.append((m.start(), kind, m.end()))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(text: str | None) -> tuple[int, int, int, str, str]:
    """n_assign, n_access, n_hex, base_sha256, spans of one text."""
    base = base_spans(text) if text else []
    every = sorted(set(base + confirmed_spans(text))) if text else []
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_confirmed of every row."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t) for t in batch.column("text").to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            spans = pa.array(cols[4], pa.string())
            extra = [sum(s.count(k + ":") for k in KINDS[3:]) for s in cols[4]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), spans,
                                              pa.array(extra, pa.int64())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])

    return docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text").mapInArrow(
        run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long")
