"""Secret scans with structural confirmation.

Base rules find assignments, access ids and long hex strings. Beyond them, a
base64 or hex candidate is reported only if its bytes parse: private keys in
DER (every nested length must fit, and the outer shape must be that of a key),
the OpenSSH key container, PEM blocks around either, and signed tokens whose
header and payload are JSON with a named algorithm, also inside base64 or hex.
One further layer of base64 is opened. A candidate is an unbroken run, or lines
of one width (the last may be shorter) joined over line breaks, indents and
``\\n`` escapes.

Defined results: a null text counts as empty; rows are scanned one by one, so
repeated rows, ties and null ids do not matter; an empty table gives no rows;
extra columns are kept by ``scan`` (``spans`` is replaced). Offsets are in code
points, the end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.llm.common import ship
from sessionlake.llm.spans import SPAN_TYPE, arrow_scan, joined, n_of

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "key", "jwt")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Greedy runs, so a minimum length in the pattern finds the same spans as a filter.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
#: Runs on consecutive lines, the first one of 16 characters at least.
BREAK = r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+"
LINES = re.compile(rf"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\n))[A-Za-z0-9+/_-]{{16,}}+(?:{BREAK}[A-Za-z0-9+/_-]++)++(?:={{1,2}}(?!=))?")
BREAKS = re.compile(BREAK)
HEX_ANY = re.compile(r"[0-9A-Fa-f]+")
BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")

SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06
OPENSSH = b"openssh-key-v1\0"


def decode64(s: str) -> bytes | None:
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes, start: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """(tag, from, to) of the DER elements that exactly fill a range, or None."""
    end = len(data) if end is None else end
    out = []
    while start < end:
        if end - start < 2:
            return None
        tag, n, start = data[start], data[start + 1], start + 2
        if n >= 0x80:
            more = n & 0x7F
            if not 1 <= more <= 4 or end - start < more:
                return None
            n, start = int.from_bytes(data[start:start + more], "big"), start + more
        if n > end - start:
            return None
        out.append((tag, start, start + n))
        start += n
    return out


def is_der_key(data: bytes) -> bool:
    """PKCS#1, SEC 1, or plain or encrypted PKCS#8."""
    outer = elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    parts = elements(data, *outer[0][1:]) or []
    tags = [t for t, _, _ in parts]

    def algorithm(part) -> bool:
        inner = elements(data, part[1], part[2])
        return bool(inner) and inner[0][0] == OID and inner[0][2] > inner[0][1]

    if len(tags) >= 9 and all(t == INTEGER for t in tags[:9]):
        return True
    if tags[:2] == [INTEGER, OCTETS] and data[parts[0][1]:parts[0][2]] == b"\1":
        return parts[1][2] - parts[1][1] >= 16
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        return algorithm(parts[1])
    return tags == [SEQUENCE, OCTETS] and algorithm(parts[0])


def is_openssh_key(data: bytes) -> bool:
    """Container mark, then length-prefixed fields that fit."""
    if not data.startswith(OPENSSH):
        return False
    at = len(OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n:at]

    if None in (field(), field(), field()) or len(data) - at < 4:
        return False
    n = int.from_bytes(data[at:at + 4], "big")
    at += 4
    return 1 <= n <= 64 and all(field() is not None for _ in range(n + 1))


def is_key(data: bytes | None) -> bool:
    return bool(data) and len(data) >= 24 and (data[0] == SEQUENCE and is_der_key(data) or is_openssh_key(data))


def held(data: bytes | None, depth: int = 1) -> str | None:
    """``key`` or ``jwt`` if decoded bytes are or hold one."""
    if not data or len(data) < 24:
        return None
    if is_key(data):
        return "key"
    if data.isascii():
        text = data.decode().strip()
        if depth and BEGIN.search(text) and any(pem_spans(text)):
            return "key"
        if "eyJ" in text and any(is_signed_token(*m.groups()) for m in JWT.finditer(text)):
            return "jwt"
        if depth and ENCODED.fullmatch(joined_lines := BREAKS.sub("", text)):
            return held(decode64(joined_lines), depth - 1)
    return None


def encoded_kind(c: str) -> str | None:
    return held(bytes.fromhex(c) if len(c) % 2 == 0 and HEX_ANY.fullmatch(c) else None) or held(decode64(c))


def wrapped(text: str):
    """Kind and span of secrets encoded on several lines of one width."""
    for m in LINES.finditer(text):
        lines, at = [], m.start()
        for b in BREAKS.finditer(text, m.start(), m.end()):
            lines.append((at, b.start()))
            at = b.end()
        lines.append((at, m.end()))
        i = 0
        while i < len(lines):
            j, width = i + 1, lines[i][1] - lines[i][0]
            while j < len(lines) and lines[j][1] - lines[j][0] == width:
                j += 1
            # The next line may be the short end, or no part of it.
            ends = [j + 1] if j < len(lines) and lines[j][1] - lines[j][0] < width else []
            for end in (*ends, j):
                if end - i > 1 and (kind := encoded_kind("".join(text[a:b] for a, b in lines[i:end]))):
                    yield kind, lines[i][0], lines[end - 1][1]
                    j = end
                    break
            i = j


def pem_spans(text: str):
    """Spans of PEM private keys whose body parses (or is marked encrypted)."""
    at = 0
    while m := BEGIN.search(text, at):
        mark = f"-----END {m[1]}-----"
        end = text.find(mark, m.end())
        at = m.end()
        if end < 0:
            continue
        body = text[m.end():end].replace("\\n", "\n").replace("\\r", "")
        head, blank, rest = body.replace("\r", "").partition("\n\n")
        sealed = bool(blank) and "ENCRYPTED" in head and "DEK-Info" in head
        data = decode64("".join((rest if sealed else body).split()))
        if data and (len(data) % 8 == 0 if sealed else is_key(data)):
            yield m.start(), end + len(mark)
            at = end + len(mark)


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    try:
        head, body = (json.loads(decode64(x) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return head["alg"].lower() == "none" and not signature or bool(decode64(signature))


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [("pem", *s) for s in pem_spans(text)]
    blocks = [s[1:] for s in found if s[0] == "pem"]
    if "eyJ" in text:
        found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(*m.groups())]
    if "\n" in text or "\\n" in text:
        lines = [x for x in wrapped(text) if not any(a <= x[1] < b for a, b in blocks)]
        found += lines
        blocks += [x[1:] for x in lines]
    for m in ENCODED.finditer(text):
        if any(a <= m.start() < b for a, b in blocks):
            continue
        if kind := encoded_kind(m[0]):
            found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _row(text: str) -> dict:
    return {"spans": [{"kind": k, "start": a, "end": b} for k, a, b in find(text)]}


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``spans``: kind, start and end of each secret."""
    keep = [c for c in docs.columns if c.lower() != "spans"]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    out = StructType([*docs.schema.fields, *StructType.fromDDL(f"spans {SPAN_TYPE}").fields])
    return ship(docs).mapInArrow(arrow_scan(_row, text_col, pa.schema([("spans", _SPANS)]), keep), out)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_sha256 and all spans as one string."""
    s = scan(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    return s.select("doc_id", *[n_of(F.col("spans"), k).alias(f"n_{k}") for k in BASE_KINDS],
                    F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
