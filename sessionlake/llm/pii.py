"""Personal data by bootstrapped contextual extraction.

Base rules find mail addresses, IP addresses, payment cards and phone numbers.
They are the seeds. The words around a seed make lexical patterns; the patterns
and the identifier-like tokens they stand next to form a graph that Spark scores
in rounds: a pattern is worth the mean score of its distinct instances, an
instance the noisy-or of its patterns. What stands in a pattern of high
confidence outside the base spans is reported as ``ctx_<kind>``: tokens with a
digit, groups of digits joined by blanks, dots, hyphens or brackets, account
numbers in blocks, and tokens that hold an @, (at) or a dot between letters, of
``MIN_TOKEN`` characters (groups: digits) at least. A group and a token in it
are candidates each, so spans may overlap.

Instances are kept as hashes only. Edges are made distinct and aggregated
before any join, so a pattern at a third of all tokens is one row per task.

Defined results: a null text counts as empty; repeated rows are scanned each by
itself, but count as one instance in the graph; an empty table gives no rows;
null ids are kept; other columns are not read. Offsets are in code points, the
end exclusive.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.llm.common import cut, ship
from sessionlake.llm.spans import SPAN_TYPE, arrow_scan, joined, n_of

BASE_KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring; distinct seed instances a pattern needs; its confidence.
ROUNDS = 3
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.8

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Runs of digits are taken whole, which finds the same spans as the plain patterns in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"(?<!\S)[^\s0-9]*[0-9]\S*")
#: Groups of digits joined by blanks, dots, hyphens or brackets, capitals before them; account numbers in blocks.
GROUPS = re.compile(r"(?<!\w)[A-Z]{0,4}+[(\[]?+[0-9]++(?:[\x20.()\[\]-]{1,3}+[0-9]++)++")
BLOCKS = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}(?!\w)){2,}+(?:\x20[0-9]{1,3}(?!\w))?")
#: Tokens like mail addresses or hosts: an @, an (at), or a dot between letters.
MAIL_LIKE = re.compile(r"(?<!\S)(?=\S*(?:@|[(\[{<]at[>})\]]|[^\W\d_]\.[^\W\d_]))\S+", re.I)
TRIM = ".,;:!?()[]{}<>\"'"
MIN_TOKEN = 5
CONTEXT_CHARS = 80


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str):
    """Leftmost, non-overlapping: the part before each @ is the run of allowed
    characters back to the previous match or @."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        n = len(before) - len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if n else None
        if m:
            yield at - n, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 37 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """The two words before a span, and the word before with the word after."""
    before = DIGIT.sub("0", text[max(0, start - CONTEXT_CHARS):start].lower()).rpartition("\n")[2].split()
    after = DIGIT.sub("0", text[end:end + CONTEXT_CHARS].lower()).partition("\n")[0].split()
    left = ["^", "^", *before][-2:]
    return [f"{left[0]} {left[1]} _", f"{left[1]} _ {after[0] if after else '$'}"]


def instance(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.lower().encode(), digest_size=8).digest(), "big", signed=True)


def candidates(text: str) -> list[tuple[int, int]]:
    """Identifier-like spans, by start: tokens with a digit, groups of digits of
    at least MIN_TOKEN digits in all, and tokens like mail addresses."""
    out = set()
    if digits := DIGIT.search(text):
        for p in (GROUPS, BLOCKS):
            for m in p.finditer(text):
                a, b = m.span()
                if m[0][0] in "([" and not any(c in m[0] for c in ")]"):
                    a += 1
                if sum(map(str.isdigit, m[0])) >= MIN_TOKEN:
                    out.add((a, b))
    low = text.lower()
    for p in ((TOKEN,) if digits else ()) + ((MAIL_LIKE,) if "@" in text or "." in text or "at" in low else ()):
        for m in p.finditer(text):
            word, (a, b) = m[0], m.span()
            a, b = a + len(word) - len(word.lstrip(TRIM)), b - len(word) + len(word.rstrip(TRIM))
            if b - a >= MIN_TOKEN:
                out.add((a, b))
    return sorted(out)


def scan_text(text: str) -> dict:
    base = base_spans(text)
    found = [(k, a, b) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    i = 0
    for a, b in candidates(text):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if not any(x < b and y > a for x, y in taken[i:i + 4]):
            found.append((None, a, b))
    return {"base": [{"kind": k, "start": a, "end": b} for k, a, b in base],
            "tokens": [{"kind": k, "start": a, "end": b, "instance": instance(text[a:b]), "patterns": patterns(text, a, b)}
                       for k, a, b in found]}


_SPAN = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
_SCHEMA = pa.schema([("base", pa.list_(pa.struct(_SPAN))), ("tokens", pa.list_(pa.struct(
    [*_SPAN, ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))])))])


def pattern_scores(tokens: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
                   min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """pattern, kind, confidence of the high-confidence patterns. ``tokens``:
    kind (null for an unknown token), instance, patterns."""
    edges = cut(tokens.select(F.explode("patterns").alias("pattern"), "instance", "kind")
                .groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    seeds = edges.filter("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    # Distinct instances of each pattern, known or not.
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    links = edges.select("pattern", "instance")
    scores, good = seeds, None
    for _ in range(rounds):
        support = (links.join(scores, "instance").groupBy("pattern", "kind")
                   .agg(F.sum("score").alias("total"), F.count(F.lit(1)).alias("support")).filter(F.col("support") >= min_seeds))
        good = cut(support.join(size, "pattern").select("pattern", "kind", (F.col("total") / F.col("n")).alias("confidence"))
                   .filter(F.col("confidence") >= min_confidence))
        found = (links.join(good, "pattern").groupBy("instance", "kind")
                 .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("score")))
        scores = (found.join(seeds.select("instance", "kind"), ["instance", "kind"], "left_anti").unionByName(seeds))
    return good


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id, base (base spans by kind as listed, then start) and extra (spans
    found by context, by kind, then start)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        f"base {SPAN_TYPE}, tokens array<struct<kind:string,start:int,end:int,instance:bigint,patterns:array<string>>>").fields])
    rows = cut(ship(docs).mapInArrow(arrow_scan(scan_text, "text", _SCHEMA, ["doc_id"]), out)
               .withColumn("row", F.monotonically_increasing_id()))
    tokens = rows.select("row", F.inline("tokens"))
    good = pattern_scores(tokens, **limits)
    unknown = tokens.filter("kind IS NULL").select("row", "start", "end", F.explode("patterns").alias("pattern"))
    extra = (unknown.join(good.select("pattern", F.concat(F.lit("ctx_"), "kind").alias("kind")), "pattern")
             .groupBy("row").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("extra")))
    return rows.select("row", "doc_id", "base").join(extra, "row", "left").select(
        "doc_id", "base", F.coalesce("extra", F.array().cast(SPAN_TYPE)).alias("extra"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_sha256 and all spans as one string."""
    return scan(docs).select("doc_id", *[n_of(F.col("base"), k).alias(f"n_{k}") for k in BASE_KINDS],
                             F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                             joined(F.concat("base", "extra")).alias("spans"))
