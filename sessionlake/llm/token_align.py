"""Cross-tokenizer alignment: where the tokens of two vocabularies of one text
end together, and which of them overlap.

A text (with a space put before it) is cut at every single space between two
non-blank characters. Neither tokenizer joins anything across such a place, so
its two end lists both hold it, and a text's alignment is that of its chunks one
after another. Each worker tokenises and aligns a chunk when it first meets it
(new chunks run joined, as one text) and looks it up from then on; when CACHE_CHUNKS
are kept, the worker starts anew.

Alignment (``gallop``): the shorter end list drives a search into the longer
one, from a guess by position, in doubling steps until the value is bracketed,
then by halves, side by side for all of its ends on arrays. Ends found in both
lists slice the groups, and the difference between the ranks of two neighbouring
ends is the range of tokens that one token overlaps.

One pass over the texts writes each document's numbers and its id pairs with
their links to a table in the shared folder. Links per pair are summed per task,
then by Spark, and looked up for the table's rows in a second step. The counts
reach the tasks in shards of at most SHARD_PAIRS pairs (which is their proven
size); the number of shards is bounded by the vocabularies, not by the corpus,
and each shard beyond the first costs one more step over the table.

tiktoken runs A with the ranks of the JSON file; one in CHECK_EVERY of the joined
runs is held against the tokenizers library, a difference is an error.

Defined results: null and empty texts, and texts whose joined token bytes are not
the text's, have no tokens: zeros and ''. Rows are handled one by one, so repeated
rows, null ids and ties do not matter (repeated rows count their links each). An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.llm.common import cut, kept_table, lower_batches, ship

#: Chunks that a worker keeps, and the characters that they may hold together.
CACHE_CHUNKS = 120_000
CACHE_CHARS = 8_000_000
#: Characters of text handled at a time, and of new chunks tokenised at a time.
SLICE_CHARS = 1_000_000
RUN_CHARS = 4_000
CHECK_EVERY = 64
SHARD_PAIRS = 4_000_000
#: Rows that go to a Python worker at a time: a row holds all id pairs of its text.
BATCH = 1000
#: B's ids take so many bits of a pair's key.
B_BITS = 24
#: Texts where a plain space touches other white space are cut with care.
TOUCHING = re.compile(r" \s|[^\S ] ")
#: The pre-tokeniser pattern of the byte-level vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# ── alignment of two end lists ───────────────────────────────────────────────
def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``short`` (rising): how many of ``long`` (rising) are smaller,
    and whether it is among them. Doubling steps from a guessed place, then halves."""
    m = len(long)
    if not m or not len(short):
        return np.zeros(len(short), np.int64), np.zeros(len(short), bool)
    at = np.minimum(np.arange(len(short), dtype=np.int64) * m // max(len(short), 1), m - 1)
    right = long[at] < short  # the place looked for lies beyond the guess
    low = np.where(right, at + 1, 0)
    high = np.where(right, m, at)
    step, todo = 1, np.arange(len(short))
    while len(todo):
        up = right[todo]
        probe = np.where(up, at[todo] + step, at[todo] - step)
        inside = (probe >= 0) & (probe < m)
        todo, up, probe = todo[inside], up[inside], probe[inside]
        smaller = long[probe] < short[todo]
        low[todo[smaller]] = probe[smaller] + 1
        high[todo[~smaller]] = probe[~smaller]
        todo = todo[smaller == up]
        step *= 2
    todo = np.flatnonzero(low < high)
    while len(todo):
        mid = (low[todo] + high[todo]) >> 1
        smaller = long[mid] < short[todo]
        low[todo[smaller]] = mid[smaller] + 1
        high[todo[~smaller]] = mid[~smaller]
        todo = todo[low[todo] < high[todo]]
    found = low < m
    found[found] = long[low[found]] == short[found]
    return low, found


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Indices in A and in B of common ends, and all overlapping pairs as two
    index arrays. Both lists rise, and end with the same value."""
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    rank, found = gallop(short, long)
    common_short, common_long = np.flatnonzero(found), rank[found]
    # a token of the short list runs from behind the ends up to its start to the first end at or behind its own
    first = np.concatenate([[0], rank[:-1] + found[:-1]])
    size = rank - first + 1
    i = np.repeat(np.arange(len(short)), size)
    j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    return (common_long, common_short, j, i) if swap else (common_short, common_long, i, j)


# ── the two tokenizers ───────────────────────────────────────────────────────
@functools.cache
def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others as the characters from U+0100 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Ids and token bytes of the two tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        byte_of = _byte_of()
        bytes_a = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=bytes_a, special_tokens={})
        self.own_a = Tokenizer.from_file(path_a)
        self.own_a.encode_special_tokens = True
        self.len_a = np.zeros(max(bytes_a.values()) + 1, np.int64)
        self.bytes_a: list[bytes] = [b""] * len(self.len_a)
        for t, i in bytes_a.items():
            self.len_a[i], self.bytes_a[i] = len(t), t
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError(f"{path_b}: pieces that go on after a space mark are not supported")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.len_b = np.array([len(p) for p in self.bytes_b], np.int64)
        # A's ids inside and at the end of a group, then B's, as they stand in a group's text
        a, b = range(len(self.bytes_a)), range(len(self.bytes_b))
        self.texts = [f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b]
        self.text_sizes = np.array([len(t) for t in self.texts], np.int64)

    def ids_a(self, text: str) -> list[int]:
        return self.a.encode_ordinary(text)

    def check(self, text: str) -> None:
        own = self.own_a.encode(text, add_special_tokens=False).ids
        if own != self.ids_a(text):
            raise AssertionError(f"the tokenizers library gives other ids for {text[:80]!r}")


def chunks(text: str) -> list[str]:
    """Chunks of a text that has a space put before it, without their first space."""
    parts = text.split(" ")
    if not (text[0].isspace() or text[-1].isspace() or TOUCHING.search(text)):
        return parts
    out = parts[:1]
    for p in parts[1:]:
        # a cut needs a non-blank character on both sides
        if p and not p[0].isspace() and out[-1] and not out[-1][-1].isspace():
            out.append(p)
        else:
            out[-1] += " " + p
    return out


# ── chunk tables ─────────────────────────────────────────────────────────────
def _plain(chunk: str) -> bool:
    return bool(chunk) and not chunk[0].isspace() and not chunk[-1].isspace()


class Aligned:
    """Alignments of many chunks, flat: links as pair keys, and per chunk its
    numbers and its groups as text (None where bytes differ)."""

    def __init__(self, pair: Pair, new: list[str]):
        n = len(new)
        self.n_a, self.n_b, self.n_groups = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.ok = np.zeros(n, bool)
        self.groups: list[str] = [""] * n
        keys, owners = [], []
        runs: list[list[int]] = []
        size = RUN_CHARS + 1
        for k, c in enumerate(new):
            if not _plain(c):  # stands alone: next to white space the cuts don't hold
                runs.append([k])
                size = RUN_CHARS + 1
            elif size + len(c) > RUN_CHARS:
                runs.append([k])
                size = len(c)
            else:
                runs[-1].append(k)
                size += len(c) + 1
        texts = [" ".join(new[k] for k in r) for r in runs]
        for r, text, ids_b in zip(runs, texts, pair.b.encode(texts, num_threads=1)):
            if zlib.crc32(text.encode()) % CHECK_EVERY == 0:
                pair.check(" " + text)
            self._run(pair, new, r, " " + text, ids_b, keys, owners)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        self.keys, owner = self.keys[order], owner[order]
        self.n_links = np.bincount(owner, minlength=n)

    def _run(self, pair: Pair, new: list[str], run: list[int], text: str, ids_b: list[int], keys: list, owners: list) -> None:
        ids_a = pair.ids_a(text)
        raw = text.encode()
        if b"".join(map(pair.bytes_a.__getitem__, ids_a)) != raw or b"".join(map(pair.bytes_b.__getitem__, ids_b)) != raw:
            if len(run) > 1:  # find the chunks that differ
                for k in run:
                    self._run(pair, new, [k], " " + new[k], pair.b.encode(new[k]), keys, owners)
            return
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[b])
        common_a, common_b, ia, ib = align(ends_a, ends_b)
        # chunk of each common end and of each link
        stops = np.cumsum([len(new[k].encode()) + 1 for k in run])
        which = np.searchsorted(stops, ends_a[common_a])
        cut_a, cut_b = np.concatenate([[0], common_a + 1]), np.concatenate([[0], common_b + 1])
        at = np.searchsorted(which, np.arange(len(run) + 1))
        # every token's piece of the group text, A's tokens of a group before B's
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[common_a], end_b[common_b] = 1, 1
        group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + cut_b[group_a]] = a + end_a * len(pair.bytes_a)
        codes[np.arange(len(b)) + cut_a[group_b + 1]] = 2 * len(pair.bytes_a) + b + end_b * len(pair.bytes_b)
        line = "".join(map(pair.texts.__getitem__, codes.tolist()))
        stop = np.concatenate([[0], np.cumsum(pair.text_sizes[codes])])[(cut_a + cut_b)[at]].tolist()
        for c, k in enumerate(run):
            self.groups[k] = line[stop[c]:stop[c + 1] - 1]
        ks = np.array(run)
        self.ok[ks] = True
        self.n_groups[ks] = np.diff(at)
        last_a, last_b = cut_a[at], cut_b[at]
        self.n_a[ks], self.n_b[ks] = np.diff(last_a), np.diff(last_b)
        keys.append((a[ia] << B_BITS) | b[ib])
        owners.append(ks[np.searchsorted(stops, ends_a[ia])])


class Index(dict):
    """Chunk to index; a chunk not met yet gets the next one."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = k = len(self)
        return k


class Chunks:
    """The chunks that a worker keeps, with the tables of their alignments."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.reset()

    def reset(self) -> None:
        self.index = Index()
        self.chars = 0
        self.parts: list[Aligned] = []
        self._tables: dict[str, np.ndarray] | None = None
        self.groups: list[str] = []

    @property
    def full(self) -> bool:
        return len(self.index) >= CACHE_CHUNKS or self.chars >= CACHE_CHARS

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunk indices of all texts, one after another, and how many each has."""
        split = [chunks(t) for t in texts]
        index, known = self.index, len(self.index)
        flat = [index[c] for p in split for c in p]
        if new := list(islice(index, known, None)):
            self.chars += sum(map(len, new))
            part = Aligned(self.pair, new)
            self.parts.append(part)
            self.groups += part.groups
            self._tables = None
        return np.array(flat, np.int64), np.array([len(p) for p in split], np.int64)

    def tables(self) -> dict[str, np.ndarray]:
        if self._tables is None:
            self._tables = {k: np.concatenate([getattr(p, k) for p in self.parts]) for k in
                            ("n_a", "n_b", "n_groups", "n_links", "ok", "keys")}
            self._tables["at"] = np.cumsum(self._tables["n_links"]) - self._tables["n_links"]
        return self._tables


@functools.lru_cache(maxsize=2)
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


@functools.lru_cache(maxsize=1)
def _chunks(path_a: str, path_b: str) -> Chunks:
    """Kept by the worker process from task to task."""
    return Chunks(_pair(path_a, path_b))


def _forget() -> None:
    """Frees what a worker kept for the pass over the texts."""
    _chunks.cache_clear()
    _pair.cache_clear()


def _slices(column: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    """Places and texts of the rows that have a text, a bounded slice at a time."""
    rows, out, size = [], [], 0
    for at in range(0, len(column), 64):
        for k, t in enumerate(column.slice(at, 64).to_pylist(), at):
            if t:
                rows.append(k)
                out.append(t)
                size += len(t)
        if size >= SLICE_CHARS:
            yield rows, out
            rows, out, size = [], [], 0
    if out:
        yield rows, out


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


# ── one pass over the texts ──────────────────────────────────────────────────
def measure(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document its numbers, the digest of its groups, and its id pairs with
    the number of links that hold each."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _chunks(path_a, path_b)
        for batch in batches:
            n = len(batch)
            out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
            sha, per_doc = [""] * n, np.zeros(n, np.int64)
            pairs, times = [], []
            for rows, some in _slices(batch.column(1)):
                if c.full:
                    c.reset()
                flat, sizes = c.of(some)
                t, start = c.tables(), np.cumsum(sizes) - sizes
                good = np.logical_and.reduceat(t["ok"][flat], start)
                for name, column in out.items():
                    column[rows] = np.add.reduceat(t[name][flat], start) * good
                groups, idx = c.groups, flat.tolist()
                for r, ok, x, k in zip(rows, good.tolist(), start.tolist(), sizes.tolist()):
                    if ok:
                        sha[r] = hashlib.sha256(";".join([groups[i] for i in idx[x:x + k]]).encode()).hexdigest()
                # links of all chunks, text by text, then distinct ones of each text
                flat = flat[np.repeat(good, sizes)]
                size = t["n_links"][flat]
                at = np.repeat(t["at"][flat] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                texts = np.repeat(np.flatnonzero(good), out["n_links"][rows][good])
                found, inverse = np.unique(t["keys"][at], return_inverse=True)
                both, count = _sums(texts * max(len(found), 1) + inverse, np.ones(len(at), np.int64))
                pairs.append(found[both % max(len(found), 1)])
                times.append(count.astype(np.int32))
                per_doc[np.array(rows)] = np.bincount(both // max(len(found), 1), minlength=len(rows))
            ends = pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32))
            flat_pairs = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
            flat_times = np.concatenate(times) if times else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v) for v in out.values()], pa.array(sha, pa.string()), pa.ListArray.from_arrays(ends, pa.array(flat_pairs)),
                 pa.ListArray.from_arrays(ends, pa.array(flat_times))], ["doc_id", *out, "groups_sha256", "pairs", "times"])

    return ship(docs.select("doc_id", "text")).mapInArrow(
        parts, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a list column and how many each row has."""
    return np.asarray(column.flatten()), np.diff(np.asarray(column.offsets))


# ── counts of id pairs, and their sums per document ──────────────────────────
def pair_counts(measured: DataFrame) -> DataFrame:
    """``pair, n``: how many links of the corpus hold the pair."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            k, m = _sums(_flat(batch.column(0))[0], _flat(batch.column(1))[0].astype(np.int64))
            keys, n = _sums(np.concatenate([keys, k]), np.concatenate([n, m]))
            if len(keys) >= SHARD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])
                keys, n = keys[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    return measured.select("pairs", "times").mapInArrow(parts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _shard(pairs: DataFrame, k: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (rising), counts and best marks of one shard; at most a shard's size
    comes to the driver."""
    t = pairs.filter(F.pmod(F.xxhash64("pair"), F.lit(shards)) == k).select("pair", "n", "best").toArrow()
    keys = t.column("pair").to_numpy()
    order = np.argsort(keys)
    return keys[order], t.column("n").to_numpy()[order], t.column("best").to_numpy()[order]


def add_shard(rows: DataFrame, shard: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Adds the sums over the shard's pairs to ``n_best`` and ``count_sum``."""
    sent = rows.sparkSession.sparkContext.broadcast(shard)
    places = {c: rows.columns.index(c) for c in ("pairs", "times", "n_best", "count_sum")}

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        keys, counts, best = sent.value
        for batch in batches:
            pairs, size = _flat(batch.column(places["pairs"]))
            times = _flat(batch.column(places["times"]))[0].astype(np.int64)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            times = np.where(keys[at] == pairs, times, 0) if len(keys) else times * 0
            ends = np.concatenate([[0], np.cumsum(size)])
            for name, value in (("n_best", times * best[at] if len(keys) else times), ("count_sum", times * counts[at] if len(keys) else times)):
                total = np.concatenate([[0], np.cumsum(value)])
                now = np.asarray(batch.column(places[name])) + total[ends[1:]] - total[ends[:-1]]
                batch = batch.set_column(places[name], name, pa.array(now))
            yield batch

    return rows.mapInArrow(parts, rows.schema)


def alignment(docs: DataFrame, path_a: str, path_b: str, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """One row per document, see SCHEMA. The last step is lazy, so the session keeps
    the smaller batches."""
    lower_batches(docs.sparkSession, BATCH)
    rows = kept_table(measure(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path_a, path_b))
    counts = cut(pair_counts(rows))
    b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    top = counts.groupBy(b.alias("b")).agg(F.max("n").alias("top"))
    pairs = counts.select("*", b.alias("b")).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    zero = F.lit(0).cast("long")
    rows = rows.select("*", zero.alias("n_best"), zero.alias("count_sum"))
    shards = max(1, -(-counts.count() * 5 // (shard_pairs * 4)))  # a quarter of slack for uneven shards
    for k in range(shards):
        rows = add_shard(rows if k == 0 else kept_table(rows), _shard(pairs, k, shards))
    return rows.select([f.name for f in StructType.fromDDL(SCHEMA)])
