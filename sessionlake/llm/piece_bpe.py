"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the
piece they would form (ties: leftmost first); the best pair is merged, its new
neighbours enter the agenda, and stale entries are skipped. A vocabulary in
which no piece goes on after a space mark or contains a line feed lets a text
be cut at those places, so a text is encoded chunk by chunk and each short
chunk once per worker and cache generation. ``merge`` runs one agenda on a heap;
``merge_all`` runs the agendas of many short chunks side by side on arrays, one
best pair of each chunk a round. Unknown characters fall back to their bytes.

Each Arrow batch is checked against the sentencepiece library: one in
``CHECK_EVERY`` of the chunks that were encoded anew, and the first text of each
slice as a whole (ids and decoded text). A difference is an error.

Defined results: a null text counts as empty and has only the end id; rows are
encoded one by one, so ties, repeated rows and null ids do not matter; an empty
table gives no rows; other columns are kept (those named like a result column
are replaced).
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructType

from sessionlake.llm.common import ship

MARK = "▁"
#: Chunks in each of the two generations of a worker's cache, and the longest
#: chunk that is kept there.
CACHE_CHUNKS = 100_000
CHECK_EVERY = 16
CACHE_CHARS = 48
#: Characters of text that are turned to Arrow arrays at a time.
SLICE_CHARS = 1_000_000


class _Index(dict):
    """Chunk to place; a chunk not met yet gets the next one."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = k = len(self)
        return k


class Vocabulary:
    """Pieces, scores and byte ids of a model file; encodes and decodes."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(model_path, "rb") as f:
            raw = f.read()
        model = pb.ModelProto()
        model.ParseFromString(raw)
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces \
                or not spec.add_dummy_prefix or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{model_path}: only merge-type vocabularies with an identity normaliser are supported")
        kinds = pb.ModelProto.SentencePiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.eos = self.library.eos_id()
        self.ids: dict[str, int] = {}
        self.bytes_: dict[int, int] = {}
        self.unknown = self.library.unk_id()
        self.surface: list[bytes] = []
        scores = sorted({-p.score for p in model.pieces})
        place = {s: i for i, s in enumerate(scores)}
        self.rank: dict[str, int] = {}
        self.marked: set[int] = set()
        self.silent: set[int] = set()
        for i, p in enumerate(model.pieces):
            if p.type in (kinds.UNUSED, kinds.USER_DEFINED):
                raise ValueError(f"{model_path}: pieces of type {p.type} are not supported")
            if p.type == kinds.BYTE:
                self.bytes_[int(p.piece[3:-1], 16)] = i
                self.surface.append(bytes([int(p.piece[3:-1], 16)]))
            elif p.type == kinds.NORMAL:
                self.ids[p.piece] = i
                self.rank[p.piece] = place[-p.score]
                self.surface.append(p.piece.replace(MARK, " ").encode())
                if p.piece[0] == MARK:
                    self.marked.add(i)
            else:
                self.surface.append(model.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN else b"")
                if p.type != kinds.UNKNOWN:
                    self.silent.add(i)
        inner = any(MARK in p.lstrip(MARK) for p in self.ids)
        feeds = any("\n" in p for p in self.ids)
        self.cutter = re.compile("(?s).+" if inner else f"(?s){MARK}*[^{MARK}]+|{MARK}+" if feeds else
                                 f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        singles = sorted((ord(p), i) for p, i in self.ids.items() if len(p) == 1)
        self.single_chars = np.array([c for c, _ in singles], np.int64)
        self.single_ids = np.array([i for _, i in singles], np.int64)
        pairs = sorted((self.ids[p[:k]] * len(model.pieces) + self.ids[p[k:]], self.rank[p], i)
                       for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids)
        self.pair_keys, self.pair_ranks, self.pair_ids = (np.array(x, np.int64) for x in zip(*pairs))
        self.size = len(model.pieces)
        #: Whether a blank-free stretch between single spaces is a chunk, so that splitting finds them.
        self.splits = not inner and not feeds
        #: Each id as it stands in the text of a document's ids.
        self.id_texts = [f" {i}" for i in range(self.size)]
        self.index, self.chunk_ids = _Index(), []
        self._begin()

    def _begin(self) -> None:
        """A new generation: place of each chunk and its ids; the one before is the older one."""
        self.older, self.older_ids = self.index, self.chunk_ids
        self.index, self.chunk_ids = _Index(), []

    def merge(self, chunk: str) -> tuple[int, ...]:
        """The ids of one chunk, by the agenda."""
        rank, n = self.rank, len(chunk)
        piece = list(chunk)
        agenda = []
        for i in range(n - 1):
            r = rank.get(chunk[i:i + 2])
            if r is not None:
                agenda.append((r, i, i + 1, 2))
        if agenda:
            heapq.heapify(agenda)
            after = list(range(1, n + 1))
            before = list(range(-1, n - 1))
            while agenda:
                _, left, right, size = heapq.heappop(agenda)
                a, b = piece[left], piece[right]
                if not a or not b or len(a) + len(b) != size:
                    continue
                piece[left] = a = a + b
                piece[right] = ""
                right = after[left] = after[right]
                if right < n:
                    before[right] = left
                    r = rank.get(a + piece[right])
                    if r is not None:
                        heapq.heappush(agenda, (r, left, right, size + len(piece[right])))
                prior = before[left]
                if prior >= 0:
                    r = rank.get(piece[prior] + a)
                    if r is not None:
                        heapq.heappush(agenda, (r, prior, left, size + len(piece[prior])))
        ids, out = self.ids, []
        for p in piece:
            if p:
                i = ids.get(p)
                if i is not None:
                    out.append(i)
                elif self.bytes_:
                    out.extend(self.bytes_[b] for b in p.encode())
                else:
                    out.append(self.unknown)
        return tuple(out)

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or _NONE) and id of the piece that two symbols form."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], _NONE), self.pair_ids[at]

    def merge_all(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """The ids of many short chunks."""
        done: list[tuple[int, ...] | None] = [None] * len(chunks)
        length = np.fromiter(map(len, chunks), np.int64, len(chunks))
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.single_chars, points), len(self.single_chars) - 1)
        known = self.single_chars[at] == points
        row = np.repeat(np.arange(len(chunks)), length)
        odd = np.zeros(len(chunks), bool)
        odd[row[~known]] = True
        for i in np.flatnonzero(odd).tolist():  # characters outside the vocabulary
            done[i] = self.merge(chunks[i])
        stay = ~odd[row]
        sym, row = self.single_ids[at][stay], row[stay]
        rank, into = self._pairs(sym, row)
        while len(sym):
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            best = np.minimum.reduceat(rank << 32 | np.arange(len(sym)), first)
            over = (best >> 32) == _NONE
            ends = np.r_[first[1:], len(sym)]
            stay = np.repeat(~over, ends - first)
            if over.any():
                flat, stop = sym[~stay].tolist(), np.cumsum((ends - first)[over]).tolist()
                for r, a, b in zip(row[first[over]].tolist(), [0, *stop], stop):
                    done[r] = tuple(flat[a:b])
            spot = (best & 0xFFFFFFFF)[~over]
            sym[spot] = into[spot]
            stay[spot + 1] = False
            moved = np.cumsum(stay) - 1
            spot = moved[spot]
            sym, row, rank, into = sym[stay], row[stay], rank[stay], into[stay]
            for k in (spot, spot[spot > 0] - 1):
                nxt = np.minimum(k + 1, len(sym) - 1)
                r, i = self._looked_up(sym[k], sym[nxt])
                rank[k] = np.where((nxt > k) & (row[k] == row[nxt]), r, _NONE)
                into[k] = i
        return done

    def _pairs(self, sym: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, into = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            r, into[:-1] = self._looked_up(sym[:-1], sym[1:])
            rank[:-1] = np.where(row[:-1] == row[1:], r, _NONE)
        return rank, into

    def cut(self, text: str) -> list[str]:
        """The chunks of a text with its leading mark."""
        if self.splits and text[0] != " " and "  " not in text and MARK not in text:
            marked = (MARK + text.replace(" ", " " + MARK))
            return list(filter(None, marked.replace("\n", " \n ").split(" "))) if "\n" in text else marked.split(" ")
        return self.cutter.findall(MARK + text.replace(" ", MARK))

    def learn(self, chunks: list[str]) -> list[str]:
        """Adds chunks, in the order of their places; returns those that were encoded anew."""
        before = list(map(self.older.get, chunks))
        new = [c for c, k in zip(chunks, before) if k is None]
        fresh = iter(self.merge_all(new) if max(map(len, new), default=0) <= CACHE_CHARS else self._merge_each(new))
        self.chunk_ids += [next(fresh) if k is None else self.older_ids[k] for k in before]
        return new

    def _merge_each(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """The ids of chunks of any length."""
        short = iter(self.merge_all([c for c in chunks if len(c) <= CACHE_CHARS]))
        return [next(short) if len(c) <= CACHE_CHARS else self.merge(c) for c in chunks]

    def forget(self) -> None:
        """A full generation becomes the older one."""
        if len(self.index) > CACHE_CHUNKS:
            for c in [c for c in self.index if len(c) > CACHE_CHARS]:
                self.chunk_ids[self.index.pop(c)] = ()
            self._begin()

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, the end id last; checked against the library."""
        index, known = self.index, len(self.index)
        places = [[index[c] for c in self.cut(t)] if t else [] for t in texts]
        new = self.learn(list(islice(index, known, None)))
        get = self.chunk_ids.__getitem__
        out = [[*chain.from_iterable(map(get, p)), self.eos] for p in places]
        self.check(new[::CHECK_EVERY], texts[0], out[0])
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, the end id last."""
        out = self._encoded(texts)
        self.forget()
        return out

    def digests(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Number of ids, digest of the ids as text, and digest of the decoded text."""
        ids = self._encoded(texts)
        self.forget()
        get = self.id_texts.__getitem__
        return ([len(i) for i in ids], [hashlib.sha256("".join(map(get, i))[1:].encode()).hexdigest() for i in ids],
                [hashlib.sha256(self.decode(i).encode()).hexdigest() for i in ids])

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        if raw[:1] == b" ":
            head = next((i for i in ids if i not in self.silent), None)
            if head in self.marked:
                raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:  # bytes that make no character: one U+FFFD each
            return raw.decode(errors="surrogateescape").translate(_LOST)

    def check(self, chunks: list[str], text: str, ids: list[int]) -> None:
        """Compare cached chunks and one whole text with the library."""
        # A chunk that doesn't begin with a mark follows a line feed.
        fed = [c[1:] if c[0] == MARK else "\n" + c for c in chunks]
        lead = len(self.library.encode("\n"))
        for c, f, got in zip(chunks, fed, self.library.encode(fed, num_threads=1), strict=True):
            want = got if c[0] == MARK else got[lead:]
            if f and list(self.chunk_ids[self.index[c]]) != want:
                raise ValueError(f"the library encodes {c!r} as {want}")
        if self.library.encode(text, add_eos=True) != ids or self.library.decode(ids) != self.decode(ids):
            raise ValueError(f"the library encodes or decodes this text differently: {text[:200]!r}")


#: Rank of a pair that forms no piece.
_NONE = 1 << 30
_LOST = {0xDC00 + b: 0xFFFD for b in range(0x80, 0x100)}


@contextlib.contextmanager
def _uncollected():
    """Without cycle collection: millions of small tuples that hold no cycles
    would be walked again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(model_path: str) -> Vocabulary:
    """The vocabulary of a file, read once per worker process."""
    if model_path not in _LOADED:
        _LOADED[model_path] = Vocabulary(model_path)
    return _LOADED[model_path]


def _slices(column: pa.Array) -> Iterator[tuple[int, list]]:
    """(start, values) of runs of about SLICE_CHARS characters, or ids."""
    lengths = pc.fill_null(pc.binary_length(column) if pa.types.is_string(column.type) or
                                   pa.types.is_large_string(column.type) else pc.list_value_length(column), 0).to_numpy()
    start = total = 0
    for i, n in enumerate(lengths.tolist()):
        total += n
        if total >= SLICE_CHARS or i + 1 == len(lengths):
            yield start, column.slice(start, i + 1 - start)
            start, total = i + 1, 0


def _encoder(model_path: str, text_col: str, ids_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            for start, part in _slices(batch.column(text_col)):
                with _uncollected():
                    tokens = v.encode([t or "" for t in part.to_pylist()])
                ends = np.cumsum([0, *map(len, tokens)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(chain.from_iterable(tokens), pa.int32(), size=int(ends[-1])))
                rows = batch.slice(start, len(part))
                yield pa.RecordBatch.from_arrays([*rows.columns, ids], [*rows.schema.names, ids_col])
    return run


def _decoder(model_path: str, ids_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            for start, part in _slices(batch.column(ids_col)):
                texts = pa.array([None if ids is None else v.decode(ids) for ids in part.to_pylist()], pa.string())
                rows = batch.slice(start, len(part))
                yield pa.RecordBatch.from_arrays([*rows.columns, texts], [*rows.schema.names, text_col])
    return run


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts (the end id last)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == ids_col.lower()])
    return ship(docs).mapInArrow(_encoder(model_path, text_col, ids_col), _with(docs, ids_col, ArrayType(IntegerType())))


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``tokens`` with the text of its ids; null ids have a null text."""
    tokens = tokens.drop(*[c for c in tokens.columns if c.lower() == text_col.lower()])
    return ship(tokens).mapInArrow(_decoder(model_path, ids_col, text_col), _with(tokens, text_col, StringType()))


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with the ids of its texts and the text of those ids instead of the
    texts, in one Arrow pass: one worker and one vocabulary a task."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (ids_col.lower(), decoded_col.lower())])
    names = [c for c in docs.columns if c != text_col] + [ids_col, decoded_col]
    encoder, decoder = _encoder(model_path, text_col, ids_col), _decoder(model_path, ids_col, decoded_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decoder(encoder(batches)):
            yield batch.select(names)

    kept = StructType([f for f in docs.schema.fields if f.name != text_col])
    return ship(docs).mapInArrow(run, kept.add(ids_col, ArrayType(IntegerType())).add(decoded_col, StringType()))


def _with(df: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*df.schema.fields]).add(name, kind)


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: a text is encoded, its ids are
    decoded and both are digested in one Arrow pass, so no ids leave the worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            for start, part in _slices(batch.column(1)):
                with _uncollected():
                    sizes, ids, texts = v.digests([t or "" for t in part.to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(part)), pa.array(sizes, pa.int64()), pa.array(ids), pa.array(texts)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = docs.select("doc_id", "text")
    out = StructType([docs.schema["doc_id"]]).add("n_tokens", LongType()).add("ids_sha256", StringType()).add("decoded_sha256", StringType())
    return ship(docs).mapInArrow(run, out)
