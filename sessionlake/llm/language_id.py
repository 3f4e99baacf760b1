"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors over hashed byte pairs and triples of
their letters. Each language has several centroids, clustered (spherical
k-means) from a bounded sample of labelled rows; a text gets the language of
the centroid with the largest cosine, and is rejected when that cosine is below
the limit learned for the language and the length of the text. Limits lie
halfway between the cosines of a language's own rows (measured on centroids of
the other half of its rows) and those of rows of all other languages, for
beginnings of several lengths; where the two overlap, own rows are kept.
Document frequencies are counted over all labelled rows.

Learned only from text and lang of rows whose crc32(doc_id as text) mod 4 is
not 2; a prediction reads nothing but the text. Sample: ``SAMPLE`` rows of each
language, chosen by a hash of the id; more than ``max_languages`` are an error.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; so is every text if no row is labelled; a null id is not learned
from and not held out; rows are predicted one by one, so repeated rows and ties
do not matter (equal cosines: first language in order); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from sessionlake.llm.common import cut, ship

DIM = 4096
CLUSTERS = 4
SAMPLE = 400
MAX_LANGUAGES = 200
#: Limits are learned for beginnings of that many characters and for whole texts,
#: from these quantiles of the cosines of own and of foreign rows.
LENGTHS = (6, 16, 40, 100, 400, 1600)
OWN, FOREIGN = 0.01, 0.95
#: Without an own row to measure, a text is rejected below this share of the one row's cosine.
REJECT = 0.3
UNKNOWN = "und"
PIECE = 1 << 18
ROWS = 128

_LETTER = np.arange(256, dtype=np.uint32)
_LETTER[[b for b in range(128) if not chr(b).isalpha()]] = 32


def counts(texts: list[str]) -> np.ndarray:
    """Hashed counts of byte pairs and triples, one row per text."""
    out = np.zeros((len(texts), DIM), np.float32)
    group: list[np.ndarray] = []
    owner: list[int] = []

    def flush() -> None:
        if group:
            b = np.concatenate(group)
            size = np.array([len(g) for g in group])
            part, row = np.repeat(np.arange(len(group)), size), np.repeat(np.array(owner), size)
            # What begins beyond a piece belongs to the next one.
            begins = np.arange(len(b)) - np.repeat(np.cumsum(size) - size, size) < PIECE
            for n, salt in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
                code = b[:len(b) - n + 1].astype(np.uint32)
                for k in range(1, n):
                    code = code << np.uint32(8) | b[k:len(b) - n + 1 + k]
                same = (part[:len(code)] == part[n - 1:]) & begins[:len(code)] & ((b[:len(code)] != 32) | (b[1:len(code) + 1] != 32))
                bucket = (code[same] * np.uint32(salt)) >> np.uint32(20)
                low = min(owner)
                got = np.bincount((row[:len(code)][same] - low) * DIM + bucket, minlength=(max(owner) - low + 1) * DIM)
                out[low:max(owner) + 1] += got.reshape(-1, DIM)
            group.clear()
            owner.clear()

    for i, t in enumerate(texts):
        raw = _LETTER[np.frombuffer(f" {t.lower()} ".encode(), np.uint8)]
        for at in range(0, max(len(raw) - 2, 1), PIECE):
            group.append(raw[at:at + PIECE + 2])
            owner.append(i)
            if sum(map(len, group)) >= PIECE:
                flush()
    flush()
    return out


def weighted(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(c) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    return weighted(counts(texts), idf)


def lengths(c: np.ndarray) -> np.ndarray:
    """Logarithms of the numbers of n-grams."""
    return np.log1p(c.sum(axis=1, dtype=np.float64))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row per centroid
    owner: np.ndarray  # language of each centroid
    limits: list[tuple[np.ndarray, np.ndarray]]  # lengths and least cosines of each language

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines and whether rejected."""
        lettered = np.array([has_letter(t) for t in texts], bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        c = counts([t if k else "" for t, k in zip(texts, lettered)])
        cosine = weighted(c, self.idf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.where(lettered, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0.0)
        which = self.owner[best]
        limit = np.array([np.interp(n, *self.limits[w]) for n, w in zip(lengths(c), which)])
        return ([self.languages[w] if k else UNKNOWN for w, k in zip(which, lettered)], score.astype(float),
                ~lettered | (score < limit))


def learnable(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2


def _rows(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column(column).to_pylist()


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(DIM, np.int64)
    for _, texts in _rows(batches, "text"):
        df += (counts(texts) > 0).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM), pa.int32()), pa.array(df)], ["bucket", "df"])


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from rows far from each other."""
    centres = v[:1]
    while len(centres) < min(k, len(v)):
        centres = np.vstack([centres, v[[int((v @ centres.T).max(axis=1).argmin())]]])
    for _ in range(rounds):
        own = (v @ centres.T).argmax(axis=1)
        centres = np.vstack([m / max(np.linalg.norm(m), 1e-9) if (m := v[own == j].sum(axis=0)).any() else centres[j]
                             for j in range(len(centres))])
    return centres.astype(np.float32)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_languages: int = MAX_LANGUAGES) -> Model:
    labelled = (docs.filter(learnable(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
                .select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
    sizes = labelled.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages: raise max_languages (the driver holds {SAMPLE} rows of each)")
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), np.zeros(0, int), [])
    n = sum(r["count"] for r in sizes)
    df = np.ones(DIM)
    for r in (ship(labelled).select("text").mapInArrow(_document_frequencies, "bucket int, df long")
              .groupBy("bucket").agg(F.sum("df").alias("df")).collect()):
        df[r["bucket"]] += r["df"]
    idf = (np.log((n + 1) / df) + 1).astype(np.float32)
    # Twice the wanted share by hash, then at most SAMPLE rows in hash order of each language.
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, 2 * SAMPLE / r["count"])))])
    order = F.xxhash64("doc_id")
    picked = cut(labelled.filter(F.pmod(order, F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
                 .withColumn("order", order).withColumn("at", F.row_number().over(_by_language())).filter(F.col("at") <= SAMPLE)
                 .select("lang", "text", (F.col("at") % 2).alias("half")))
    sample = ship(picked).mapInArrow(_vectoriser(idf), "lang string, half int, vector array<float>").toArrow()
    v = np.stack(sample.column("vector").to_numpy(zero_copy_only=False)) if sample.num_rows else np.zeros((0, DIM), np.float32)
    lang, half = np.array(sample.column("lang").to_pylist(), object), np.array(sample.column("half").to_pylist(), int)
    order_ = np.lexsort([v[:, 0], v[:, 7], v.sum(axis=1)]) if len(v) else np.zeros(0, int)
    v, lang, half = v[order_], lang[order_], half[order_]
    centroids, owner, halves = [], [], {}
    for i, name in enumerate(languages):
        mine = (lang == name) & (np.abs(v).sum(axis=1) > 0)
        c = cluster(v[mine], CLUSTERS) if mine.any() else np.zeros((1, DIM), np.float32)
        centroids.append(c)
        owner += [i] * len(c)
        halves |= {(name, h): cluster(v[mine & (half == h)], CLUSTERS) for h in (0, 1) if (mine & (half == h)).any()}
    model = Model(languages, idf, np.vstack(centroids), np.array(owner), [])
    model.limits = _limits(picked, model, halves, {n: np.abs(v[lang == n]).sum() > 0 for n in languages})
    return model


def _limits(picked: DataFrame, model: Model, halves: dict, known: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """Lengths and least cosines of each language, from beginnings of the sampled rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.searchsorted(model.owner, np.arange(len(model.languages)))
        for part, texts in _rows(batches, "text"):
            rows = list(zip(part.column("lang").to_pylist(), part.column("half").to_pylist(), texts))
            for level, size in enumerate((*LENGTHS, None)):
                some = [(n, h, t[:size]) for n, h, t in rows if has_letter(t[:size]) and (size is None or len(t) >= size)]
                if not some:
                    continue
                c = counts([t for _, _, t in some])
                w = weighted(c, model.idf)
                cosine = np.maximum.reduceat(w @ model.centroids.T, first, axis=1)
                own = [float((halves[n, 1 - h] @ x).max()) if (n, 1 - h) in halves else None for (n, h, _), x in zip(some, w)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _, _ in some], pa.string()), pa.array([level] * len(some), pa.int32()), pa.array(lengths(c)),
                     pa.array(own, pa.float64()), pa.array(list(cosine.astype(np.float32)), pa.list_(pa.float32()))],
                    ["lang", "level", "length", "own", "cosine"])

    got = ship(picked).mapInArrow(run, "lang string, level int, length double, own double, cosine array<float>").toArrow()
    lang, level = np.array(got.column("lang").to_pylist(), object), np.array(got.column("level").to_pylist(), int)
    length, own = np.array(got.column("length").to_pylist(), float), np.array(got.column("own").to_pylist(), float)
    cosine = np.array(got.column("cosine").to_pylist(), float).reshape(-1, len(model.languages))
    out = []
    for i, name in enumerate(model.languages):
        points = []
        for k in range(len(LENGTHS) + 1):
            at, mine = level == k, (level == k) & (lang == name)
            if not mine.any():
                continue
            foreign = cosine[at & (lang != name), i]
            measured = own[mine][~np.isnan(own[mine])]
            if len(measured):
                low = float(np.quantile(measured, OWN))
                limit = min(low, (low + (float(np.quantile(foreign, FOREIGN)) if len(foreign) else 0.0)) / 2)
            else:
                limit = REJECT * float(cosine[mine, i].min())
            points.append((float(np.median(length[mine])), limit))
        points = sorted(points) if known[name] and points else [(0.0, 2.0)]
        out.append((np.array([p[0] for p in points]), np.array([p[1] for p in points])))
    return out


def _by_language():
    return Window.partitionBy("lang").orderBy("order", "doc_id", F.xxhash64("text"))


def _vectoriser(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _rows(batches, "text"):
            v = vectors(texts, idf)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("half"), pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, DIM), pa.int32()), pa.array(v.ravel()))],
                ["lang", "half", "vector"])
    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text",
            names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with the language, its cosine and whether it is rejected;
    columns that have these names are replaced."""
    keep = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    out = StructType([*docs.schema.fields]).add(names[0], StringType()).add(names[1], DoubleType()).add(names[2], BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _rows(batches, text_col):
            lang, score, rejected = model.predict(texts)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                             [*keep, *names])
    return ship(docs).mapInArrow(run, out)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    out = predict(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", F.coalesce(~learnable("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns. Only texts go to
    the workers and only the verdict comes back."""
    model = learn(docs)

    @F.pandas_udf(BooleanType())
    def stays(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [model.predict(texts.iloc[at:at + ROWS].tolist())[2] for at in range(0, len(texts), ROWS)]
            yield pd.Series(~np.concatenate(parts)) if parts else pd.Series([], dtype=bool)

    return ship(docs).filter(stays(F.col("text")))
