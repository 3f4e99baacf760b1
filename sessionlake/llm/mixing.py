"""Mixing sources to target weights with soft membership.

A classifier trained on the labelled table gives every document the posterior
of each domain. Document rates r in [0, max_rate] are then fitted so that the
expected tokens of each domain, sum(r * tokens * posterior), meet the targets:
projected gradient on the least squares, scaled by the documents' tokens, where
rates move by posterior . step and are projected back. All steps are kept as one
sum ``s``, a number per domain, and rates are the projection of 1 + posterior . s,
so of all rates that meet the targets these are the nearest to 1. Steps are
scaled by the Gram matrix of the rates that are free to move, shortened until the
cost falls, and end when the gradient vanishes. A round is one aggregation
to as many numbers as there are pairs of domains; rates stay distributed.

Classifier: softmax regression on the presence of the ``VOCABULARY`` words that
tell domains apart best and on a few measures of style, fitted on at most
``SAMPLE`` labelled rows of each domain, chosen by a hash of the id (more than
``max_domains`` domains are an error); their real shares correct the posteriors.

Defined results: a null or empty text has no tokens, gets the posterior of an
empty text and never counts; a domain without mass can't be met and is left
out of the fit; without labelled rows all documents belong to one domain
``all``; repeated rows and null ids are rated one by one, equal rows alike; an
empty table gives no rows; extra columns are kept by ``mix``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from sessionlake.llm.common import cut, fresh, ship
from sessionlake.llm.word_arrays import words

SAMPLE = 1500
MAX_DOMAINS = 64
VOCABULARY = 1000
MIN_DOCUMENTS = 5
#: Aggregations that a fit may take, and shares of all tokens by which its
#: gradient may miss at the end, and by which targets count as met.
MAX_ROUNDS = 300
TOLERANCE = 1e-6
MISS = 1e-4
#: Weight of ``s`` itself against missed shares, from loose to tight: each fit
#: starts where the one before ended, and the last is the one that meets the
#: targets or comes no nearer.
RIDGES = (1e-2, 1e-4, 1e-6, 1e-8, 1e-10)
#: Production targets of the labelled table's domains.
WEIGHTS = {"q1t0": 0.85, "q0t0": 0.12, "q1t1": 0.02, "q0t1": 0.01}


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    return F.concat(F.lit("q"), F.col(quality).cast("string"), F.lit("t"), F.col(toxic).cast("string"))


def _style(text: str, hashes: np.ndarray) -> list[float]:
    n, size = max(len(hashes), 1), max(len(text), 1)
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return [upper / size * 4, min(text.count("|") / n, 1), min(text.count("!!") / n, 1),
            min(sum(map(text.count, "#*$%&<>")) / n / 3, 1), len(np.unique(hashes)) / n, min(size / n / 10, 3),
            min(text.count(".") / n * 5, 2), np.log1p(n) / 10]


N_STYLE = 8


def _texts(column: pa.Array) -> Iterator[tuple[int, str, np.ndarray]]:
    """(row, text, word hashes) of each row."""
    for first, hashes, ends in words(column):
        for i, text in enumerate(column.slice(first, len(ends) - 1).to_pylist()):
            yield first + i, text or "", hashes[ends[i]:ends[i + 1]]


def _features(column: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and token counts."""
    x = np.zeros((len(column), len(vocabulary) + N_STYLE), np.float32)
    n = np.zeros(len(column), np.int64)
    for i, text, h in _texts(column):
        n[i] = len(h)
        if len(vocabulary) and len(h):
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            x[i, at[vocabulary[at] == h]] = 1
        x[i, len(vocabulary):] = _style(text, h)
    return x, n


ROWS = 256


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


@dataclass
class Model:
    domains: list[str]
    vocabulary: np.ndarray
    weights: np.ndarray  # (features + 1) x domains, the last row is the intercept

    def posteriors(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x, n = _features(column, self.vocabulary)
        return softmax(x @ self.weights[:-1] + self.weights[-1]), n


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 300, rate: float = 0.5, ridge: float = 1e-4) -> np.ndarray:
    """Softmax regression by gradient descent with momentum."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    want = np.eye(classes, dtype=np.float32)[y]
    w = np.zeros((x.shape[1], classes), np.float32)
    speed = np.zeros_like(w)
    for _ in range(rounds):
        step = x.T @ (softmax(x @ w) - want) / len(x) + ridge * w
        speed = 0.9 * speed - rate * step
        w += speed
    return w


def learn(docs: DataFrame, domains_of: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_domains: int = MAX_DOMAINS) -> Model:
    """Fit the classifier. ``domains_of``: doc_id and domain of labelled rows,
    each id once. The sample is chosen from that table, so only its ids, at most
    max_domains * SAMPLE of them, are broadcast and no text is shuffled."""
    known_rows = domains_of.select("doc_id", "domain").filter("doc_id IS NOT NULL AND domain IS NOT NULL")
    sizes = known_rows.groupBy("domain").count().limit(max_domains + 1).collect()
    if len(sizes) > max_domains:
        raise ValueError(f"more than {max_domains} domains: raise max_domains (the driver holds {SAMPLE} rows of each)")
    domains = sorted(r["domain"] for r in sizes)
    if len(domains) < 2:
        return Model(domains or ["all"], np.zeros(0, np.uint64), np.zeros((N_STYLE + 1, 1), np.float32))
    total = {r["domain"]: r["count"] for r in sizes}
    share = F.create_map(*[x for d in domains for x in (F.lit(d), F.lit(min(1.0, 2 * SAMPLE / total[d])))])
    order = F.xxhash64("doc_id")
    best = Window.partitionBy("domain").orderBy("order", "doc_id")
    chosen = (known_rows.filter(F.pmod(order, F.lit(1_000_000)) < F.element_at(share, F.col("domain")) * 1_000_000)
              .withColumn("order", order).withColumn("at", F.row_number().over(best)).filter(F.col("at") <= SAMPLE)
              .select(F.col("doc_id").alias("chosen_id"), "domain"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    sample = cut(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("domain", "text"))
    picked = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    if not picked:
        return Model(["all"], np.zeros(0, np.uint64), np.zeros((N_STYLE + 1, 1), np.float32))

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            for i, _, h in _texts(part.column("text")):
                u = np.unique(h).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([part.column("domain")[i].as_py()] * len(u), pa.string()), pa.array(u)],
                                                 ["domain", "word"])

    n = sum(picked.values())
    known = F.create_map(*[x for d, c in picked.items() for x in (F.lit(d), F.lit(float(c)))])
    by_word = (ship(sample).mapInArrow(distinct_words, "domain string, word long").groupBy("word", "domain").count()
               .withColumn("share", F.col("count") / F.element_at(known, F.col("domain"))))
    vocabulary = np.sort(np.array([r["word"] for r in by_word.groupBy("word").agg(
        F.sum("count").alias("n"), F.max("share").alias("most")).filter(F.col("n") >= MIN_DOCUMENTS)
        .withColumn("gain", F.col("most") - F.col("n") / n).orderBy(F.desc("gain"), "word").limit(VOCABULARY).select("word").collect()],
        np.int64).view(np.uint64))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([part.column("domain"), _lists(_features(part.column("text"), vocabulary)[0])],
                                             ["domain", "x"])

    table = sample.mapInArrow(featured, "domain string, x array<float>").toArrow()
    x = np.stack(table.column("x").to_numpy(zero_copy_only=False))
    y = np.array([domains.index(d) for d in table.column("domain").to_pylist()])
    w = fit(x, y, len(domains))
    w[-1] += np.log([total[d] / max(picked.get(d, 0), 1) for d in domains])
    return Model(domains, vocabulary, w)


def posteriors(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("n_tokens", "posteriors")) -> DataFrame:
    """The columns of ``docs`` without the text, the tokens, and the posterior
    of each domain in the model's order."""
    keep = [c for c in docs.columns if c.lower() not in (text_col.lower(), *(n.lower() for n in names))]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias(text_col))
    out = StructType([docs.schema[c] for c in keep]).add(names[0], LongType()).add(names[1], ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            p, n = model.posteriors(part.column(text_col))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(n), _lists(p.astype(float))], [*keep, *names])
    return ship(docs).mapInArrow(run, out)


def rates(rows: DataFrame, domains: list[str], weights: dict[str, float], max_rate: float | None = None) -> DataFrame:
    """``rows`` (with n_tokens and posteriors; checkpointed) and their ``rate``.
    The targets are shares of the tokens of all rows. With ``max_rate`` they are
    shares of the total at which the domain of the largest weight is used up,
    each at most what its rows can give at that rate. Where no rates meet the
    targets, the least squares are minimised and a warning tells the distances."""
    d = len(domains)
    p = [F.get(F.col("posteriors"), k) for k in range(d)]
    n = F.col("n_tokens").cast("double")
    sums = rows.agg(*[F.sum(n * p[k]).alias(f"m{k}") for k in range(d)]).first()
    mass = np.array([sums[f"m{k}"] or 0.0 for k in range(d)])
    want = np.array([weights.get(x, 0.0) for x in domains]) * (mass > 0)
    want = want / want.sum() if want.sum() else np.ones(d) / d
    total, target = mass.sum(), want * mass.sum()
    if max_rate is not None:
        anchor = int(want.argmax())
        total = max_rate * mass[anchor] / want[anchor] if want[anchor] else 0.0
        target = np.minimum(want * total, max_rate * mass)
    scale = max(total, 1.0)
    first = 1.0 if max_rate is None else min(1.0, max_rate)

    def rate(steps: np.ndarray) -> Column:
        moved = F.greatest(F.lit(0.0), sum((p[j] * float(steps[j]) for j in range(d)), F.lit(first)))
        return moved if max_rate is None else F.least(F.lit(float(max_rate)), moved)

    def measured(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected tokens of each domain, the Gram matrix of the rates that are
        free to move, and the sum of the rates' potentials (whose gradient by
        ``steps`` the tokens are)."""
        r = F.col("_r")
        free = (r > 0) if max_rate is None else (r > 0) & (r < float(max_rate))
        moved = sum((p[j] * float(steps[j]) for j in range(d)), F.lit(0.0))
        got = rows.withColumn("_r", rate(steps)).agg(
            F.sum(n * (r * moved - F.pow(r - first, 2) / 2)).alias("v"), *[F.sum(n * p[j] * r).alias(f"t{j}") for j in range(d)],
            *[F.sum(F.when(free, n * p[j] * p[k])).alias(f"g{j}_{k}") for j in range(d) for k in range(j, d)]).first()
        return (np.array([got[f"t{j}"] or 0.0 for j in range(d)]),
                np.array([[got[f"g{min(j, k)}_{max(j, k)}"] or 0.0 for k in range(d)] for j in range(d)]), got["v"] or 0.0)

    steps, used = np.zeros(d), 0
    tokens, gram, potential = measured(steps)
    miss = np.inf
    for ridge in RIDGES:
        pull = ridge * scale
        cost = potential - target @ steps + pull / 2 * steps @ steps
        gradient = target - tokens - pull * steps
        while np.abs(gradient).max(initial=0.0) > TOLERANCE * scale and used < MAX_ROUNDS:
            step, share = np.linalg.solve(gram + pull * np.eye(d), gradient), 1.0
            while used < MAX_ROUNDS:
                used += 1
                to = steps + share * step
                tokens, gram, potential = measured(to)
                new = potential - target @ to + pull / 2 * to @ to
                if new <= cost - 1e-4 * share * (gradient @ step) + 1e-12 * abs(cost) or share < 1e-8:
                    break
                share /= 2
            steps, cost, gradient = to, new, target - tokens - pull * to
        before, miss = miss, float(np.linalg.norm(target - tokens))
        if miss <= MISS * scale or miss > 0.99 * before:
            break
    if miss > MISS * scale:
        why = f"not fitted in {MAX_ROUNDS} rounds" if used >= MAX_ROUNDS else "out of reach"
        warnings.warn(f"mixing targets {why}, by tokens: " + ", ".join(f"{x} {t:.1f}" for x, t in zip(domains, target - tokens)), stacklevel=2)
    return rows.withColumn("rate", F.round(rate(steps), 6))


def copies(rate: Column, *key: Column) -> Column:
    """The whole number next to a rate, up or down by a hash of the row, so
    that its mean is the rate."""
    return F.floor(rate + F.pmod(F.xxhash64(F.lit("mix"), *key), F.lit(1 << 20)) / F.lit(float(1 << 20))).cast("int")


def rated(docs: DataFrame, model: Model, weights: dict[str, float], max_rate: float | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_tokens, posteriors, rate and copies of each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    out = rates(cut(posteriors(rows, model)), model.domains, weights, max_rate)
    return out.withColumn("copies", copies(F.col("rate"), F.col("doc_id"), F.col("text_hash")))


def mix(docs: DataFrame, model: Model, weights: dict[str, float] | None = None, max_rate: float | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each row as often as its copies say."""
    key, n = fresh(docs, "text_hash_", "copies_")
    # Rows that share id and text share their copies.
    plan = (rated(docs, model, weights or WEIGHTS, max_rate, id_col, text_col).filter("copies > 0")
            .groupBy("doc_id", "text_hash").agg(F.max("copies").alias("n")))
    plan = plan.select(F.struct("doc_id", "text_hash").alias("k"), "n")
    out = docs.withColumn(key, F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash")))
    out = out.join(plan, F.col(key) == F.col("k")).withColumn(n, F.explode(F.sequence(F.lit(1), F.col("n"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labelled ids; of repeated ids the least domain."""
    return labels.select("doc_id", domain_of().alias("domain")).filter("doc_id IS NOT NULL AND domain IS NOT NULL") \
        .groupBy("doc_id").agg(F.min("domain").alias("domain"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return rated(docs, learn(docs, domains_of(labels)), WEIGHTS).drop("text_hash")
