"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct shingles (64-bit hashes). Equal sets are one
class from the start; classes are joined exactly:

* Index lists: every class is listed under the shingles of its prefix, in a
  global order (shingles found often go last, then by hash), so that two similar
  classes share a list. Lists are cut into blocks by set size, and the position
  of an entry bounds the sizes of its partners, so it is only met with the
  blocks that its position leaves.
* First round: neighbours in each list (in an order of its own) are compared.
  That takes a number of pairs linear in the entries, and ties groups of near
  copies together.
* Families: neighbours whose prefixes share a good part. Within a family the
  members are dealt to blocks and all of them are multiplied block by block. Out
  come the number of links of every class and, for each two components that a
  link joins, one link, so no list of all pairs of a group of copies is ever
  made. Only where nobody asks for numbers of links (``one_of_each``) are the
  blocks of one and the same component left alone: they are connected already.
* Second round: lists that hold several families are joined in full, and only
  entries of different families.
* Skipping answers: a class linked in the first round has an anchor. Its overlap
  with another class is at most the anchor's plus the shingles that the anchor
  lacks; anchors are compared first, and pairs that this bound rules out are not
  compared at all.

Before sets are compared, the prefixes must share what any linked pair shares
in them. Shingles to put last are found by exact counts within tasks; they only
shape the order, every order gives the same links, and at most ``FREQUENT`` of
them are kept and sent to the tasks.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; fewer words than a shingle make one shingle; rows
that repeat a text are one class; a null id never names a component but still
links; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import cut, ship, small_batches
from sessionlake.llm.components import components
from sessionlake.llm.word_arrays import mix, words

#: Links: PERCENT * union <= 100 * intersection, over shingles of WIDTH words.
WIDTH = 4
PERCENT = 85
#: Shingles put last in the order: at most so many, seen so often in tasks that
#: saw them twice or more, among the first LOOK percent of a set.
FREQUENT = 1 << 17
MIN_SEEN = 12
LOOK = 40
#: Shingles counted in a task at a time.
COUNT_AT_ONCE = 4_000_000
#: Classes (32 bytes each) up to which those to compare are sent to all tasks.
BROADCAST_ROWS = 400_000
#: Members of a family, and shingles of theirs, that are multiplied with as many
#: others at a time; the share of their prefixes that makes neighbours one family.
BLOCK = 500
BLOCK_SHINGLES = 300_000
FAMILY = 25
#: Rows handed to a Python worker, and Arrow rows made, at a time.
BATCH = 500
ROWS = 250


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes in ascending order)."""
    for first, h, ends in words(column):
        n = len(h)
        grams = np.full(max(n - width + 1, 0), 0x1234567, np.uint64)
        for k in range(width):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + h[k:n - width + 1 + k]) if len(grams) else grams
        for i in range(len(ends) - 1):
            a, b = int(ends[i]), int(ends[i + 1])
            if b - a >= width:
                yield first + i, np.unique(grams[a:b - width + 1])
            elif b > a:
                one = np.array([b - a], np.uint64)
                for k in range(a, b):
                    one = mix(one * np.uint64(0x9E3779B97F4A7C15) + h[k:k + 1])
                yield first + i, one
            else:
                yield first + i, np.zeros(0, np.uint64)


def _set_hashes(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return (int(mix(s).sum(dtype=np.uint64).view(np.int64)),
                int(mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).view(np.int64)))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted shingles that many different sets hold, at most FREQUENT."""
    def seen_twice(group: list[np.ndarray]) -> pa.RecordBatch:
        value, count = np.unique(np.concatenate(group), return_counts=True)
        many = count > 1
        return pa.RecordBatch.from_arrays([pa.array(value[many].view(np.int64)), pa.array(count[many])], ["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size, known = [], 0, set()
        for part in _parts(batches):
            for _, s in shingle_sets(part.column("text"), width):
                if len(s) and (key := _set_hashes(s)) not in known:
                    known.add(key)
                    group.append(s[:len(s) * LOOK // 100 + 1])
                    size += len(group[-1])
                    if size > COUNT_AT_ONCE:
                        yield seen_twice(group)
                        group, size, known = [], 0, set()
        if group:
            yield seen_twice(group)

    found = (ship(docs).select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= MIN_SEEN).orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toArrow())
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def sketches(docs: DataFrame, frequent: np.ndarray, width: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n, s1, s2 (hash of the set) and the prefix in the
    global order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            n, s1, s2, prefix = [], [], [], []
            for _, s in shingle_sets(part.column("text"), width):
                a, b = _set_hashes(s)
                p = prefix_size(len(s), percent) if len(s) else 0
                if len(frequent) and p:
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    late = frequent[at] == s
                    first = s[~late][:p]
                    prefix.append(np.concatenate((first, s[late][:p - len(first)])))
                else:
                    prefix.append(s[:p])
                n.append(len(s))
                s1.append(a)
                s2.append(b)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                                              pa.array(s2, pa.int64()), _lists(prefix)], ["doc_id", "text_hash", "n", "s1", "s2", "prefix"])

    return ship(docs.withColumn("text_hash", F.xxhash64("text"))).mapInArrow(run, "doc_id long, text_hash long, n long, s1 long, s2 long, prefix array<long>")


def _prefix_test(pairs: DataFrame, classes: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) with ``possible`` (the prefixes share as much as
    those of linked sets must) or ``alike`` (they share FAMILY percent)."""
    side = classes.select("cid", "prefix")
    rows = (pairs.join(side.select(F.col("cid").alias("a"), F.col("prefix").alias("pa")), "a")
            .join(side.select(F.col("cid").alias("b"), F.col("prefix").alias("pb")), "b"))

    def rank(p: np.ndarray) -> int:
        """Place of the last prefix element in the global order."""
        last = int(p[-1])
        at = int(np.searchsorted(frequent, p[-1]))
        return last + (1 << 64) if at < len(frequent) and int(frequent[at]) == last else last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, possible, alike = [], [], []
            sides = [(c.offsets.to_numpy(), c.values.to_numpy().view(np.uint64)) for c in (batch.column("pa"), batch.column("pb"))]
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            for i in range(batch.num_rows):
                x, y = (v[o[i]:o[i + 1]] for o, v in sides)
                common = len(np.intersect1d(x, y, assume_unique=True))
                # Beyond the prefix that ends first there are only its own other elements.
                rest = na[i] - len(x) if rank(x) <= rank(y) else nb[i] - len(y)
                n, m = int(na[i]), int(nb[i])
                could = common + rest >= -(-percent * (n + m) // (100 + percent))
                close = common * 100 >= FAMILY * min(len(x), len(y))
                if could or close:
                    keep.append(i)
                    possible.append(bool(could))
                    alike.append(bool(close))
            part = batch.select(["a", "b", "na", "nb"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(possible, pa.bool_()), pa.array(alike, pa.bool_())],
                                             [*part.schema.names, "possible", "alike"])

    return rows.mapInArrow(run, "a long, b long, na long, nb long, possible boolean, alike boolean")


def _sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """cid and set of the classes of ``ids``, checkpointed."""
    wanted = cut(classes.join(ids, "cid").select("rep", "cid", "s1", "s2"))
    if wanted.count() <= BROADCAST_ROWS:  # else all texts are dealt out by id
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep"))).select("cid", "s1", "s2", "text")

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            keep, sets = [], []
            s1, s2 = part.column("s1").to_numpy(), part.column("s2").to_numpy()
            for i, s in shingle_sets(part.column("text"), width):
                if _set_hashes(s) == (s1[i], s2[i]):  # another row may share the id
                    keep.append(i)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([part.column("cid").take(pa.array(keep, pa.int64())), _lists(sets)], ["cid", "set"])

    return cut(texts.mapInArrow(as_sets, "cid long, set array<long>").dropDuplicates(["cid"]))


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid")))


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with the exact intersection of their sets, checkpointed."""
    rows = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("set").alias("sb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column("sa"), batch.column("sb"))]
            got = [len(np.intersect1d(*(v[o[i]:o[i + 1]] for o, v in sides), assume_unique=True)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(got, pa.int64())],
                                             ["a", "b", "na", "nb", "overlap"])

    return cut(rows.mapInArrow(run, "a long, b long, na long, nb long, overlap long"))


def classes_of(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
               count: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(rows, classes, links, degrees): rows doc_id, text_hash, n, s1, s2; classes cid,
    rep (least id), n, s1, s2; links a, b, na, nb, overlap, enough to connect
    whatever linked pairs connect; degrees cid, n_links: the number of all classes
    that a class is linked with, if any (None without ``count``)."""
    docs = docs.select("doc_id", "text")
    frequent = frequent_shingles(docs, width)
    rows = cut(sketches(docs, frequent, width, percent))
    classes = cut(rows.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"))
                  .withColumn("cid", F.monotonically_increasing_id()))
    entries = classes.select("cid", "n", F.posexplode("prefix").alias("pos", "shingle"))
    own = Window.partitionBy("shingle").orderBy(F.xxhash64("shingle", "cid"))
    # Largest partner that the position leaves: (n - pos) >= percent * (n + m) / (100 + percent).
    reach = F.floor((F.col("n") - F.col("pos")) * (100 + percent) / F.lit(percent) - F.col("n"))
    lists = cut(entries.withColumn("reach", reach)
                .withColumn("before", F.lag(F.struct("cid", "n", "reach")).over(own)).withColumn("after", F.lead("cid").over(own))
                .filter("before IS NOT NULL OR after IS NOT NULL").select("shingle", "cid", "n", "reach", "before"))

    def linked(overlaps: DataFrame) -> DataFrame:
        return overlaps.filter(F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * percent)

    near = (lists.filter("before IS NOT NULL AND before.n <= reach AND n <= before.reach")
            .select(F.least("cid", "before.cid").alias("a"), F.greatest("cid", "before.cid").alias("b"),
                    F.when(F.col("cid") < F.col("before.cid"), F.col("n")).otherwise(F.col("before.n")).alias("na"),
                    F.when(F.col("cid") < F.col("before.cid"), F.col("before.n")).otherwise(F.col("n")).alias("nb")).distinct())
    near = cut(_prefix_test(near, classes, frequent, percent))
    sets = _sets(_both(near).distinct(), classes, docs, width)
    first = _overlaps(near.filter("possible").select("a", "b", "na", "nb"), sets)
    links = linked(first)
    roots = components(links)

    families = components(near.filter("alike").select("a", "b").unionByName(links.select("a", "b")))
    inner, degrees = _within_families(families, roots, classes, sets, percent, count)

    # Second round: entries of different families in blocks of sizes.
    tagged = cut(lists.select("shingle", "cid", "n", "reach").join(families.withColumnRenamed("node", "cid"), "cid", "left")
                 .withColumn("root", F.coalesce("root", "cid")))
    mixed = tagged.groupBy("shingle").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("shingle")
    tagged = cut(tagged.join(mixed, "shingle"))
    ratio = F.lit(100.0 / percent)
    block = lambda n: F.floor(F.log(n.cast("double")) / F.log(ratio) + 1e-9)
    small = tagged.select("shingle", F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("reach").alias("rx"), F.col("root").alias("ox"),
                          F.explode(F.sequence(block(F.col("n")), F.greatest(block(F.col("n")), block(F.col("reach"))))).alias("block"))
    large = tagged.select("shingle", F.col("cid").alias("y"), F.col("n").alias("ny"), F.col("reach").alias("ry"),
                          F.col("root").alias("oy"), block(F.col("n")).alias("block"))
    met = (small.join(large, ["shingle", "block"])
           .filter("ox <> oy AND (nx < ny OR (nx = ny AND x < y)) AND ny <= rx AND nx <= ry")
           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
                   F.when(F.col("x") < F.col("y"), F.col("nx")).otherwise(F.col("ny")).alias("na"),
                   F.when(F.col("x") < F.col("y"), F.col("ny")).otherwise(F.col("nx")).alias("nb")).distinct())
    met = cut(_prefix_test(met.join(near.select("a", "b"), ["a", "b"], "left_anti"), classes, frequent, percent)
              .filter("possible").select("a", "b", "na", "nb"))
    across = linked(_through_anchors(met, links, first, classes, docs, width, percent))
    if count:  # links are either within a family or between two
        degrees = (degrees.unionByName(_both(across).withColumn("n_links", F.lit(1).cast("long")))
                   .groupBy("cid").agg(F.sum("n_links").alias("n_links")))
    return rows.drop("prefix"), classes.drop("prefix"), links.unionByName(inner).unionByName(across), degrees


def _within_families(families: DataFrame, roots: DataFrame, classes: DataFrame, sets: DataFrame, percent: int,
                     count: bool) -> tuple[DataFrame, DataFrame | None]:
    """Links (a, b, na, nb, overlap) that join the components of a family, at least
    one for each two that are linked, and with ``count`` the numbers of all
    links within the family (cid, n_links; several rows a class)."""
    everyone = families.withColumnRenamed("root", "family").unionByName(
        families.select(F.col("root").alias("node"), F.col("root").alias("family")).distinct())
    members = cut(everyone.withColumnRenamed("node", "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
                  .withColumn("root", F.coalesce("root", "cid")).join(classes.select("cid", "n"), "cid"))
    # Components larger than a block get blocks of their own, the small ones share blocks.
    sizes = members.groupBy("family", "root").agg(
        F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("n") / F.lit(BLOCK_SHINGLES)).alias("size"))
    rest = sizes.groupBy("family").agg(F.count(F.lit(1)).alias("n_roots"), F.sum(F.when(F.col("size") < 1, F.col("size"))).alias("shared"))
    if not count:
        rest = rest.filter("n_roots > 1")
    dealt = (members.join(sizes, ["family", "root"]).join(rest, "family")
             .withColumn("own", F.when(F.col("size") >= 1, F.col("root")))
             .withColumn("part", F.pmod(F.xxhash64("cid"), F.ceil(F.coalesce(F.when(F.col("own").isNotNull(), F.col("size")),
                                                                             F.col("shared"))).cast("bigint")))
             .select("family", "cid", "n", "root", F.struct("own", "part").alias("block")))
    dealt = cut(dealt)
    blocks = dealt.select("family", "block").distinct()
    left, right = blocks.withColumnRenamed("block", "x"), blocks.withColumnRenamed("block", "y")
    meet = left.join(right, "family").filter("x <= y")
    if not count:  # two blocks of one large component are connected
        meet = meet.filter("x.own IS NULL OR y.own IS NULL OR x.own <> y.own")
    sides = meet.select("family", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    rows = (dealt.join(sides, ["family", "block"]).join(sets, "cid")
            .select(F.xxhash64("family", "x", "y").alias("task"), (F.col("block") == F.col("x")).alias("first"),
                    (F.col("x") == F.col("y")).alias("same"), "cid", "n", "root", "set"))

    def multiply(key, table):
        cid, n, root = (table.column(c).to_numpy() for c in ("cid", "n", "root"))
        first, same = (table.column(c).to_numpy(zero_copy_only=False) for c in ("first", "same"))
        sets = table.column("set").combine_chunks()
        size = np.diff(sets.offsets.to_numpy())
        value, place = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(cid)), size)
        a, b = np.flatnonzero(first), np.flatnonzero(same | ~first)
        overlap = np.zeros((len(a), len(b)), np.float32)
        for low in range(0, len(value), 8192):  # slices of the shingles bound the memory
            inside = (place >= low) & (place < low + 8192)
            x = np.zeros((len(cid), min(8192, len(value) - low)), np.float32)
            x[owner[inside], place[inside] - low] = 1
            overlap += x[a] @ x[b].T
        overlap = overlap.astype(np.int64)
        na, nb = n[a][:, None], n[b][None, :]
        link = (overlap * 100 >= (na + nb - overlap) * percent) & (cid[a][:, None] != cid[b][None, :])
        degree = np.zeros(len(cid), np.int64)
        degree[a] += link.sum(axis=1)
        if not same[0]:
            degree[b] += link.sum(axis=0)
        i, j = np.nonzero(link & (root[a][:, None] < root[b][None, :] if same[0] else root[a][:, None] != root[b][None, :]))
        x, y, o = a[i], b[j], overlap[i, j]
        # one link for two components is enough to join them
        _, one = np.unique(np.stack((np.minimum(root[x], root[y]), np.maximum(root[x], root[y]))), axis=1, return_index=True)
        x, y, o = x[one], y[one], o[one]
        swap = cid[x] > cid[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        some = np.flatnonzero(degree) if count else np.zeros(0, np.int64)
        k, m = len(x), len(some)
        return pa.table({"a": pa.array(np.concatenate((cid[x], cid[some])), pa.int64()), "b": pa.array([*cid[y].tolist(), *[None] * m], pa.int64()),
                         "na": pa.array([*n[x].tolist(), *[None] * m], pa.int64()), "nb": pa.array([*n[y].tolist(), *[None] * m], pa.int64()),
                         "overlap": pa.array([*o.tolist(), *[None] * m], pa.int64()), "n_links": pa.array([*[None] * k, *degree[some].tolist()], pa.int64())})

    found = cut(rows.groupBy("task").applyInArrow(multiply, "a long, b long, na long, nb long, overlap long, n_links long"))
    links = found.filter("n_links IS NULL").drop("n_links")
    return links, found.filter("n_links IS NOT NULL").select(F.col("a").alias("cid"), "n_links") if count else None


def _through_anchors(met: DataFrame, links: DataFrame, first: DataFrame, classes: DataFrame, docs: DataFrame,
                     width: int, percent: int) -> DataFrame:
    """Overlaps of the pairs that the answers of anchors don't rule out."""
    # Anchor of b: the linked class with the smallest id below it; ``lacks``: shingles of b outside it.
    anchor = (links.groupBy("b").agg(F.min(F.struct("a", "na", "overlap", "nb")).alias("k"))
              .select(F.col("b").alias("a"), F.col("k.a").alias("anchor"), F.col("k.na").alias("n_anchor"),
                      (F.col("k.nb") - F.col("k.overlap")).alias("lacks")))
    asked = cut(met.join(anchor, "a", "left"))
    through = asked.filter("anchor IS NOT NULL AND anchor <> b").select(
        F.least("anchor", "b").alias("a"), F.greatest("anchor", "b").alias("b"),
        F.when(F.col("anchor") < F.col("b"), F.col("n_anchor")).otherwise(F.col("nb")).alias("na"),
        F.when(F.col("anchor") < F.col("b"), F.col("nb")).otherwise(F.col("n_anchor")).alias("nb")).distinct()
    def overlaps(pairs: DataFrame) -> DataFrame:
        return _overlaps(pairs, _sets(_both(pairs).distinct(), classes, docs, width))

    answers = overlaps(through)
    known = answers.unionByName(first).dropDuplicates(["a", "b"]).select(F.col("a").alias("ka"), F.col("b").alias("kb"),
                                                                       F.col("overlap").alias("anchor_overlap"))
    rest = (asked.join(known, (F.col("ka") == F.least("anchor", "b")) & (F.col("kb") == F.greatest("anchor", "b")), "left")
            .filter(F.col("anchor_overlap").isNull() | (
                (F.col("anchor_overlap") + F.col("lacks")) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))
            .select("a", "b", "na", "nb"))
    rest = rest.join(answers.select("a", "b"), ["a", "b"], "left_anti")
    return answers.unionByName(overlaps(cut(rest)))


def groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
           count: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (least id that links reach), n_links (the
    number of other sets that the row's set is linked with; rows of equal sets
    are one class and count once; null without ``count``), text_hash and
    component_key (null for an empty set)."""
    # Rows with sets are large; everything that runs Python here is checkpointed inside.
    with small_batches(docs.sparkSession, BATCH):
        rows, classes, links, degrees = classes_of(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), width, percent, count)
    roots = components(links)
    tagged = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = tagged.groupBy("root").agg(F.min("rep").alias("component_id"))
    if count:
        tagged = tagged.join(degrees, "cid", "left")
    number = F.coalesce("n_links", F.lit(0).cast("long")) if count else F.lit(None).cast("long")
    named = cut(tagged.join(least, "root").select("s1", "s2", "n", "component_id", number.alias("n_links"), "root"))
    return rows.join(named, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links") if count else "n_links", "text_hash", F.col("root").alias("component_key"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component (the least id) and every row with
    an empty set. Rows that repeat both id and text stay or go together."""
    found = cut(groups(docs, width, percent, id_col, text_col, count=False).select("doc_id", "text_hash", "component_key"))
    best = found.filter("component_key IS NOT NULL").groupBy("component_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("best")).select("best.*")
    stay = found.filter("component_key IS NULL").select("doc_id", "text_hash").unionByName(best).distinct().select(
        F.col("doc_id").alias("stay_id"), F.col("text_hash").alias("stay_hash"))
    return docs.join(stay, F.col(id_col).eqNullSafe(F.col("stay_id")) & (F.xxhash64(F.col(text_col)) == F.col("stay_hash")), "left_semi")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links."""
    return groups(docs).select("doc_id", "n_shingles", "component_id", "n_links")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])))
        END AS g FROM w),
c AS (SELECT min(doc_id) AS cid, g FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT cid, len(g) AS n, unnest(g) AS x FROM c),
p AS (SELECT a.cid AS a, b.cid AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o
      FROM e a JOIN e b ON a.x = b.x AND a.cid < b.cid AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * o >= 85 * (na + nb - o)),
edges AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (SELECT cid, cid FROM c UNION SELECT edges.b, r.root FROM r JOIN edges ON edges.a = r.node),
k AS (SELECT node, min(root) AS root FROM r GROUP BY node),
d AS (SELECT a, count(*) AS n_links FROM edges GROUP BY a)
SELECT s.doc_id, len(s.g) AS n_shingles, coalesce(k.root, s.doc_id) AS component_id, coalesce(d.n_links, 0) AS n_links
FROM s LEFT JOIN c ON s.g = c.g LEFT JOIN k ON k.node = c.cid LEFT JOIN d ON d.a = c.cid
"""
