"""Jaccard join and components against brute force."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from sessionlake.llm import jaccard_join, word_arrays
from sessionlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def shingles(text, width=4):
    w = WORD.findall(low(text or ""))
    return frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


class Union(dict):
    def find(self, a):
        self.setdefault(a, a)
        while self[a] != a:
            self[a] = self[self[a]]
            a = self[a]
        return a


def brute(rows, percent=85):
    """doc_id → (set size, least id reachable), over all pairs of sets that share a shingle."""
    by_set = defaultdict(list)
    for i, t in rows:
        by_set[shingles(t)].append(i)
    sets = [s for s in by_set if s]
    index, up = defaultdict(list), Union()
    for a, s in enumerate(sets):
        up.find(a)
        for b, n in Counter(b for e in s for b in index[e]).items():
            if 100 * n >= percent * (len(s) + len(sets[b]) - n):
                up[up.find(a)] = up.find(b)
        for e in s:
            index[e].append(a)
    least = {}
    for a, s in enumerate(sets):
        r = up.find(a)
        least[r] = min(least.get(r, 1 << 62), *by_set[s])
    out = {i: (0, i) for i in by_set.get(frozenset(), [])}
    for a, s in enumerate(sets):
        out |= {i: (len(s), least[up.find(a)]) for i in by_set[s]}
    return out


def test_query_matches_brute_force(spark, small, llm_queries, small_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in llm_queries["op3_ngram_jaccard"](spark, small).collect()}
    assert got == brute(small_docs)


def test_hot_groups_common_passages_and_short_texts(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage, base = [word() for _ in range(30)], [word() for _ in range(120)]
    rows = [(i, " ".join([word() for _ in range(60)] + passage)) for i in range(150)]
    for i in range(200, 420):  # near copies of one text, not all of them similar to each other
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    rows += [(500 + i, "Same Text as The Others here") for i in range(100)] + [(700 + i, "a b c") for i in range(5)]
    rows += [(800, None), (801, ""), (802, " \n"), (803, "a b"), (804, "A B C")]
    for i in range(900, 940):  # chains: each a little longer than the one before
        rows.append((i, " ".join(base[:80 + (i - 900)] + ["tail"])))
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.groups(docs).collect()} == want
    left = jaccard_join.one_of_each(docs)
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for n, c in want.values() if n} | {800, 801, 802})


def brute_links(rows, percent=85):
    """doc_id → number of other sets that the row's set is linked with."""
    sets = {i: shingles(t) for i, t in rows}
    degree = {s: sum(s != o and 100 * len(s & o) >= percent * len(s | o) for o in set(sets.values())) if s else 0 for s in set(sets.values())}
    return {i: degree[s] for i, s in sets.items()}


def test_every_link_counts(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows = []
    for first, size, changes in ((0, 60, 2), (100, 40, 4), (200, 12, 1)):  # groups of near copies, the second only partly linked
        base = [word() for _ in range(90)]
        for i in range(size):
            w = list(base)
            for _ in range(rng.randint(0, changes)):
                w[rng.randrange(len(w))] = word()
            rows.append((first + i, " ".join(w)))
    rows += [(300, rows[0][1].upper()), (301, None), (302, "a b"), (303, " ".join(word() for _ in range(50)))]
    want = brute_links(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (500, 7):  # a group in one block, and in many
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        assert {r.doc_id: r.n_links for r in jaccard_join.groups(docs).collect()} == want
    assert {r.doc_id: r.component_id for r in jaccard_join.groups(docs, count=False).collect()} == {i: c for i, (_, c) in brute(rows).items()}


def test_edge_cases(spark, edge, nothing):
    got = jaccard_join.groups(edge).collect()
    assert len(got) == edge.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].n_shingles == by_id[3].n_shingles == 0 and by_id[2].component_id == 2
    assert by_id[1].component_id == by_id[7].component_id == 1 and by_id[None].component_id == 1
    assert by_id[5].n_shingles == 1
    assert jaccard_join.groups(nothing).count() == 0
    left = jaccard_join.one_of_each(edge)
    assert left.columns == edge.columns
    assert jaccard_join.one_of_each(nothing).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 80)] + [(5000 + i, 5000 + rng.randrange(i)) for i in range(1, 50)]
    pairs += [(7, 7), (1003, 1000)]
    up = Union()
    for a, b in pairs:
        up[up.find(a)] = up.find(b)
    least = {}
    for x in list(up):
        least[up.find(x)] = min(least.get(up.find(x), x), x)
    want = {x: least[up.find(x)] for x in list(up) if least[up.find(x)] != x}
    rng.shuffle(pairs)
    assert {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes(monkeypatch):
    rng = random.Random(1)
    texts = ["Hello  World\tfoo", None, "", " ", "a b a", "x" * 300 + " y ", " HELLO world"]
    texts += [" ".join(rng.choice(["ab", "ba", "Ab", "é", "abc"]) for _ in range(50)) for _ in range(30)]
    column = pa.array(texts).slice(1)
    results = []
    for piece in (64, 1 << 20):
        monkeypatch.setattr(word_arrays, "PIECE", piece)
        seen, rows = {}, []
        for first, h, ends in word_arrays.words(column):
            for i in range(len(ends) - 1):
                w, own = WORD.findall(low(texts[1 + first + i] or "")), h[ends[i]:ends[i + 1]].tolist()
                assert len(w) == len(own)
                rows.append(own)
                for a, b in zip(w, own):
                    assert seen.setdefault(a, b) == b
        assert len(set(seen.values())) == len(seen)
        results.append(rows)
    assert results[0] == results[1]
