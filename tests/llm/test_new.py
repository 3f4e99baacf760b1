"""Whitening, URL filter and cross-tokenizer alignment against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from sessionlake.llm import token_align, url_filter, whitening
from sessionlake.llm.common import BATCH_ROWS


# ── embedding whitening ──────────────────────────────────────────────────────
@pytest.mark.parametrize("low,high,n,d", [(-60, 80, 130, 7), (0, 2**40, 70, 3), (5, 6, 9, 2), (0, 2, 64, 5)])
def test_bit_planes_give_exact_cross_products(low, high, n, d):
    x = np.random.default_rng(n).integers(low, high, (n, d)) + whitening.OFFSET
    got_n, s, xx = whitening.cross_products(x)
    o = x.astype(object)
    assert got_n == n and (s == o.sum(axis=0)).all() and (xx == o.T.dot(o)).all()


def _whitened(df):
    return {(r.vec_id, r.component): r for r in whitening.whiten(df).collect()}


def test_whitening_against_numpy(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    e = df.toPandas()
    x = np.floor(64 * np.vstack(e.embedding).astype(float)).astype(np.int64) + 10**6
    n, s = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    z = (x - x.mean(axis=0)) @ vectors[:, :32] / np.sqrt(values[:32])
    got = _whitened(df)
    assert len(got) == 32 * n
    for i, v in enumerate(e.vec_id):
        assert got[v, 1].deviation == ((n * x[i] - s) ** 2).sum() and got[v, 1].n == n
        for c in range(32):
            assert abs(abs(got[v, c + 1].whitened) - abs(z[i, c])) < 1e-7
    assert all(abs(got[e.vec_id[0], c + 1].explained - values[c] / values.sum()) < 1e-9 for c in range(32))
    assert 0 <= got[e.vec_id[0], 1].identity_error < 1e-8


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0, 7.0], 1), (2, [1.0, 0.0, 7.0], 1), (2, [1.0, 0.0, 7.0], 1), (None, [0.5, 0.25, 7.0], 1), (4, None, 1), (5, [], 1),
            (6, [nan, 0.0, 1.0], 1), (7, [None, 0.0, 1.0], 1), (8, [inf, 0.0, 1.0], 1), (9, [1.0], 1), (10, [1e300, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    got = whitening.whiten(df).collect()
    assert Counter(r.vec_id for r in got) == {1: 2, 2: 4, None: 2}  # the constant dimension has no component
    assert {r.n for r in got} == {4}
    same = df.filter("vec_id = 2")
    assert whitening.whiten(same).collect() == [] and whitening.whiten(df.limit(0)).columns == [c.split()[0] for c in whitening.SCHEMA.split(", ")]


def test_deviation_beyond_int64_arithmetic(spark):
    far = 2.0**20
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [far, 1.0]), (3, [far, -2.0])], "vec_id long, embedding array<double>")
    x = [[10**6, 10**6], [64 * 2**20 + 10**6, 64 + 10**6], [64 * 2**20 + 10**6, 10**6 - 128]]
    s = [sum(c) for c in zip(*x)]
    want = {i + 1: sum((3 * a - b) ** 2 for a, b in zip(r, s)) for i, r in enumerate(x)}
    assert {r.vec_id: r.deviation for r in whitening.whiten(df).collect()} == want


# ── URL filter ───────────────────────────────────────────────────────────────
def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after).group()
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", after[len(host):]).group()


def _rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


def _plain_verdicts(rows):
    """Dense personalised PageRank with the rank of edgeless hosts going back to the seeds."""
    hp = [_host_path(u) for _, u, _ in rows]
    edges, counts = Counter(), {}
    for (h, p), (_, _, html) in zip(hp, rows):
        r = _rule(h, p)
        if h:
            c = counts.setdefault(h, [0, 0])
            if r:
                c[r[0] == "block"] += 1
        for t in re.findall(url_filter.LINK, html or ""):
            t = _host_path("x://" + t)[0]
            if h and t and h != t:
                edges[h, t] += 1
    hosts = sorted(set(counts) | {x for e in edges for x in e})
    for h in hosts:
        above = h.split(".", 1)[1] if "." in h else ""
        if above in hosts:
            edges[h, above] += 1
            edges[above, h] += 1
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for (a, b), w in edges.items():
        m[at[a], at[b]] += w
    seeds = np.array([[c[k] / max(sum(c), 1) for k in (0, 1)] for c in (counts.get(h, [0, 0]) for h in hosts)]).reshape(-1, 2)
    out = []
    for k, flow in ((0, m), (1, m.T)):
        s = seeds[:, k]
        if not s.sum():
            out.append(s)
            continue
        p, size = s / s.sum(), flow.sum(axis=1)
        x = p.copy()
        for _ in range(400):
            x = 0.15 * p + 0.85 * ((np.divide(x, size, where=size > 0, out=np.zeros_like(x))) @ flow + x[size == 0].sum() * p)
        out.append(x * s.sum())
    by_host = {h: ("block" if out[1][i] > out[0][i] * (1 + 1e-9) else "allow") for h, i in at.items()}
    scores = {h: (out[0][i], out[1][i]) for h, i in at.items()}
    want = []
    for (i, _, _), (h, p) in zip(rows, hp):
        r = _rule(h, p)
        want.append((i, h, p, r[1] + r[2] if r else None, r[0] if r else by_host.get(h, "allow")))
    return want, scores


PAGES = [
    (1, "https://a.example.com/en/x?y", '<a href="http://Hub.example.org/1">1</a> <a href=//spam.example.org/>2</a>'),
    (2, "http://www.example.com/en/1#t", "<A HREF='https://good.example.org:80/q'>x</A><a href=\"/own\">y</a>"),
    (3, "http://b.example.com/de", '<a href="https://good.example.org/">1</a><a href="https://good.example.org/">2</a>'),
    (4, "http://Spam.example.org/en/1", '<a href="http://bad.example.net/es/">x</a>'),
    (5, "http://bad.example.net/es/1", '<a href="http://spam.example.org/">x</a>'),
    (6, "http://bad.example.net/en/1", None), (7, "http://hub.example.org?x=/y", '<a href="http://bad.example.net">x</a>'),
    (8, "http://good.example.org", ""), (8, "http://good.example.org", ""), (9, None, '<a href="http://x.org/">x</a>'),
    (10, "no scheme", None), (None, "http://sub.good.example.org/a", None), (12, "http://net/es/", None), (13, "://", None),
    (14, "http://notnet/es/", None), (15, "http://far.example.org/", '<a href="http://spam.example.org/">x</a>'), (16, "http:///p", "href=//"),
    (17, "http://WWW.Example.com/en/://z", "x" * 100000),
]


def test_url_filter_against_dense_rank(spark):
    df = spark.createDataFrame([(i, u, h, "z") for i, u, h in PAGES], "page_id long, url string, html string, host string").repartition(3)
    got = url_filter.judge(df).collect()
    want, scores = _plain_verdicts(PAGES)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert {"block", "allow"} == {r.verdict for r in got if r.rule is None}
    for r in got:
        if r.trust is not None:
            assert abs(r.trust - scores[r.host][0]) < 1e-3 and abs(r.distrust - scores[r.host][1]) < 1e-3
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_filter_on_the_small_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    got = url_filter.judge(spark.read.parquet(f"{small}/pages.parquet")).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(r[:3] for r in _plain_verdicts(rows)[0])
    assert sorted((r.page_id, r.verdict) for r in got) == sorted((r[0], r[4]) for r in _plain_verdicts(rows)[0])


# ── cross-tokenizer alignment ────────────────────────────────────────────────
def test_gallop_and_align_against_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(200):
        size = int(rng.integers(1, 300))
        a, b = (np.unique(np.append(rng.integers(1, size + 1, int(rng.integers(1, 60))), size)) for _ in range(2))
        rank, found = token_align.gallop(a, b)
        assert (rank == np.searchsorted(b, a)).all() and (found == np.isin(a, b)).all()
        common_a, common_b, ia, ib = token_align.align(a, b)
        assert a[common_a].tolist() == b[common_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        from_a, from_b = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(from_a[i], from_b[j]) < min(a[i], b[j])}
        assert len(ia) == len(want) and set(zip(ia.tolist(), ib.tolist())) == want
    assert token_align.gallop(np.array([1, 2]), np.zeros(0, int))[0].tolist() == [0, 0]


def _plain_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    ta = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of, token = token_align._byte_of(), {i: t for t, i in ta.get_vocab().items()}
    out, count = [], Counter()
    for doc, text in rows:
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        raw_a = [bytes(byte_of[c] for c in token[i]) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(tb.id_to_piece, b)]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            out.append((doc, [], [], "", []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        groups, links, i, j = [([], [])], [], 0, 0
        while True:  # merge of the two end lists
            links.append((a[i], b[j]))
            if ends_a[i] <= ends_b[j]:
                groups[-1][0].append(str(a[i]))
            if ends_b[j] <= ends_a[i]:
                groups[-1][1].append(str(b[j]))
            x, y = ends_a[i], ends_b[j]
            if x == y == ends_a[-1]:
                break
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append(([], []))
        count.update(links)
        out.append((doc, a, b, ";".join(",".join(g) + "|" + ",".join(h) for g, h in groups), links))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(d, len(a), len(b), g.count("|"), len(ls), sum(count[p] == best[p[1]] for p in ls), sum(count[p] for p in ls),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for d, a, b, g, ls in out]


TEXTS = [(1, None), (2, ""), (3, " "), (4, "  a  b "), (5, "a▁b"), (6, "x" * 30000), (7, "\n x\ty \n\n z"), (8, "<|endoftext|> <s>a</s> <unk>"),
         (9, "it's we'll  I'M ñandú 😀 　​ \x00 ﬁ\xa0q"), (9, "it's"), (9, "it's"), (None, "a b"), (11, "\x1c \x1d a \x85 b"),
         (12, "🏳️‍🌈 中文字 텍스트  123 45"), (13, "▁"), (14, " a ▁ b c"), (15, "one two " * 3000), (16, "a \n b"), (17, "end "), (18, "٣ ⅷ ǅ ʼn 𝒳²")]


@pytest.mark.parametrize("shard", [token_align.SHARD_PAIRS, 9])
def test_alignment_against_plain_merge(spark, shard):
    import public_tokenizers as p

    df = spark.createDataFrame([(d, t, 1) for d, t in TEXTS], "doc_id long, text string, n_a int").repartition(3)
    paths = p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")
    got = [tuple(r) for r in token_align.alignment(df, *paths, shard).collect()]
    assert sorted(got, key=str) == sorted(_plain_alignment(TEXTS), key=str)
    assert token_align.alignment(df.limit(0), *paths).count() == 0


def test_alignment_of_the_small_table(spark, small, llm_queries, small_docs):
    got = sorted(tuple(r) for r in llm_queries["op13_token_align"](spark, small).collect())
    assert got == sorted(_plain_alignment(small_docs))


def test_ranks_give_the_ids_of_the_tokenizers_library():
    """Every token's own bytes, and every letter, digit, mark and blank between words."""
    import sys
    import unicodedata

    import public_tokenizers as p

    pair = token_align.Pair(p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model"))
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts = ["".join(f" {c}a{c}1{c} -{c}" for c in chars[k:k + 50]) for k in range(0, len(chars), 50)]
    texts += [t.decode("utf-8", "ignore") for t in pair.bytes_a]
    own = [e.ids for e in pair.own_a.encode_batch(texts, add_special_tokens=False)]
    bad = [t for t, ids in zip(texts, own) if ids != pair.ids_a(t)]
    assert not bad, (len(bad), bad[:3])


def test_later_steps_hold_little_in_a_worker(spark):
    """Rows with all id pairs of their texts go to a worker in small batches, and
    what the pass over the texts kept there is freed before."""
    import public_tokenizers as p

    paths = p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")
    before = spark.conf.get(BATCH_ROWS, None)
    spark.conf.unset(BATCH_ROWS)
    try:
        docs = spark.createDataFrame([(k, f"some words {k}") for k in range(20)], "doc_id long, text string")
        assert token_align.alignment(docs, *paths).count() == 20
        assert 0 < int(spark.conf.get(BATCH_ROWS)) <= 1000
    finally:
        spark.conf.unset(BATCH_ROWS) if before is None else spark.conf.set(BATCH_ROWS, before)
    token_align._chunks(*paths)
    token_align._forget()
    assert not token_align._chunks.cache_info().currsize and not token_align._pair.cache_info().currsize
