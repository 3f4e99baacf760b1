"""Dedup, quality rules and tokenising against brute-force versions."""

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from sessionlake.llm import exact_dedup, line_dedup, piece_bpe, quality_rules as q
from sessionlake.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if tri[w[i], w[i + 1], w[i + 2]] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed)


def line_passes(x):
    w = WORD.findall(x)
    tail = x.strip(BLANKS)[-3:]
    low_x = x.lower()
    return bool(re.search(r"[.!?…。！？;:][\"'»”’)\]]*$", tail)) \
        and 100 * len(re.findall(r"!!|[#*$%&<>]{2}[#*$%&<>]*", x)) <= q.MAX_DECORATED * len(w) \
        and not ((n := len(re.findall(r"[\x20\t][|»›·•→][\x20\t]", x))) >= 2 and 100 * n >= q.MIN_SEPARATORS * len(w)) \
        and not any(p in low_x for p in q.BOILERPLATE) and not (len(w) >= 5 and 4 * len(set(w)) < len(w))


def verdict(text):
    lines = list(dict.fromkeys(x for x in (text or "").split("\n") if WORD.search(x)))
    left = sum(len(WORD.findall(x)) for x in lines if line_passes(x))
    b = base(text)
    return not b[5] and 100 * left >= q.MIN_LEFT * b[0]


def test_quality_query_matches_brute_force(spark, small, llm_queries, small_docs):
    got = {r.doc_id: r for r in llm_queries["op5_quality_rules"](spark, small).collect()}
    assert len(got) == len(small_docs)
    for i, text in small_docs:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text), i
        assert r.kept == verdict(text), i
    assert {r.kept for r in got.values()} == {True, False}


def test_quality_edge_cases(spark, edge, nothing):
    assert q.digest(nothing).count() == 0 and q.clean(nothing).columns == nothing.columns
    for r in q.measures(edge).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)
    good = "\n".join(" ".join(f"w{i}x{k}" for k in range(9)) + "." for i in range(20))
    docs = spark.createDataFrame([(1, "Home | About | News | Shop | Contact\n" + good, 5), (2, "a b c", 6), (1, None, 7)],
                                 "doc_id long, text string, words int")
    assert [tuple(r) for r in q.clean(docs).collect()] == [(1, good, 5)]


def test_exact_dedup(spark, edge, nothing):
    rows = [(r.doc_id, low(r.text or "")) for r in edge.collect()]
    got = exact_dedup.decisions(edge).collect()
    assert len(got) == len(rows)
    best = {}
    for i, t in rows:
        best[t] = max((x for x in (best.get(t), i) if x is not None), default=None)
    n = Counter(t for _, t in rows)
    by_sha = {sha(t): t for t in n}
    for r in got:
        t = by_sha[r.text_sha256]
        assert (r.keep_id, r.group_size) == (best[t], n[t])
    assert Counter(r.text_sha256 for r in got if r.kept) == {sha(t): 1 for t in n}
    kept = exact_dedup.dedup(edge)
    assert kept.columns == edge.columns
    assert sorted(low(r.text or "") for r in kept.collect()) == sorted(n)
    assert exact_dedup.decisions(nothing).count() == exact_dedup.dedup(nothing).count() == 0


def test_one_text_in_a_third_of_all_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Same TEXT', concat('text ', id)) AS text")
    kept = exact_dedup.decisions(docs).filter("kept")
    assert kept.count() == 2001 and kept.filter("group_size = 1000").first().doc_id == 2997


def brute_lines(rows):
    """Text left of each row, in the order of the rows."""
    seen, out = {}, []
    parts = [None if t is None else [(x, x.strip(BLANKS)) for x in t.split("\n")] for _, t in rows]
    order = sorted({(r[0] is not None, r[0], r[1]) for r in rows if r[1] is not None}, key=lambda k: (k[0], k[1] or 0))
    for _, i, t in order:
        w = [x for _, x in [(x, x.strip(BLANKS)) for x in t.split("\n")] if x]
        for at in range(len(w) - 2):
            seen.setdefault(tuple(w[at:at + 3]), (i, t, at))
    for (i, t), p in zip(rows, parts):
        if t is None:
            out.append((None, 0, 0))
            continue
        w = [k for k, (_, x) in enumerate(p) if x]
        gone = set()
        for at in range(len(w) - 2):
            if seen[tuple(p[w[at + k]][1] for k in range(3))] != (i, t, at):
                gone |= {w[at], w[at + 1], w[at + 2]}
        out.append(("\n".join(x for k, (x, _) in enumerate(p) if k not in gone), len(w), len(gone)))
    return out


def test_line_dedup(spark, edge, nothing):
    rows = [(1, "a\nb\nc\nd"), (2, "x\n\n a \nb\nc\t\ny"), (3, "p\nq"), (4, "p\nq"), (5, "z\nz\nz\nz\nz"), (6, "b\nc\nd\na\nb\nc"),
            (7, None), (8, ""), (None, "k\nl\nm"), (9, "k\nl\nm")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n_lines int")
    out = line_dedup.dedup_lines(docs)
    assert sorted(out.columns) == ["doc_id", "n_lines", "n_removed", "text"]
    key = lambda r: (r[0] is not None, r[0] or 0)
    got = sorted([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()], key=key)
    want = sorted([(i, *w) for (i, _), w in zip(rows, brute_lines(rows))], key=key)
    assert got == want
    assert line_dedup.dedup_lines(nothing).count() == 0
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert Counter(r.text for r in line_dedup.dedup_lines(edge).collect()) == Counter(w[0] for w in brute_lines(rows))


def test_tokeniser_matches_library(spark, small, llm_queries, small_docs, edge, nothing):
    v = piece_bpe.Vocabulary(tokenizer_path())

    def want(text):
        ids = v.library.encode(text or "", add_eos=True)
        return len(ids), sha(" ".join(map(str, ids))), sha(v.library.decode(ids))

    got = {r[0]: tuple(r[1:]) for r in llm_queries["op10_sentencepiece"](spark, small).collect()}
    assert got == {i: want(t) for i, t in small_docs}
    rows = piece_bpe.decode(piece_bpe.encode(edge, tokenizer_path(), ids_col="kept"), tokenizer_path(), ids_col="kept", text_col="spans")
    assert sorted(rows.columns) == sorted(edge.columns)
    for r in rows.collect():
        assert r.kept == v.library.encode(r.text or "", add_eos=True) and r.spans == v.library.decode(r.kept)
    assert piece_bpe.digest(nothing, tokenizer_path()).count() == 0


def test_one_pass_equals_encode_then_decode(spark, edge, nothing):
    model = tokenizer_path()
    for docs in (edge, nothing, edge.withColumn("IDS", F.lit(1))):
        want = piece_bpe.decode(piece_bpe.encode(docs, model), model).drop("text")
        got = piece_bpe.encode_decode(docs, model)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tokeniser_on_awkward_texts():
    v = piece_bpe.Vocabulary(tokenizer_path())
    texts = ["", " ", "  a  b ", "\n", "\n\n x\n  y", "a\0b", "<s> </s> <unk> <0x41>", "▁a ▁ b", "é́", "A​B", "😀 x",
             "\t\tq", "　x", "ﬁ①", " " * 40 + "x" + " " * 33, "ab" * 500, "\r\n", "…—“x”", "日本語 テスト", "\U0010ffff�﻿", "xy z"]
    assert v.encode(texts) == v.library.encode(texts, add_eos=True)
    for t in texts:
        ids = v.encode([t])[0]
        assert v.decode(ids) == v.library.decode(ids)
    for ids in ([2], [1, 264, 2], [241, 131, 2], [28705, 241, 264], [0, 264], [264, 0, 2], [13, 264], [1, 1, 259, 2]):
        assert v.decode(ids) == v.library.decode(ids)
    for c in ("▁the", "▁unbelievable", "abcabcabc", "▁▁▁"):
        assert v.merge(c) == v.merge_all([c])[0]


def test_a_full_cache_is_handed_on_as_it_is(monkeypatch):
    """The older generation is the same table, not a copy, without chunks too long to keep, and gives the same ids."""
    import public_tokenizers

    from sessionlake.llm import piece_bpe

    monkeypatch.setattr(piece_bpe, "CACHE_CHUNKS", 3)
    v = piece_bpe.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["one two three four " + "x" * 60, "two new", "one " + "x" * 60 + " ñ😀 two", ""]
    first = v.index
    got = [v.encode([texts[0]])[0]]
    assert v.older is first and not any(len(c) > piece_bpe.CACHE_CHARS for c in first)
    got += v.encode(texts[1:])
    assert got == [v.library.encode(t, add_eos=True) for t in texts]
    assert not hasattr(v, "chunk_texts")
