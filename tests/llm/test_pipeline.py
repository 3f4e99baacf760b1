"""The pipeline, stage by stage, against plain versions of each decision."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
import sentencepiece
from test_jaccard import brute

from sessionlake.llm import language_id, mixing
from sessionlake.llm.common import cut
from sessionlake.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def test_stages_on_the_smallest_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][1:3] == ["exact dedup", "n-gram Jaccard join"]
    rows = {"start": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, small))
        rows[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    start, lang, exact, near, mixed, tokens = rows.values()
    assert {r.doc_id for r in lang} == {r.doc_id for r in start if language_id.has_letter(r.text)}
    best = {}
    for r in lang:
        best[low(r.text)] = max(best.get(low(r.text), r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(best.values())
    groups = brute([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == sorted({c if n else i for i, (n, c) in groups.items()})
    assert max(Counter(r.doc_id for r in mixed).values()) == 1 and {r.doc_id for r in mixed} <= {r.doc_id for r in near}
    good = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    ids = {r.doc_id for r in mixed}
    clean = [r.doc_id for r in near if r.doc_id in good]
    assert sum(i in ids for i in clean) >= 0.98 * len(clean)
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {r.doc_id: r.text for r in mixed}
    assert sorted(r.doc_id for r in tokens) == sorted(texts)
    for r in tokens:
        want = sp.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == sha(" ".join(map(str, want))) and r.decoded_sha256 == sha(sp.decode(want))


def test_stages_take_empty_and_odd_tables(spark, small, edge, nothing):
    assert mixing.WEIGHTS
    for docs in (nothing.drop("spans", "kept"), edge.drop("spans", "kept")):
        for _, stage in corpus_pipeline.STAGES:
            docs = cut(stage(spark, docs, small))
        assert docs.columns[:3] == ["doc_id", "lang", "source"]
