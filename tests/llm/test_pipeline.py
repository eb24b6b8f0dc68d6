"""The corpus pipeline against a plain version of each of its stages."""

import corpus_pipeline
from scorewright.llm import toxicity
from tests.llm.test_operators import brute_components, words

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs, labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = toxicity.learn(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    x = [model.features(t) for _, t in rows]
    import numpy as np
    kept = [r for r, s in zip(rows, model.scores(np.array(x, float)), strict=True) if s < 0.5]
    best = {}
    for d, t in kept:
        best[t or ""] = max(d, best.get(t or "", d))
    kept = [(d, t) for d, t in kept if best[t or ""] == d]
    group = {d: c for d, _, c in brute_components(kept, 5, 80)}
    kept = [(d, t) for d, t in kept if group[d] == d]
    windows = {tuple(words(r.text)[i:i + 10]) for r in benchmark.collect() for i in range(max(1, len(words(r.text)) - 9))}
    kept = [(d, t) for d, t in kept if not any(tuple(words(t)[i:i + 10]) in windows for i in range(len(words(t))))]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in kept)
    size = sum(r["size"] for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * size) < 30 and all(r.taken <= 2 * r["size"] for r in got)


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
