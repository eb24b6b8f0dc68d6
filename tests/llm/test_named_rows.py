"""Rows named by id and text, verified licenses, linear folding, stable labels, and a schedule that decides the mix's order."""

import time
from collections import Counter

import numpy as np

import corpus_pipeline
from scorewright.llm import decontaminate, license_scan, mixing, ngram_join, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS)


def test_stages_name_rows_by_id_and_text(spark, tmp_path):
    """Null ids, and one id on several texts: each stage drops the rows it means, and no others."""
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(None, "same"), (None, "same"), (1, "same"), (2, "two"), (2, "two"), (2, "other"), (None, None), (None, ""), (None, "alone"), (None, "alone")]
    left = Counter(tuple(r)[:2] for r in corpus_pipeline.drop_copies(spark, table(spark, rows), SF).collect())
    none = [r for r in left if r[0] is None and not r[1]]
    assert len(none) == 1 and left.pop(none[0]) == 1
    assert left == Counter({(1, "same"): 1, (2, "two"): 1, (2, "other"): 1, (None, "alone"): 1})

    rows = [(5, long + " end"), (None, long), (7, long + " end more"), (7, "quite another text of its own"), (None, "x y z"), (8, "")]
    left = Counter(tuple(r)[:2] for r in corpus_pipeline.drop_near_copies(spark, table(spark, rows), SF).collect())
    assert left == Counter([rows[0], rows[3], rows[4], rows[5]])
    rows = [(None, long), (None, long + " end"), (None, "x y z")]
    assert len(corpus_pipeline.drop_near_copies(spark, table(spark, rows), SF).collect()) == 2
    assert ngram_join.near_copies(table(spark, rows).limit(0)).count() == 0

    item = " ".join(f"b{i}" for i in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, "a " + item), (3, item), (3, "clean"), (None, "clean too"), (None, None)]
    left = Counter(tuple(r)[:2] for r in decontaminate.decontaminate(table(spark, rows), bench).collect())
    assert left == Counter([(3, "clean"), (None, "clean too"), (None, None)])


def test_passages_are_cut_from_the_text_they_stand_in(spark):
    shared = " ".join(f"word{i * 7919 % 1000}" for i in range(120))
    clean = " ".join(f"clean{i}" for i in range(90))
    docs = table(spark, [(1, "begin " + shared), (2, shared + " tail"), (2, clean), (2, clean), (3, None), (None, shared)])
    found = substring_dedup.repeated_passages(docs)
    assert {(r.doc_id, r.removed) for r in found.collect()} == {(1, False), (2, True)}
    out = Counter(tuple(r) for r in substring_dedup.remove_passages(docs, found).collect())
    assert out[2, clean] == 2 and out[1, "begin " + shared] == 1 and out[3, None] == 1 and out[None, shared] == 1
    cut = next(t for d, t in out if d == 2 and t != clean)
    assert "tail" in cut and len(cut) < len(shared) / 2


def test_license_stands_in_order(spark):
    notice = license_scan.NOTICES["mit"].split()
    pieces = " ".join(" ".join(notice[i:i + 5]) for i in range(0, len(notice) - 4, 2))
    dropped = " ".join(w for i, w in enumerate(notice) if i % 20)
    docs = spark.createDataFrame([(1, "x " + " ".join(notice)), (2, pieces), (3, " ".join(reversed(notice))), (4, dropped), (5, " ".join(notice[30:] + notice[:30])),
                                  (6, " filler text ".join(notice)), (7, " ".join(notice) + " y " + pieces)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs).collect()}
    assert got[1] == got[7] == ("mit", 1.0) and got[4][0] == "mit" and 0.6 <= got[4][1] < 1
    assert all(got[i] == ("", 0.0) for i in (2, 3, 6))
    assert license_scan.best_chain([(10, p) for p in range(20)]) == (20, 10, 29 + license_scan.K)


def test_folding_takes_linear_time():
    assert toxicity.fold("c4t! @b!e wow!!! 123 i$ l33t! a!b ! @") == ["cat", "abie", "wow", "is", "leet", "aib"]
    for sign in "!@a1":
        begin = time.time()
        toxicity.fold(sign * 1_000_000 + " " + f"x{sign}" * 300_000)
        assert time.time() - begin < 5


def test_labels_of_both_kinds_are_toxic_in_any_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    labels = labels.unionByName(labels.withColumn("toxic", 1 - labels.toxic).filter("doc_id % 3 = 0"))
    fits = [toxicity.learn(d, x) for d, x in ((docs, labels), (docs.orderBy("text"), labels.orderBy("toxic")), (docs.repartition(5), labels.orderBy(labels.toxic.desc())))]
    assert fits[0].weights == fits[1].weights == fits[2].weights and fits[0].fit == fits[1].fit == fits[2].fit


def test_schedule_decides_the_order_of_the_mix(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert ((got.first_slot >= 0) == (got.taken > 0)).all()
    # in the order of first slots every stretch holds each source about in proportion (a long document comes at once)
    got = got[got.taken > 0].sort_values("first_slot")
    share = got.groupby("source").target.first() / got.groupby("source").target.first().sum()
    seen = got.pivot_table(index="first_slot", columns="source", values="taken", aggfunc="sum", fill_value=0).cumsum()
    off = (seen.sub(np.outer(seen.sum(1), share[seen.columns]))).abs().max()
    assert (off <= 2.5 * got["size"].max() + 10 * mixing.BLOCK_WORDS).all()
    # other points, another order, the same words
    before = mixing.mix(docs).collect()
    monkeypatch.setattr(mixing, "GOLDEN", 12345)
    after = mixing.mix(docs).collect()
    assert {(r.doc_id, r.taken) for r in before} == {(r.doc_id, r.taken) for r in after}
    assert {(r.doc_id, r.first_slot) for r in before} != {(r.doc_id, r.first_slot) for r in after}
