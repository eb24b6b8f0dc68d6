"""The corpus pipeline: toxicity, exact deduplication, near-duplicate join, benchmark decontamination
and mixing, each on what the stage before it kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read back as
the next stage's ``docs``. The first four return the columns of ``documents``; the last one the mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import common as C
from scorewright.llm import decontaminate, exact_dedup, mixing, ngram_join, toxicity

#: No SQL: the toxicity stage learns a lexicon. Tests hold the rows against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labelled rows in ``docs``, does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, C.table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id. Half of the ids (by a hash) are the history. Rows that repeat
    a doc_id and its text are one document; one of them stays, also of a group without any id."""
    before = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, F.lit(False))
    found = C.materialize(exact_dedup.exact_dedup(docs.filter(before), docs.filter(~before)).select("doc_id", "mark", "kept", "group_size", "text_sha256"))
    left = C.drop_rows(docs, found.filter("not kept").select("doc_id", "mark"))
    again = found.filter("kept and group_size > 1").groupBy("doc_id", "text_sha256").agg(F.collect_set("mark").alias("marks"), F.count("*").alias("n"))
    twice = C.materialize(again.filter("n > 1").select("doc_id", F.explode("marks").alias("mark")))
    if not twice.limit(1).count():
        return left
    one = C.only_rows(left, twice).withColumn("_same", F.coalesce("text", F.lit(""))).dropDuplicates(["doc_id", "_same"])
    return C.drop_rows(left, twice).unionByName(one.select(*left.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (five-word shingles, similarity 0.8) the one with the smallest doc_id."""
    return C.drop_rows(docs, C.materialize(ngram_join.near_copies(docs, k=5, percent=80)))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.decontaminate(docs, C.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document that is left."""
    return mixing.mix(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies),
          ("decontaminate", drop_contaminated), ("mixing", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is a written table in the shared folder."""
    docs = C.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = C.materialize(stage(spark, docs, sf_dir))
    return docs
