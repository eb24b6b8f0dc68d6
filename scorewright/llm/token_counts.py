"""Token counts of a corpus as one exact histogram of encoded lengths.

Documents are encoded once with a public tokenizer; the result is aggregated by length, and suffix sums
over the histogram answer totals, quantiles and truncated totals for every context limit without another pass
over the texts."""

from __future__ import annotations

import base64
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm import common as C

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Lengths of one bucket of the suffix sums.
SPAN = 1024
#: How text is cut before the merges (fixed with the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[bytes, object] = {}


def vocabulary(path: str = TOKENIZERS, name: str = VOCABULARY) -> bytes:
    """The vocabulary file, read on the driver; some hundred KB that go to the tasks."""
    return (Path(path) / name).read_bytes()


def _encoder(file: bytes):
    import tiktoken

    if file not in _ENCODERS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}
        _ENCODERS[file] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[file]


def _lengths(sent):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        encode = _encoder(sent.value).encode_ordinary
        for batch in batches:
            for rows, texts in C.slices(batch, "text"):
                yield pa.record_batch([rows.column(0).cast(pa.int64()), pa.array([len(encode(t.decode())) if t else 0 for t in texts], pa.int64())], schema=schema)

    return run


def encoded_lengths(docs: DataFrame, file: bytes | None = None) -> DataFrame:
    """``doc_id, n_tokens`` of each whole text (null and empty: 0)."""
    docs = C.narrow(docs, "doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(file or vocabulary())
    return docs.mapInArrow(_lengths(sent), "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """One row for each encoded length that occurs: ``n_tokens, n_docs`` and, over all documents,
    ``docs_longer`` (with more tokens), ``tokens_longer`` (their tokens), ``docs_upto`` (with at most so
    many) and ``truncated_total`` (tokens when each document is cut at ``n_tokens``). Suffix sums are
    taken in buckets of ``SPAN`` lengths and then over the buckets. An empty table gives no rows."""
    counts = C.materialize(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))).withColumn("bucket", F.floor(F.col("n_tokens") / SPAN))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = (counts.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
              .select("bucket", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t")))
    inside = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = (counts.withColumn("di", F.coalesce(F.sum("n_docs").over(inside), F.lit(0)))
              .withColumn("ti", F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside), F.lit(0))).join(totals, "bucket"))
    everything = counts.agg(F.sum("n_docs").alias("all_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("all_tokens")).first()
    docs_longer, tokens_longer = F.col("di") + F.col("d"), F.col("ti") + F.col("t")
    return longer.select(
        "n_tokens", "n_docs", docs_longer.alias("docs_longer"), tokens_longer.alias("tokens_longer"),
        (F.lit(everything[0] or 0) - docs_longer).cast("long").alias("docs_upto"),
        (F.lit(everything[1] or 0) - tokens_longer + docs_longer * F.col("n_tokens")).cast("long").alias("truncated_total"))


def total(hist: DataFrame) -> int:
    return hist.agg(F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")), F.lit(0))).first()[0]


def truncated_total(hist: DataFrame, limit: int) -> int:
    """Tokens that are left when every document is cut at ``limit`` tokens (any limit)."""
    row = hist.filter(F.col("n_tokens") <= limit).agg(F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")), F.lit(0))).first()
    return row[0] + limit * (hist.filter(F.col("n_tokens") > limit).agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0])


def quantile(hist: DataFrame, q: float) -> int | None:
    """Smallest length that at least a part ``q`` of the documents does not exceed (None without documents)."""
    n = hist.agg(F.sum("n_docs")).first()[0]
    return None if not n else hist.filter(F.col("docs_upto") >= q * n).agg(F.min("n_tokens")).first()[0]
