"""Normalised average rank (E3): ``rank(method='average') / n`` per partition.

Ties share the mean of their positions, a missing score keeps a missing rank, and ``n``
counts every row of the partition, missing scores included.

Plan: collapse rows to distinct ``(partition, score)`` with counts (partial aggregation, so
a score shared by a third of all rows is one row after the map side), run the skew-safe
ordered scan over the distinct scores for the running count, and join the ranks back on
``(partition, score)``; a hot score on the big side is split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scorewright.operators.joins import BROADCAST_ROW_LIMIT, checked_small
from scorewright.operators.ordered import ordered_scan
from scorewright.session import cut_lineage


def score_ranks(df: DataFrame, score: str, partition_by: list[str] = ()) -> tuple[DataFrame, int]:
    """Distinct ``(partition..., score)`` with ``avg_rank`` (a multiple of 0.5, exact in
    floating point) and ``n`` (rows in the partition, missing scores included), and the
    number of those distinct rows (counted on the materialised table)."""
    pk = list(partition_by)
    # distinct scores with their counts (the NULL score is its own group), written once: the
    # bucket planning, the totals and the scan read this narrow table, not the upstream plan
    counts = cut_lineage(df.groupBy(*pk, score).agg(F.count(F.lit(1)).alias("_c")))
    valid = counts.where(F.col(score).isNotNull())
    n_distinct = valid.count()
    scanned = ordered_scan(valid, pk, [score], sums={"_cum": F.col("_c")}, n_rows=n_distinct)
    ranks = scanned.select(*pk, score, (F.col("_cum") - (F.col("_c") - F.lit(1)) / F.lit(2.0)).alias("avg_rank"))
    totals = counts.groupBy(*pk).agg(F.sum("_c").alias("n"))
    if pk:
        totals, small = checked_small(totals, materialize=False)
        return ranks.join(F.broadcast(totals) if small else totals, on=pk, how="left"), n_distinct
    # no partition: the total is one number, read from the materialised counts
    n = totals.first()["n"]
    return ranks.withColumn("n", F.lit(n).cast("long")), n_distinct


def rank_normalize(df: DataFrame, score: str, partition_by: list[str] = (), out: str = "rank_norm",
                   avg_rank: str | None = None, broadcast_limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Add ``out`` = average rank / n (and optionally the raw average rank).

    The ranks are joined back on ``(partition, score)``. When the number of distinct scores
    is within ``broadcast_limit`` (counted on the materialised distinct-score table) the
    rank table is broadcast and the input is never shuffled; otherwise both sides are
    shuffled and a hot score is split by AQE's skew join."""
    pk = list(partition_by)
    r, n_distinct = score_ranks(df, score, pk)
    sel = [*pk, score, (F.col("avg_rank") / F.col("n")).alias(out)]
    if avg_rank:
        sel.append(F.col("avg_rank").alias(avg_rank))
    r = r.select(*sel)
    small = n_distinct <= broadcast_limit
    return df.join(F.broadcast(r) if small else r, on=[*pk, score], how="left")
