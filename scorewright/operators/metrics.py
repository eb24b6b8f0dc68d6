"""Evaluation metrics as distributed aggregates.

The competition metric is ``0.5 * (G + D)``:

* rows are ordered by score descending; ties are broken by id ascending (the reference's
  unstable sort makes ties order-dependent; this order is documented and reproducible);
* negatives weigh 20, positives 1; ``W = P + 20 N``;
* ``D``: share of positives among the rows whose running weight ``cw`` is within 4% of
  ``W``, i.e. ``cw <= int(0.04 W)``, evaluated exactly as ``25 * cw <= W``;
* ``G``: ``(sum(cp * w) / P - sum(cw * w) / W) / G_max`` with ``cp`` the running positive
  count. ``sum(cw * w) = (W^2 + P + 400 N) / 2`` does not depend on the order, so one
  ordered pass gives the only order-dependent term; all sums are exact integers.
  ``G_max`` is the same quantity for the perfect order (positives first); it equals the
  closed form ``10 N (P + 20 N - 19) / W`` used by the vectorised variant.

The running sums come from the skew-safe ordered scan, so no global sort runs in one
task; per-partition totals (folds, models, candidates) are a small, size-checked
broadcast.
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, functions as F

from scorewright.operators.joins import checked_small
from scorewright.operators.ordered import ordered_scan
from scorewright.session import cut_lineage

LOGLOSS_EPS = 1e-15


def _attach(df: DataFrame, totals: DataFrame, pk: list[str]) -> DataFrame:
    """Per-partition totals onto the rows: scalars when there is no partition (one row),
    else a join on the partition keys, broadcast only when the counted table is small."""
    if not pk:
        row = totals.first()
        return df.withColumns({c: F.lit(row[c]).cast("long") for c in totals.columns})
    totals, small = checked_small(totals, materialize=False)
    return df.join(F.broadcast(totals) if small else totals, on=pk, how="inner")


def metric_components(df: DataFrame, label: str = "target", score: str = "prediction", id_col: str = "customer_id",
                      partition_by: list[str] = (), threshold: str = "int") -> DataFrame:
    """Per partition: ``P``, ``N``, ``S1 = sum(cp * w)`` and ``captured`` positives.

    ``threshold='int'`` is the ``cw <= int(0.04 W)`` cut (exact integer test);
    ``threshold='normalised'`` is the ``cw / W <= 0.04`` cut of the vectorised variant.
    Rows with a missing label or score are ignored.
    """
    pk = list(partition_by)
    y = F.col(label).cast("long")
    d = (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
         .select(*pk, id_col, y.alias("_y"), (-F.col(score).cast("double")).alias("_neg"),
                 F.when(y == 0, F.lit(20)).otherwise(F.lit(1)).cast("long").alias("_w")))
    # narrow (partition, id, label, score, weight) rows, written once and read by the bucket
    # planning, the totals and the scan instead of recomputing the upstream plan three times
    d = cut_lineage(d)
    scanned = ordered_scan(d, pk, ["_neg", id_col], sums={"_cp": F.col("_y"), "_cw": F.col("_w")})
    totals = d.groupBy(*pk).agg(F.sum("_y").alias("P"), F.sum(F.lit(1) - F.col("_y")).alias("N"))
    j = _attach(scanned, totals, pk)
    w_total = F.col("P") + F.lit(20) * F.col("N")
    if threshold == "int":
        inside = F.col("_cw") * F.lit(25) <= w_total
    else:
        inside = F.try_divide(F.col("_cw"), w_total) <= F.lit(0.04)
    return j.groupBy(*pk, "P", "N").agg(
        F.sum(F.col("_cp").cast("decimal(28,0)") * F.col("_w").cast("decimal(3,0)")).alias("S1"),
        F.sum(F.when(inside, F.col("_y")).otherwise(F.lit(0))).alias("captured"))


def _scores(comp: DataFrame, gmax: str) -> dict[str, Column]:
    """Gini, capture and their mean. Divisions use ``try_divide``: a partition without
    positives or negatives has no metric (NULL) instead of failing the job under ANSI mode."""
    # squares of the total weight leave 64 bits at about 150 M rows: exact decimals up to the division
    P, N, S1 = F.col("P").cast("decimal(18,0)"), F.col("N").cast("decimal(18,0)"), F.col("S1")

    def div(a, b):
        return F.try_divide(a.cast("double"), b.cast("double"))

    W = (P + F.lit(20) * N).cast("decimal(19,0)")
    Q = div(W * W + P + F.lit(400) * N, F.lit(2.0))
    g_pred = div(S1, P) - div(Q, W)
    if gmax == "perfect":
        g_max = div(div(P * (P + F.lit(1)), F.lit(2.0)) + (F.lit(20) * N * P).cast("double"), P) - div(Q, W)
    else:
        g_max = div(F.lit(10) * N * (P + F.lit(20) * N - F.lit(19)), W)
    gini = div(g_pred, g_max)
    capture = div(F.col("captured"), P)
    return {"gini": gini, "capture": capture, "metric": F.lit(0.5) * (gini + capture)}


def combined_metric(df: DataFrame, label: str = "target", score: str = "prediction", id_col: str = "customer_id",
                    partition_by: list[str] = (), variant: str = "mod") -> DataFrame:
    """One row per partition: ``gini``, ``capture`` and ``metric`` (E7 ``variant='mod'``:
    int cut, perfect-order denominator; E8 ``variant='np'``: normalised cut, closed form)."""
    comp = metric_components(df, label, score, id_col, partition_by,
                             threshold="int" if variant == "mod" else "normalised")
    s = _scores(comp, "perfect" if variant == "mod" else "closed")
    return comp.select(*partition_by, *[v.alias(k) for k, v in s.items()])


def logloss(df: DataFrame, label: str = "target", score: str = "prediction", partition_by: list[str] = (),
            eps: float = LOGLOSS_EPS) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    term = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    d = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return d.groupBy(*partition_by).agg(F.avg(term).alias("logloss"))


def roc_points(df: DataFrame, label: str = "target", score: str = "prediction", partition_by: list[str] = ()) -> DataFrame:
    """One point per distinct score and partition: true/false positive rates of ``score >= threshold``
    (I20). Ties collapse before the ordered scan; the picture itself is not drawn."""
    pk = list(partition_by)
    y = F.col(label).cast("long")
    d = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = d.groupBy(*pk, F.col(score).alias("threshold")).agg(F.sum(y).alias("_pos"), F.sum(F.lit(1) - y).alias("_neg"))
    g = g.withColumn("_ord", -F.col("threshold"))
    s = ordered_scan(g, pk, ["_ord"], sums={"_tp": F.col("_pos"), "_fp": F.col("_neg")})
    totals = d.groupBy(*pk).agg(F.sum(y).alias("P"), F.sum(F.lit(1) - y).alias("N"))
    j = _attach(s, totals, pk)
    return j.select(*pk, "threshold", F.try_divide(F.col("_tp"), F.col("P")).alias("tpr"),
                    F.try_divide(F.col("_fp"), F.col("N")).alias("fpr"))


class CompetitionEvaluator(Evaluator):
    """Spark ML evaluator for the combined metric (J1-J3): larger is better. Reads the
    positive-class probability from a ``probability`` vector column or a score column."""

    def __init__(self, labelCol: str = "label", scoreCol: str = "probability", idCol: str = "customer_id",
                 variant: str = "mod"):
        super().__init__()
        self.labelCol, self.scoreCol, self.idCol, self.variant = labelCol, scoreCol, idCol, variant

    def _evaluate(self, dataset: DataFrame) -> float:
        from pyspark.ml.functions import vector_to_array
        sc = dataset.schema[self.scoreCol].dataType.typeName()
        s = vector_to_array(F.col(self.scoreCol))[1] if sc == "vectorudt" else F.col(self.scoreCol)
        d = dataset.select(F.col(self.idCol), F.col(self.labelCol).alias("_lab"), s.alias("_score"))
        row = combined_metric(d, "_lab", "_score", self.idCol, variant=self.variant).first()
        return float(row["metric"])

    def isLargerBetter(self) -> bool:
        return True
