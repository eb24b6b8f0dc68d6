"""Fixture P: deterministic model scores, identical in Spark and DuckDB, no training.

score(model, seed, id) = 0.7 * md5-unit('model:seed:id') + 0.3 * truth, where truth is
the customer's label (c_acctbal < 0). The tie variant truncates to two decimals
(``floor(100 s) / 100``, exact in both engines), which creates many tied scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.functions.hashing import unit_score
from scorewright.sources.fixtures import KEY, customer_truth, statement_keys

# The model families and the seeds averaged by the reference's ensemble.
MODELS = ("lgbm", "cb", "xgb")
SEEDS = (42, 52, 62)
AGG_MODELS = tuple(f"{m}_{a}" for m in MODELS for a in ("last", "mean", "max", "min"))


def _score(model: F.Column, seed: F.Column, id_col: str, truth: str = "truth", ties: bool = False) -> F.Column:
    s = unit_score(model, seed, id_col) * F.lit(0.7) + F.lit(0.3) * F.col(truth)
    return F.floor(s * F.lit(100.0)) / F.lit(100.0) if ties else s


def prediction_long(spark: SparkSession, sf_dir: str, split: str = "oof", models=MODELS, seeds=SEEDS,
                    ties: bool = False) -> DataFrame:
    """Long prediction table ``(customer_id, [target], model, seed, prediction)``.

    ``split='oof'``: training customers with their target; ``'sub'``: test customers.
    The (model, seed) grid is a fixed literal list, so the fan-out is a constant factor."""
    t = customer_truth(spark, sf_dir)
    base = t.where(~F.col("is_test")) if split == "oof" else t.where(F.col("is_test"))
    grid = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(int(s)).alias("seed"))
                               for m in models for s in seeds])).alias("g")
    d = base.select(KEY, "truth", grid).select(KEY, "truth", "g.model", "g.seed")
    d = d.withColumn("prediction", _score(F.col("model"), F.col("seed"), KEY, ties=ties))
    cols = [KEY] + (["target"] if split == "oof" else []) + ["model", "seed", "prediction"]
    return d.withColumn("target", F.col("truth")).select(*cols)


def external_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third-party ``(customer_id, prediction)`` table over the test customers."""
    t = customer_truth(spark, sf_dir).where(F.col("is_test"))
    return t.select(KEY, _score(F.lit("ext"), F.lit(0), KEY).alias("prediction"))


def fold_scores(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """Per-fold test predictions ``(customer_id, fold, prediction)`` (input of D17)."""
    t = customer_truth(spark, sf_dir).where(F.col("is_test"))
    d = t.select(KEY, "truth", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    return d.select(KEY, "fold", _score(F.lit("fold"), F.col("fold"), KEY).alias("prediction"))


def statement_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement-level scores ``pred_no_agg`` (what the statement model's OOF/test output
    looks like), carrying the statement order columns."""
    s = statement_keys(spark, sf_dir)
    t = customer_truth(spark, sf_dir).select(KEY, "truth")
    d = s.join(t, on=KEY, how="left").withColumn("truth", F.coalesce(F.col("truth"), F.lit(0)))
    return d.select(KEY, "seq", "ts_us", _score(F.lit("stmt"), F.lit(0), "seq").alias("pred_no_agg"))
