"""Stacking (I10, E2, D13, C3, D17): statement-model scores become customer features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scorewright.operators.aggregate import SCORE_AGGS, aggregate_history
from scorewright.operators.history import order_history


def score_diff(scores: DataFrame, key: str = "customer_id", score: str = "pred_no_agg",
               order: tuple[str, ...] = ("ts_us", "seq")) -> DataFrame:
    """Add ``<score>_diff`` = score minus the customer's previous score (E2). The scored table
    carries the statement order, so the difference never depends on file order."""
    return order_history(scores, key=key, order=order, days_diff=None,
                         diffs={f"{score}_diff": F.col(score)})


def score_features(scores: DataFrame, key: str = "customer_id", score: str = "pred_no_agg",
                   aggs: tuple[str, ...] = SCORE_AGGS) -> DataFrame:
    """Customer-level aggregates of the score and its difference."""
    d = score_diff(scores, key, score)
    return aggregate_history(d, key, "rn", [score, f"{score}_diff"], [], num_aggs=aggs)


def stack_onto(features: DataFrame, score_feats: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customer features ⟕ score features (C3); both are keyed 1:1 by customer."""
    return features.join(score_feats, on=key, how="left")


def fold_average(fold_preds: DataFrame, key: str = "customer_id", score: str = "prediction") -> DataFrame:
    """Test prediction = mean over the fold models."""
    return fold_preds.groupBy(key).agg(F.avg(score).alias(score))
