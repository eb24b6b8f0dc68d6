"""Feature-build plans: statement level (the reference's step 001) and customer level (002-006)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.operators.aggregate import (CATEGORICAL_AGGS, NUMERIC_AGGS, add_diff_features,
                                             aggregate_history)
from scorewright.operators.dates import DATE_FEATURES, add_date_features
from scorewright.operators.encode import apply_target_encoding, fit_target_encoding_by_key
from scorewright.operators.history import order_history
from scorewright.operators.joins import spine_join
from scorewright.session import cut_lineage
from scorewright.sources.fixtures import (KEY, STATEMENT_CATEGORICAL, STATEMENT_MEASURES, spine, statements,
                                          train_labels)

TE_SOURCE = STATEMENT_CATEGORICAL + ["day", "month", "year"]
TE_COLS = [f"{c}_te" for c in TE_SOURCE]
NUM_COLS = STATEMENT_MEASURES + ["days_diff"] + DATE_FEATURES + TE_COLS
CAT_COLS = list(STATEMENT_CATEGORICAL)


def statement_features(spark: SparkSession, sf_dir: str, fit_filter=None, with_target: bool = True,
                       **scan_kw) -> DataFrame:
    """Statements with date features, target-encoded categoricals, history position ``rn``,
    ``days_diff`` and (``with_target``) the customer's ``target`` (NULL for test customers).

    Plan: the encoding maps are fitted from a narrow projection pre-aggregated per
    (customer, category) before it meets the customer labels, materialised once and
    broadcast after a size check; applying them needs no shuffle. The ordered scan by
    customer (skew-safe buckets) is the only shuffle of the wide statement rows; the customer
    aggregate reuses its key partitioning, and the customer labels are joined inside it
    (``ordered_scan(attach=...)``), so the wide rows are not shuffled again."""
    # the roll-up of the lines and its join are one job: row counts, bucket samples, encodings and code ranges read its rows
    base = add_date_features(cut_lineage(statements(spark, sf_dir)))
    labels = train_labels(spark, sf_dir)
    fit_rows = base.where(~F.col("is_test"))
    if fit_filter is not None:
        fit_rows = fit_rows.where(fit_filter)
    enc = fit_target_encoding_by_key(fit_rows, labels, TE_SOURCE, KEY)
    # the labels join inside the scan's (bucket, customer) partitioning: no second wide shuffle
    # and the encodings join after it, so that the scan neither moves them nor repeats their joins
    return apply_target_encoding(order_history(base, attach=labels if with_target else None, **scan_kw), enc, TE_SOURCE)


def customer_features(spark: SparkSession, sf_dir: str, num_aggs=NUMERIC_AGGS, cat_aggs=CATEGORICAL_AGGS,
                      diffs: bool = True, statements_df: DataFrame | None = None,
                      **scan_kw) -> DataFrame:
    """One row per label-spine customer (train: with target; test: without), is_test flag,
    ``<col>_<agg>`` for the numeric and categorical bundles, plus difference features."""
    s = statements_df if statements_df is not None else \
        statement_features(spark, sf_dir, with_target=False, **scan_kw)
    feats = aggregate_history(s, KEY, "rn", NUM_COLS, CAT_COLS if cat_aggs else [], num_aggs,
                              cat_aggs or ())
    if diffs:
        feats = add_diff_features(feats, NUM_COLS)
    # one spine (training labels + test list, one scan), one join: the aggregate is planned once
    return spine_join(spine(spark, sf_dir), feats)
