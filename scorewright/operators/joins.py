"""Key joins of the pipeline (all left equi-joins) and the size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scorewright.session import cut_lineage

BROADCAST_ROW_LIMIT = 1_000_000


def checked_small(df: DataFrame, limit_rows: int = BROADCAST_ROW_LIMIT,
                  materialize: bool = True) -> tuple[DataFrame, bool]:
    """Report whether a (presumably small) derived table has at most ``limit_rows`` rows.
    Callers broadcast it only then; otherwise they fall back to a shuffle join (with AQE
    skew handling). With ``materialize`` the table is first written through a reliable
    checkpoint (for tables derived from an expensive plan); without it, it is only counted
    (for tables derived from an input that is already materialised)."""
    m = cut_lineage(df) if materialize else df
    return m, m.count() <= limit_rows


def label_join(statements: DataFrame, labels: DataFrame, key: str = "customer_id") -> DataFrame:
    """N:1 statements ⟕ labels (C1). Customer-sized on both sides: a shuffle join on the key;
    AQE turns it into a broadcast only when the label side is small at run time."""
    return statements.join(labels, on=key, how="left")


def spine_join(spine: DataFrame, features: DataFrame, key: str = "customer_id") -> DataFrame:
    """1:1 spine ⟕ features (C2/C3): the spine decides which rows exist. ``features`` is the
    output of a ``groupBy(key)`` and already hash-partitioned on the key."""
    return spine.join(features, on=key, how="left")


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Row-wise concat matched by column name, missing columns NULL (G1), with the split flag."""
    return (train.withColumn("is_test", F.lit(False))
            .unionByName(test.withColumn("is_test", F.lit(True)), allowMissingColumns=True))
