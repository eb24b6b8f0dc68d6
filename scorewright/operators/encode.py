"""Target encoding (D14 fit, C5 apply).

Reproduces the reference's semantics on purpose: the encoding of a category is the mean
target over the *statements* of the fitting rows (statement-weighted, in-sample: it is
computed before the folds, hence leaky). NULL categories are not encoded; categories not
seen in the fitting rows map to NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from scorewright.operators.joins import BROADCAST_ROW_LIMIT, checked_small


def _kind(df: DataFrame, cols: list[str]) -> str:
    """Type in which categories are compared: DOUBLE for numbers, STRING if any column is not numeric."""
    return "double" if all(isinstance(df.schema[c].dataType, NumericType) for c in cols) else "string"


def fit_target_encoding(df: DataFrame, cols: list[str], target: str = "target") -> DataFrame:
    """One pass for all columns: unpivot to (feature, value) and one ``groupBy`` (partial
    aggregation before the shuffle, so hot categories cost nothing extra)."""
    rows = df.where(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("_y"), *[F.col(c).cast(_kind(df, cols)).alias(c) for c in cols])
    long = rows.unpivot(["_y"], cols, "feature", "value").where(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.avg("_y").alias("te"))


def fit_target_encoding_by_key(rows: DataFrame, labels: DataFrame, cols: list[str], key: str = "customer_id",
                               target: str = "target") -> DataFrame:
    """Same statement-weighted means, with the rows pre-aggregated before they meet the labels:
    ``(key, feature, value) -> count`` (partial aggregation: a customer with a third of all
    statements collapses to a few rows per map task), joined to the key-level labels, then
    ``sum(count * target) / sum(count)`` per category. Only narrow rows are shuffled."""
    long = (rows.select(key, *[F.col(c).cast(_kind(rows, cols)).alias(c) for c in cols])
            .unpivot([key], cols, "feature", "value").where(F.col("value").isNotNull()))
    counts = long.groupBy(key, "feature", "value").agg(F.count(F.lit(1)).alias("_n"))
    lab = labels.select(key, F.col(target).cast("double").alias("_y")).where(F.col("_y").isNotNull())
    j = counts.join(lab, on=key, how="inner")
    return j.groupBy("feature", "value").agg(
        (F.sum(F.col("_n") * F.col("_y")) / F.sum("_n")).alias("te"))


def apply_target_encoding(df: DataFrame, encoding: DataFrame, cols: list[str], suffix: str = "_te",
                          broadcast_limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Add ``<col><suffix>`` for each column by a left join on the category value. The map
    is materialised once; broadcast when its checked size allows (no shuffle of the
    statements), else shuffle joins."""
    enc, small = checked_small(encoding, broadcast_limit)
    out, kind = df, enc.schema["value"].dataType.simpleString()
    for c in cols:
        m = enc.where(F.col("feature") == c).select(F.col("value").alias("_te_key"), F.col("te").alias(f"{c}{suffix}"))
        if small:
            m = F.broadcast(m)
        out = out.join(m, out[c].cast(kind) == m["_te_key"], "left").drop("_te_key")
    return out
