"""Feature-importance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def top_features(imp: DataFrame, k: int = 40) -> DataFrame:
    """The ``k`` features with the highest mean importance over folds (ties by name).
    ``orderBy().limit()`` plans as a per-partition top-k merged once: no global sort."""
    means = imp.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
    return means.orderBy(F.desc("mean_importance"), F.asc("feature")).limit(k)


def top_importance_rows(imp: DataFrame, k: int = 40) -> DataFrame:
    """Rows of the long table whose feature is in the top ``k`` (membership as a semi join)."""
    return imp.join(F.broadcast(top_features(imp, k).select("feature")), on="feature", how="left_semi")


def importance_totals(imp: DataFrame) -> DataFrame:
    """Sum over folds per feature (the reference's importance CSV)."""
    return imp.groupBy("feature").agg(F.sum("importance").alias("importance"))


def correlation_importance(df: DataFrame, features: list[str], label: str = "target",
                           partition_by: list[str] = ("fold",)) -> DataFrame:
    """A model-free importance: ``log1p(1000 * |corr(feature, label)|)`` per fold, from one
    unpivot and one partially aggregated ``groupBy`` (constant features score 0)."""
    pk = list(partition_by)
    d = df.select(*pk, F.col(label).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in features])
    long = d.unpivot([*pk, "_y"], list(features), "feature", "value")
    # from its parts: a constant feature divides by zero, which is an error in ``corr`` itself
    label_here = F.when(F.col("value").isNotNull(), F.col("_y"))
    c = long.groupBy(*pk, "feature").agg(F.try_divide(F.covar_pop("value", "_y"), F.stddev_pop("value") * F.stddev_pop(label_here)).alias("_r"))
    r = F.coalesce(F.nanvl(F.col("_r"), F.lit(0.0)), F.lit(0.0))
    return c.select(*pk, "feature", F.log1p(F.lit(1000.0) * F.abs(r)).alias("importance"))
