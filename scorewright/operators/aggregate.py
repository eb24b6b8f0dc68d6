"""Statement history -> one row per customer.

Semantics (all skip missing values): mean, sample std (NULL below two values), min, max,
sum (0.0 when nothing is present), last / first non-missing value in history order,
count of non-missing values, number of distinct non-missing values.

``last``/``first`` are ``max_by``/``min_by`` over a LONG history position, which keeps
them hash aggregates with partial aggregation; a hot customer therefore costs one
pre-aggregated row per map task, never one huge group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NUMERIC_AGGS = ("mean", "std", "min", "max", "sum", "last", "first")
CATEGORICAL_AGGS = ("count", "last", "first", "nunique")
SCORE_AGGS = ("mean", "std", "min", "max", "last", "first")
DIFF_FEATURES = (("last_mean_diff", "last", "mean"), ("last_first_diff", "last", "first"),
                 ("max_min_diff", "max", "min"))
# aggregates of one ``groupBy``; more are computed in several and joined on the key
CHUNK = 280
# aggregates (of whole columns with all NUMERIC_AGGS: 12 buffers each) that Spark still compiles into one loop: it
# interprets operators of more than 100 fields. For narrow written input, which costs little to be read again
COMPILED_CHUNK = 8 * len(NUMERIC_AGGS)


def small_codes(df: DataFrame, cols: list[str]) -> bool:
    """True when every column is integral with all values in [0, 62] (one global aggregate,
    column-pruned). Such codes count distinct values exactly with a 64-bit mask, which keeps
    the customer aggregate a code-generated hash aggregate instead of a sort-based one."""
    from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType
    types = {f.name: f.dataType for f in df.schema.fields}
    if not cols or not all(isinstance(types[c], (ByteType, ShortType, IntegerType, LongType)) for c in cols):
        return False
    r = df.agg(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
               *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    return all((r[f"lo_{i}"] is None or r[f"lo_{i}"] >= 0) and (r[f"hi_{i}"] is None or r[f"hi_{i}"] <= 62)
               for i in range(len(cols)))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def agg_expr(agg: str, col: str | Column, order: str, mask_nunique: bool = False) -> Column:
    """One aggregate. For a column name it is built as a single SQL expression (one JVM
    round trip per aggregate, which matters for bundles of hundreds of columns)."""
    if isinstance(col, str):
        x, o = _q(col), _q(order)
        present = f"CASE WHEN {x} IS NOT NULL THEN {o} END"
        sql = {
            "mean": f"avg({x})",
            "std": f"stddev_samp({x})",
            "min": f"min({x})",
            "max": f"max({x})",
            "sum": f"coalesce(sum({x}), CAST(0.0 AS DOUBLE))",
            "last": f"max_by({x}, {present})",
            "first": f"min_by({x}, {present})",
            "count": f"count({x})",
            "nunique": (f"CAST(coalesce(bit_count(bit_or(shiftleft(CAST(1 AS BIGINT), CAST({x} AS INT)))), 0) AS BIGINT)"
                        if mask_nunique else f"CAST(size(collect_set({x})) AS BIGINT)"),
        }
        if agg not in sql:
            raise ValueError(f"unknown aggregate {agg!r}")
        return F.expr(sql[agg])
    x = col
    present_order = F.when(x.isNotNull(), F.col(order))
    if agg == "mean":
        return F.avg(x)
    if agg == "std":
        return F.stddev_samp(x)
    if agg == "min":
        return F.min(x)
    if agg == "max":
        return F.max(x)
    if agg == "sum":
        return F.coalesce(F.sum(x), F.lit(0.0))
    if agg == "last":
        return F.max_by(x, present_order)
    if agg == "first":
        return F.min_by(x, present_order)
    if agg == "count":
        return F.count(x)
    if agg == "nunique":
        if mask_nunique:
            return F.coalesce(F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), x.cast("int")))),
                              F.lit(0)).cast("long")
        return F.size(F.collect_set(x)).cast("long")
    raise ValueError(f"unknown aggregate {agg!r}")


def _wide(df: DataFrame, key: str, order: str, specs: list[tuple[str, str]], mask: bool = False) -> DataFrame:
    return df.groupBy(key).agg(*[agg_expr(a, c, order, mask).alias(f"{c}_{a}") for c, a in specs])


def aggregate_history(df: DataFrame, key: str, order: str, numeric: list[str],
                      categorical: list[str] = (), num_aggs: tuple[str, ...] = NUMERIC_AGGS,
                      cat_aggs: tuple[str, ...] = CATEGORICAL_AGGS, chunk: int = CHUNK) -> DataFrame:
    """One row per ``key`` with ``<column>_<agg>`` columns (numeric first, then categorical).

    Every width takes the same way, so types never depend on it: aggregates run in chunks of whole
    columns, each one ``groupBy(key)`` with partial aggregation, and the chunks are joined on the key.
    The partial rows of a chunk are all that is shuffled, and the joins find their sides partitioned."""
    numeric, categorical = list(numeric), list(categorical)
    mask = "nunique" in cat_aggs and small_codes(df, categorical)
    specs = [(c, a) for c in numeric for a in num_aggs] + [(c, a) for c in categorical for a in cat_aggs]
    parts = [specs[i:i + chunk] for i in range(0, len(specs), chunk)] or [[]]
    out = _wide(df, key, order, parts[0], mask)
    for p in parts[1:]:
        more = _wide(df, key, order, p, mask)
        out = (out.alias("l").join(more.withColumnRenamed(key, "_key"), F.col(f"l.{_q(key)}").eqNullSafe(F.col("_key")), "inner")
               .drop("_key"))
    return out


def add_diff_features(df: DataFrame, numeric: list[str]) -> DataFrame:
    """<c>_last_mean_diff, <c>_last_first_diff, <c>_max_min_diff (B14), in one projection."""
    adds = [f"{_q(c + '_' + a)} - {_q(c + '_' + b)} AS {_q(c + '_' + name)}"
            for c in numeric for name, a, b in DIFF_FEATURES]
    return df.selectExpr("*", *adds)
