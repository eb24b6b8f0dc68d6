"""Per-customer ordering features: position in the history and elapsed days since the
previous statement (E1), previous-score differences (E2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scorewright.functions.time import days_between
from scorewright.operators.ordered import ordered_scan


def order_history(df: DataFrame, key: str = "customer_id", order: tuple[str, ...] = ("ts_us", "seq"),
                  ts_us: str = "ts_us", rn: str = "rn", days_diff: str | None = "days_diff",
                  diffs: dict[str, Column] | None = None, **scan_kw) -> DataFrame:
    """Add ``rn`` (1-based position of the row in its customer's history, a LONG usable as
    the ordering of first/last aggregates), ``days_diff`` (floored whole days since the
    previous row; NULL on the first) and, for each ``name -> expr`` in ``diffs``,
    ``expr - previous expr``.

    The order is explicit – ``order`` must be unique within a key – so results never depend
    on file or shuffle order. Hot customers are split across buckets (see ordered_scan).
    """
    lags: dict[str, Column] = {}
    if days_diff:
        lags["_prev_ts_us"] = F.col(ts_us)
    for name, expr in (diffs or {}).items():
        lags[f"_prev_{name}"] = expr
    out = ordered_scan(df, [key], list(order), sums={rn: F.lit(1)}, lags=lags, **scan_kw)
    adds = {}
    if days_diff:
        adds[days_diff] = days_between(F.col(ts_us), F.col("_prev_ts_us"))
    for name, expr in (diffs or {}).items():
        adds[name] = expr - F.col(f"_prev_{name}")
    return out.withColumns(adds).drop(*lags.keys())


def row_index(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Number the rows of a whole table from 0 in ``order`` (unique per row), by the ordered scan: no task sees
    more than a bucket of the order."""
    scanned = ordered_scan(df, [], order, sums={"_n": F.lit(1).cast("long")})
    return scanned.withColumn(name, F.col("_n") - 1).drop("_n")
