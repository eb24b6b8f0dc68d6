"""Calendar features of the statement date (H1-H4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorewright.functions.time import date_parts, seasonality

DATE_FEATURES = ["day", "month", "year", "seasonality_m", "seasonality_y"]


def add_date_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """day, month, year and two cosine seasonalities. Each split uses its own dates (the
    reference fills the test split's yearly seasonality from training dates; not copied)."""
    p = date_parts(ts)
    return df.withColumns({
        "day": p["day"],
        "month": p["month"],
        "year": p["year"],
        "seasonality_m": seasonality(p["day"], 31),
        "seasonality_y": seasonality(p["dayofyear"], 366),
    })
