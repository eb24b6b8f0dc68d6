"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970-01-01 of the wall-clock timestamp in column ``ts``
    (TIMESTAMP_NTZ or DATE); no time-zone conversion is involved, so the result does not
    depend on ``spark.sql.session.timeZone``."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{ts}` AS TIMESTAMP_NTZ))")


def days_between(later_us: Column, earlier_us: Column) -> Column:
    """Elapsed whole days, floored (23:59:59 -> next 00:00:01 is 0 days, not 1)."""
    return F.floor((later_us - earlier_us) / F.lit(float(MICROS_PER_DAY))).cast("long")


def date_parts(ts: str | Column) -> dict[str, Column]:
    c = F.col(ts) if isinstance(ts, str) else ts
    return {
        "day": F.dayofmonth(c),
        "month": F.month(c),
        "year": F.year(c),
        "dayofyear": F.dayofyear(c),
    }


def seasonality(part: Column, period: float) -> Column:
    """cos(pi * (part / period * 2 - 1)); period 31 for day of month, 366 for day of year."""
    return F.cos(F.pi() * (part / F.lit(float(period)) * F.lit(2.0) - F.lit(1.0)))


def parse_timestamp(text: str | Column, *formats: str) -> Column:
    """Wall-clock timestamp (TIMESTAMP_NTZ) of a text by the first format that fits; NULL if none does."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])
