"""Deterministic pseudo-random numbers derived from md5, identical in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# first 7 hex digits of md5 -> integer in [0, 2^28)
_SCALE = float(1 << 28)


def unit_score(*parts: str | Column) -> Column:
    """md5('p1:p2:...') -> first 7 hex digits -> / 2^28, a value in [0, 1)."""
    cols = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    h = F.md5(F.concat_ws(":", *cols))
    return F.conv(F.substring(h, 1, 7), 16, 10).cast("long") / F.lit(_SCALE)


def unit_score_sql(*parts: str) -> str:
    """DuckDB twin of :func:`unit_score`; ``parts`` are SQL expressions."""
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(('0x' || substr(md5(concat_ws(':', {inner})), 1, 7)) AS BIGINT) / {_SCALE}::DOUBLE)"
