"""Type narrowing by observed range (B15, D16): one aggregate pass over all columns.

Bounds are strict, as in the reference: an integer column becomes the narrowest of
tinyint/smallint/int/bigint whose open interval (min, max) contains the data; floating
columns become float when inside float's finite range, else stay double."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType

_INT_TYPES = [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647)]
_FLOAT_MAX = 3.4028234663852886e38
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_FLOATING = (FloatType, DoubleType)


def _choice(col: str, is_int: bool):
    lo, hi = F.min(col), F.max(col)
    if is_int:
        expr = F.lit("bigint")
        for name, a, b in reversed(_INT_TYPES):
            expr = F.when((lo > a) & (hi < b), F.lit(name)).otherwise(expr)
        return expr
    return F.when((lo > -_FLOAT_MAX) & (hi < _FLOAT_MAX), F.lit("float")).otherwise(F.lit("double"))


def narrowing_report(df: DataFrame) -> DataFrame:
    """(column_name, min_value, max_value, narrow_type), one row per numeric column, from a
    single global aggregate (partial aggregation per task, one row to merge)."""
    cols = [f for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL + _FLOATING)]
    aggs = []
    for f in cols:
        aggs.append(F.struct(F.lit(f.name).alias("column_name"),
                             F.min(f.name).cast("double").alias("min_value"),
                             F.max(f.name).cast("double").alias("max_value"),
                             _choice(f.name, isinstance(f.dataType, _INTEGRAL)).alias("narrow_type")))
    one = df.agg(F.array(*aggs).alias("r"))
    return one.select(F.explode("r").alias("r")).select("r.*")


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the type chosen by :func:`narrowing_report` (the report is
    one row per column, so collecting it is bounded by the schema width)."""
    plan = {r["column_name"]: r["narrow_type"] for r in narrowing_report(df).collect()}
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c) for c in df.columns])
