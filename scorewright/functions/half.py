"""Half precision (IEEE binary16) as column arithmetic, for tables that other tools store in two bytes a value (A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values of the format: bits of the fraction, least exponent of a normal number, and from where values are infinite.
FRACTION, LEAST_EXPONENT, OVERFLOW = 10, -14, 65520.0


def to_half(x: Column | str) -> Column:
    """The value as the nearest half-precision number (a DOUBLE that the format holds exactly): ties go to the even fraction,
    small values to multiples of 2^-24, values from 65520 on to infinity. NULL, NaN, infinities and signs are kept.

    The step between neighbours is a power of two, so dividing by it, rounding half to even and multiplying are exact."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    size = F.abs(x)
    # the logarithm may be off by one next to a power of two; powers of two are exact
    guess = F.floor(F.log2(size))
    two = F.lit(2.0)
    exponent = F.when(F.pow(two, guess) > size, guess - 1).when(F.pow(two, guess + 1) <= size, guess + 1).otherwise(guess)
    step = F.pow(two, F.greatest(exponent, F.lit(LEAST_EXPONENT)) - FRACTION)
    infinite = F.lit(float("inf"))
    # 1 / x tells -0.0 from 0.0, so zeros are passed through as they are
    return (F.when(x.isNull() | F.isnan(x) | (size == 0.0), x)
            .when(size >= OVERFLOW, F.when(x > 0, infinite).otherwise(-infinite))
            .otherwise(F.rint(x / step) * step))


def halve(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` in half precision, as FLOAT (which holds every half exactly)."""
    return df.withColumns({c: to_half(c).cast("float") for c in columns})


def to_half_sql(x: str) -> str:
    """The same rule as SQL, for comparison."""
    x = f"CAST({x} AS DOUBLE)"
    guess = f"floor(log2(abs({x})))"
    exponent = (f"CASE WHEN pow(2.0::DOUBLE, {guess}) > abs({x}) THEN {guess} - 1 WHEN pow(2.0::DOUBLE, {guess} + 1) <= abs({x}) "
                f"THEN {guess} + 1 ELSE {guess} END")
    step = f"pow(2.0::DOUBLE, greatest({exponent}, {LEAST_EXPONENT}) - {FRACTION})"
    return (f"CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) THEN {x} WHEN abs({x}) >= {OVERFLOW} THEN sign({x}) * 'inf'::DOUBLE "
            f"ELSE round_even({x} / {step}, 0) * {step} END")
