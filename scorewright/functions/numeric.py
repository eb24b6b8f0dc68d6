"""Output normalisation for engine-to-engine comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def comparable(df: DataFrame) -> DataFrame:
    """Cast DOUBLE/FLOAT columns to FLOAT (IEEE round-to-nearest in both engines), so sums
    taken in different orders compare equal. The SQL oracles apply ``CAST(x AS FLOAT)``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.col(f.name).cast("float").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
