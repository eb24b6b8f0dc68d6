"""Readers for the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet``: the footer schema is used, filters and projections reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in FLOAT and DOUBLE columns as NULL: files written by other tools mark missing values so, and
    every aggregate here skips NULL only."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}
    return df.select(*[F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])
