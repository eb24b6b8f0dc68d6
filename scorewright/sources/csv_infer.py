"""CSV files without a schema: types are inferred from every row, malformed rows are set apart (A2).

The file is read as text once to choose types: one global aggregate counts, per column, the values that each type of
the lattice ``long < double < text`` and ``date < timestamp < text`` can hold. No row is sampled and no column is decided
by its first values. Rows whose number of fields is not the header's are kept in a table of their own and take no part."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scorewright.session import cut_lineage

#: Column that holds the text of a malformed row.
MALFORMED = "_malformed"
#: The lattice, narrowest first. A column's type is the first that holds all its values; text holds everything.
LATTICE = ("bigint", "double", "date", "timestamp")
#: How numbers and days are written (a day alone is a date, with a time a timestamp).
LONG, DOUBLE = r"^[+-]?[0-9]{1,19}$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(Infinity|inf)$|^(NaN|nan)$"
DATE, TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"


@dataclass(frozen=True)
class Inferred:
    """``rows``: the good rows with inferred types; ``malformed``: the text of the others; ``types``: column name to type;
    ``report``: a row a column (``column_name, type, n_values, n_missing``)."""

    rows: DataFrame
    malformed: DataFrame
    types: dict[str, str]
    report: DataFrame


def _holds(value: Column, kind: str) -> Column:
    """Whether a type can hold a text without loss of meaning."""
    if kind == "bigint":
        return value.rlike(LONG) & value.try_cast("bigint").isNotNull()
    if kind == "double":
        return value.rlike(DOUBLE)
    if kind == "date":
        return value.rlike(DATE) & value.try_cast("date").isNotNull()
    return (value.rlike(DATE) | value.rlike(TIMESTAMP)) & value.try_cast("timestamp").isNotNull()


def _typed(value: Column, kind: str) -> Column:
    if kind == "double":
        plain = F.when(F.lower(value).rlike("^[+-]?inf"), F.when(value.startswith("-"), F.lit("-Infinity")).otherwise(F.lit("Infinity"))).otherwise(value)
        return plain.try_cast("double")
    return value if kind == "string" else value.try_cast(kind)


def infer_csv(spark: SparkSession, path: str, sep: str = ",", missing: Sequence[str] = ("",), names: Sequence[str] | None = None,
              columns: Sequence[str] | None = None) -> Inferred:
    """Read CSV files with a header, or without one, given the ``names`` of their columns. Texts in ``missing`` are NULL. A
    column without values is text. Every good row is seen by the choice of types; ``columns`` limits what is returned."""
    headed = names is None
    names = list(names or spark.read.csv(path, header=True, sep=sep, inferSchema=False).columns)
    schema = StructType([*[StructField(c, StringType()) for c in names], StructField(MALFORMED, StringType())])
    # every column is parsed, whatever is asked for: only so a row with too few or too many fields is known as one
    text = spark.read.option("columnPruning", False).csv(path, header=headed, sep=sep, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, enforceSchema=True)
    wanted = list(columns or names)
    value = {c: F.when(~F.col(f"`{c}`").isin(list(missing)), F.col(f"`{c}`")) for c in wanted}
    # the parser fills the column of malformed rows only beside others, so the filter names one (and is always true of it)
    good = text.where(F.col(f"`{MALFORMED}`").isNull() & (F.coalesce(F.length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0))
    counts = good.agg(F.count(F.lit(1)).alias("rows"), *[F.count(value[c]).alias(f"n{i}") for i, c in enumerate(wanted)],
                      *[F.count(F.when(_holds(value[c], t), 1)).alias(f"{t}{i}") for i, c in enumerate(wanted) for t in LATTICE]).first()
    types = {}
    for i, c in enumerate(wanted):
        n = counts[f"n{i}"]
        types[c] = next((t for t in LATTICE if n and counts[f"{t}{i}"] == n), "string")
    report = spark.createDataFrame([(c, types[c], counts[f"n{i}"], counts["rows"] - counts[f"n{i}"]) for i, c in enumerate(wanted)],
                                   "column_name string, type string, n_values long, n_missing long")
    # for the same reason the malformed rows (few) are written with all columns
    malformed = cut_lineage(text.where(F.col(f"`{MALFORMED}`").isNotNull())).select(F.col(f"`{MALFORMED}`").alias("line"))
    return Inferred(good.select(*[_typed(value[c], types[c]).alias(c) for c in wanted]), malformed, types, report)
