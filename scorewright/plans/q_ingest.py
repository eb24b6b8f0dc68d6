"""Registered queries: missing values, text dates, text categories, row numbers, rounding, wide bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.functions.half import halve, to_half_sql
from scorewright.functions.numeric import comparable
from scorewright.functions.time import parse_timestamp
from scorewright.operators.aggregate import COMPILED_CHUNK, NUMERIC_AGGS, aggregate_history
from scorewright.operators.encode import apply_target_encoding, fit_target_encoding
from scorewright.operators.history import row_index
from scorewright.operators.ordered import ordered_scan
from scorewright.plans.registry import register
from scorewright.session import cut_lineage, shared_dir
from scorewright.sources.csv_infer import DATE, DOUBLE, LONG, TIMESTAMP, infer_csv
from scorewright.sources.tables import nan_to_null, read_table

WIDE = 60


@register("nan_skip_missing", """
SELECT l_suppkey, CAST(avg(x) AS FLOAT) AS x_mean, CAST(min(x) AS FLOAT) AS x_min, CAST(max(x) AS FLOAT) AS x_max, count(x) AS x_count
FROM (SELECT l_suppkey, CASE WHEN l_linenumber <> 3 THEN CAST(l_extendedprice AS DOUBLE) END AS x FROM lineitem) GROUP BY l_suppkey""")
def q_nan_skip_missing(spark, sf_dir):
    """NaN (here: every third line of an order) counts as missing in every aggregate."""
    x = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_extendedprice").cast("double")).alias("x")
    rows = nan_to_null(read_table(spark, sf_dir, "lineitem").select("l_suppkey", x))
    return comparable(rows.groupBy("l_suppkey").agg(F.avg("x").alias("x_mean"), F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.count("x").alias("x_count")))


@register("parse_dates", """
SELECT o_orderkey, year(CAST(o_orderdate AS DATE)) AS year, month(CAST(o_orderdate AS DATE)) AS month, day(CAST(o_orderdate AS DATE)) AS day FROM orders""")
def q_parse_dates(spark, sf_dir):
    """Dates given as text in two formats (by odd and even key) become timestamps again."""
    o = read_table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    ts = o.select("o_orderkey", parse_timestamp(text, "yyyy-MM-dd", "dd/MM/yyyy").alias("ts"))
    return ts.select("o_orderkey", F.year("ts").cast("long").alias("year"), F.month("ts").cast("long").alias("month"), F.dayofmonth("ts").cast("long").alias("day"))


@register("target_encode_string", """
SELECT o_orderkey, o_orderpriority, CAST(avg(CASE WHEN c_acctbal < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER (PARTITION BY o_orderpriority) AS FLOAT) AS o_orderpriority_te
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_target_encode_string(spark, sf_dir):
    rows = (read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
            .join(read_table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("target")),
                  F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderpriority", "target"))
    encoding = fit_target_encoding(rows, ["o_orderpriority"])
    return comparable(apply_target_encoding(rows, encoding, ["o_orderpriority"]).drop("target"))


@register("row_index", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders")
def q_row_index(spark, sf_dir):
    """Table-wide row number in the order (date, key)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.unix_date(F.col("o_orderdate").cast("date")).alias("day"))
    return row_index(o, ["day", "o_orderkey"]).select("o_orderkey", "row_index")


# unique within a supplier: lines that agree in all of these agree in every column that is aggregated
_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_quantity"]


def _wide_sql() -> str:
    """Twin of ``customer_agg_wide``: WIDE columns, half LONG and half DOUBLE, all aggregates."""
    out = []
    for i in range(WIDE):
        c, x = f"c{i}", (f"l_orderkey + {i}" if i % 2 == 0 else f"CAST(l_quantity AS DOUBLE) * {i}")
        out += [f"CAST(avg({x}) AS FLOAT) AS {c}_mean", f"CAST(stddev_samp({x}) AS FLOAT) AS {c}_std", f"min({x}) AS {c}_min", f"max({x}) AS {c}_max",
                f"CAST(sum({x}) AS FLOAT) AS {c}_sum", f"arg_max({x}, o) AS {c}_last", f"arg_min({x}, o) AS {c}_first"]
    return f"SELECT l_suppkey, {', '.join(out)} FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(_LINE_ORDER)}) AS o FROM lineitem) GROUP BY l_suppkey"


@register("customer_agg_wide", _wide_sql())
def q_customer_agg_wide(spark, sf_dir):
    """A bundle of several hundred aggregates keeps each column's type (LONG stays LONG in min, max, last and first)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", *_LINE_ORDER)
    # several hundred aggregates are computed in several passes: the narrow input is ordered and written once
    li = cut_lineage(ordered_scan(li, ["l_suppkey"], _LINE_ORDER, sums={"o": F.lit(1).cast("long")}))
    cols = [(F.col("l_orderkey") + i if i % 2 == 0 else F.col("l_quantity").cast("double") * i).alias(f"c{i}") for i in range(WIDE)]
    rows = li.select("l_suppkey", "o", *cols)
    names = [f"c{i}" for i in range(WIDE)]
    out = aggregate_history(rows, "l_suppkey", "o", names, num_aggs=NUMERIC_AGGS, chunk=COMPILED_CHUNK)
    return out.select("l_suppkey", *[F.col(f"{c}_{a}").cast("float").alias(f"{c}_{a}") if a in ("mean", "std", "sum") else F.col(f"{c}_{a}")
                                     for c in names for a in NUMERIC_AGGS])


_HALF = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "price_share"]


@register("half_precision", "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"CAST({to_half_sql(c)} AS FLOAT) AS {c}" for c in _HALF)
          + " FROM (SELECT *, l_extendedprice / 1e12::DOUBLE AS price_share FROM lineitem)")
def q_half_precision(spark, sf_dir):
    """Columns as another tool stores them in two bytes a value (A3): prices past the largest half become infinite, shares
    of a total are subnormal."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("price_share", F.col("l_extendedprice") / F.lit(1e12))
    return halve(li.select("l_orderkey", "l_linenumber", "l_partkey", *_HALF), _HALF)


# text of each column of the written CSV: one of each type, and columns whose type only a few rows decide
_CSV_SQL = {"key": "CAST(o_orderkey AS VARCHAR)", "price": "CAST(o_totalprice AS VARCHAR)", "day": "strftime(o_orderdate, '%Y-%m-%d')",
            "late_text": "CASE WHEN o_orderkey % 1009 = 5 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END",
            "mixed_number": "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 501 = 0 THEN o_custkey || '.5' ELSE CAST(o_custkey AS VARCHAR) END",
            "mixed_time": "CASE WHEN o_orderkey % 701 = 0 THEN strftime(o_orderdate, '%Y-%m-%d 06:30:00') ELSE strftime(o_orderdate, '%Y-%m-%d') END",
            "priority": "o_orderpriority", "none": "NULL"}


def _csv_sql() -> str:
    def holds(t, c):
        return {"bigint": f"regexp_matches({c}, '{LONG}') AND TRY_CAST({c} AS BIGINT) IS NOT NULL", "double": f"regexp_matches({c}, '{DOUBLE}')",
                "date": f"regexp_matches({c}, '{DATE}') AND TRY_CAST({c} AS DATE) IS NOT NULL",
                "timestamp": f"(regexp_matches({c}, '{DATE}') OR regexp_matches({c}, '{TIMESTAMP}')) AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL"}[t]

    parts = []
    for c in _CSV_SQL:
        kind = " ".join(f"WHEN COUNT(CASE WHEN {holds(t, c)} THEN 1 END) = COUNT({c}) THEN '{t}'" for t in ("bigint", "double", "date", "timestamp"))
        parts.append(f"SELECT '{c}' AS column_name, CASE WHEN COUNT({c}) = 0 THEN 'string' {kind} ELSE 'string' END AS type, COUNT({c}) AS n_values, "
                     f"COUNT(*) - COUNT({c}) AS n_missing FROM t WHERE NOT bad")
    cols = ", ".join(f"{x} AS {c}" for c, x in _CSV_SQL.items())
    return (f"WITH t AS (SELECT {cols}, o_orderkey % 97 = 0 AS bad FROM orders)\nSELECT r.*, (SELECT COUNT(*) FROM t WHERE bad) AS n_malformed "
            f"FROM ({' UNION ALL '.join(parts)}) r")


@register("csv_inferred", _csv_sql())
def q_csv_inferred(spark, sf_dir):
    """Orders written as CSV, every 97th line cut off after two fields, and read back without a schema (A2): the type of each
    column, from every row, and the number of malformed lines."""
    import uuid
    o = read_table(spark, sf_dir, "orders")
    k, cust, day = F.col("o_orderkey"), F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd")
    fields = {"key": k.cast("string"), "price": F.col("o_totalprice").cast("string"), "day": day,
              "late_text": F.when(k % 1009 == 5, F.lit("n/a")).otherwise(cust),
              "mixed_number": F.when(k % 11 == 0, F.lit("")).when(k % 501 == 0, F.concat(cust, F.lit(".5"))).otherwise(cust),
              "mixed_time": F.when(k % 701 == 0, F.concat(day, F.lit(" 06:30:00"))).otherwise(day), "priority": F.col("o_orderpriority"), "none": F.lit("")}
    line = F.when(k % 97 == 0, F.concat_ws(",", fields["key"], fields["price"])).otherwise(F.concat_ws(",", *fields.values()))
    path = shared_dir(spark, f"csv/{uuid.uuid4().hex}")
    o.select(line.alias("value")).write.text(path)
    found = infer_csv(spark, path, names=list(fields))
    return found.report.withColumn("n_malformed", F.lit(found.malformed.count()).cast("long"))
