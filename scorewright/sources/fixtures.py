"""Statement-history fixtures built from the driver's tables.

S (statements): one row per order, keyed by customer, ordered by (order date, order key),
with a per-order roll-up of its line items. E (events): one row per event, keyed by user,
ordered by (timestamp, event id). Labels come from the customer table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.functions.time import epoch_micros
from scorewright.sources.tables import read_table

KEY = "customer_id"
SEQ = "seq"
TS = "ts"
TS_US = "ts_us"

STATEMENT_MEASURES = ["o_totalprice", "n_lines", "sum_qty", "avg_discount", "max_price"]
STATEMENT_CATEGORICAL = ["status_code", "priority_code"]
STATEMENT_NUMERIC = STATEMENT_MEASURES  # before derived features are added

# Integer codes of o_orderstatus.
STATUS_CODES = {"F": 0, "O": 1, "P": 2}
# Integer codes of events.event_type (unknown types stay NULL).
EVENT_CODES = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}


def _code(c, codes: dict[str, int]):
    expr = None
    for k, v in codes.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return expr.cast("int")


def _status_code(c):
    return _code(c, STATUS_CODES)


def line_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order roll-up of line items (one partial-aggregated shuffle by order key)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_discount").alias("avg_discount"),
        F.max("l_extendedprice").alias("max_price"),
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture S. ``o_totalprice`` is NULL on every 7th order so that skip-missing
    semantics are exercised; orders without lines have NULL roll-up columns."""
    o = read_table(spark, sf_dir, "orders")
    rolled = line_rollup(spark, sf_dir)
    s = o.join(rolled, o["o_orderkey"] == rolled["l_orderkey"], "left")
    return s.select(
        F.col("o_custkey").alias(KEY),
        F.col("o_orderkey").alias(SEQ),
        F.col("o_orderdate").alias(TS),
        epoch_micros("o_orderdate").alias(TS_US),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.col("n_lines").cast("double").alias("n_lines"),
        F.col("sum_qty").cast("double").alias("sum_qty"),
        F.col("avg_discount").cast("double").alias("avg_discount"),
        F.col("max_price").cast("double").alias("max_price"),
        _status_code(F.col("o_orderstatus")).alias("status_code"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_code"),
        (F.col("o_custkey") % 3 == 0).alias("is_test"),
    ).where(F.col(KEY).isNotNull())


def statement_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, sequence and time of each statement of fixture S. The roll-up has one row an order and its join keeps
    every order, so these columns need no line items."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias(KEY), F.col("o_orderkey").alias(SEQ), epoch_micros("o_orderdate").alias(TS_US)).where(F.col(KEY).isNotNull())


def events_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: events keyed by user, microsecond timestamps."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias(KEY),
        F.col("event_id").alias(SEQ),
        F.col("ts").alias(TS),
        epoch_micros("ts").alias(TS_US),
        F.col("value").cast("double").alias("value"),
        F.col("event_type"),
        _code(F.col("event_type"), EVENT_CODES).alias("event_code"),
    ).where(F.col(KEY).isNotNull())


def customer_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, truth, is_test) for every customer: truth = c_acctbal < 0."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias(KEY),
                    (F.col("c_acctbal") < 0).cast("int").alias("truth"),
                    (F.col("c_custkey") % 3 == 0).alias("is_test"))


def train_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label spine (customer_id, target) of the training customers."""
    t = customer_truth(spark, sf_dir)
    return t.where(~F.col("is_test")).select(KEY, F.col("truth").alias("target"))


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both spines in one scan: (customer_id, target, is_test), target NULL for test customers."""
    t = customer_truth(spark, sf_dir)
    return t.select(KEY, F.when(~F.col("is_test"), F.col("truth")).alias("target"), "is_test")


def test_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer list of the test split (customer_id)."""
    t = customer_truth(spark, sf_dir)
    return t.where(F.col("is_test")).select(KEY)
