"""Hand-made frames with the expected values of FIXTURES §3."""

import math

import pytest
from pyspark.sql import functions as F

from scorewright.operators.aggregate import add_diff_features, aggregate_history
from scorewright.operators.history import order_history

ROWS = [("a", 1, 1.0), ("a", 3, 3.0), ("a", 5, None), ("b", 1, None), ("c", 1, 5.0), ("c", 9, None)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "k string, ord long, x double")


@pytest.mark.parametrize("chunk", [280, 2])
def test_skip_missing_semantics(spark, frame, chunk):
    g = aggregate_history(frame, "k", "ord", ["x"], ["x"], chunk=chunk,
                          cat_aggs=("count", "nunique"))
    r = {row["k"]: row for row in g.collect()}
    a, b, c = r["a"], r["b"], r["c"]
    assert a["x_mean"] == 2.0 and math.isclose(a["x_std"], 1.41421356, rel_tol=1e-8)
    assert a["x_sum"] == 4.0 and a["x_first"] == 1.0 and a["x_last"] == 3.0
    assert a["x_count"] == 2 and a["x_nunique"] == 2
    for col in ("x_mean", "x_std", "x_min", "x_max", "x_first", "x_last"):
        assert b[col] is None
    assert b["x_sum"] == 0.0 and b["x_count"] == 0 and b["x_nunique"] == 0
    assert c["x_std"] is None and c["x_last"] == 5.0 and c["x_first"] == 5.0


def test_chunks_agree_and_keep_types(spark):
    rows = [(k, o, float((k * 31 + o * 7) % 13) if (k + o) % 5 else None, float(o % 3))
            for k in range(40) for o in range(k % 9 + 1)]
    df = spark.createDataFrame(rows, "k long, ord long, x double, y double")
    df = df.withColumn("z", F.lit(9007199254740993) + F.col("ord"))
    w = aggregate_history(df, "k", "ord", ["x", "y", "z"])
    c = aggregate_history(df, "k", "ord", ["x", "y", "z"], chunk=4)
    assert w.schema == c.schema and w.schema["z_last"].dataType.simpleString() == "bigint"
    assert sorted(w.collect()) == sorted(c.collect())
    assert {r["z_last"] for r in w.where("k = 0").collect()} == {9007199254740993}


def test_diff_features(spark, frame):
    g = add_diff_features(aggregate_history(frame, "k", "ord", ["x"]), ["x"])
    a = {r["k"]: r for r in g.collect()}["a"]
    assert a["x_last_mean_diff"] == 1.0 and a["x_last_first_diff"] == 2.0 and a["x_max_min_diff"] == 2.0


def test_day_floor_not_calendar_days(spark):
    df = spark.createDataFrame([(1, 1, "2024-01-01 23:59:59"), (1, 2, "2024-01-02 00:00:01"),
                                (1, 3, "2024-01-04 00:00:00")], "customer_id long, seq long, t string")
    from scorewright.functions.time import epoch_micros
    df = df.withColumn("ts", F.col("t").cast("timestamp_ntz")).withColumn("ts_us", epoch_micros("ts"))
    got = {r["seq"]: r["days_diff"] for r in order_history(df).collect()}
    assert got == {1: None, 2: 0, 3: 1}


def test_history_tie_break_is_explicit(spark):
    # two statements on the same date: the sequence column decides, regardless of input order
    rows = [(7, 20, 100), (7, 10, 100), (7, 30, 50)]
    df = spark.createDataFrame(rows, "customer_id long, seq long, ts_us long")
    got = {r["seq"]: r["rn"] for r in order_history(df, days_diff=None).collect()}
    assert got == {30: 1, 10: 2, 20: 3}
