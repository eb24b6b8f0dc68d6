"""Score fixtures need no line items."""

from pyspark.sql import functions as F

from scorewright.sources.predictions import statement_scores


def test_statement_scores_read_no_line_items(spark, tmp_path):
    spark.createDataFrame([(1, 10, "2024-01-01"), (2, 10, "2024-01-02"), (3, None, "2024-01-03"), (4, 11, "2024-01-04"), (4, 11, "2024-01-04")],
                          "o_orderkey long, o_custkey long, d string").withColumn("o_orderdate", F.col("d").cast("date")).drop("d") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(10, -1.0), (11, 5.0)], "c_custkey long, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    got = statement_scores(spark, str(tmp_path))
    assert got.columns == ["customer_id", "seq", "ts_us", "pred_no_agg"]
    assert sorted((r[0], r[1]) for r in got.collect()) == [(10, 1), (10, 2), (11, 4), (11, 4)]
