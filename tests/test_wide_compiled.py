"""Several hundred aggregates stay compiled loops."""

from scorewright.plans import queries  # noqa: F401
from scorewright.plans.registry import QUERIES


def test_wide_aggregates_are_compiled(spark, tmp_path):
    rows = [(k % 3, k, 1, float(k % 7)) for k in range(30)]
    spark.createDataFrame(rows, "l_suppkey long, l_orderkey long, l_linenumber int, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = QUERIES["customer_agg_wide"](spark, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    steps = [line for line in plan.splitlines() if "HashAggregate(" in line]
    assert steps and all("*(" in line.split("HashAggregate(")[0] for line in steps)
    got = {r["l_suppkey"]: r for r in out.collect()}
    assert len(got) == 3 and got[1]["c2_min"] == 3 and got[1]["c2_last"] == 30 and got[1]["c3_sum"] == 3.0 * sum(k % 7 for k in range(1, 30, 3))
