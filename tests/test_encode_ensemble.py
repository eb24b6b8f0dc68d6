import math

from pyspark.sql import functions as F

from scorewright.operators.aggregate import aggregate_history
from scorewright.operators.encode import apply_target_encoding, fit_target_encoding, fit_target_encoding_by_key
from scorewright.operators.ensemble import (best_candidate, evaluate_candidates, pivot_models, seed_average,
                                            simplex_grid, weighted_blend)


def test_encoding_semantics(spark):
    rows = [(1, 0, 1), (1, 0, 1), (2, 0, 0), (2, 1, 0), (3, None, 1), (4, 7, None)]
    df = spark.createDataFrame(rows, "customer_id long, c int, target int")
    enc = fit_target_encoding(df, ["c"])
    got = {r["value"]: r["te"] for r in enc.collect()}
    assert got == {0.0: 2 / 3, 1.0: 0.0}            # statement-weighted; NULL category dropped
    out = apply_target_encoding(df.withColumn("c2", F.col("c")), enc, ["c"]).collect()
    te = sorted((r["customer_id"], r["c"], r["c_te"]) for r in out)
    assert (3, None, None) in te and (4, 7, None) in te  # NULL and unseen categories stay NULL


def test_encoding_fit_by_key_equals_row_fit(spark):
    rows = [(k, (k * 7 + i) % 4, (k * 3 + i) % 5) for k in range(60) for i in range(k % 6 + 1)]
    st = spark.createDataFrame(rows, "customer_id long, a int, b int")
    lab = spark.createDataFrame([(k, k % 3 == 0) for k in range(0, 60, 2)], "customer_id long, t boolean") \
        .select("customer_id", F.col("t").cast("int").alias("target"))
    direct = fit_target_encoding(st.join(lab, "customer_id", "left"), ["a", "b"])
    keyed = fit_target_encoding_by_key(st, lab, ["a", "b"])
    d = {(r["feature"], r["value"]): r["te"] for r in direct.collect()}
    k = {(r["feature"], r["value"]): r["te"] for r in keyed.collect()}
    assert d.keys() == k.keys() and all(math.isclose(d[x], k[x], rel_tol=1e-12) for x in d)


def test_nunique_mask_equals_collect_set(spark):
    rows = [(k, i, (k * i) % 5 if (k + i) % 4 else None) for k in range(30) for i in range(k % 7 + 1)]
    df = spark.createDataFrame(rows, "k long, ord long, c int")
    masked = aggregate_history(df, "k", "ord", [], ["c"], cat_aggs=("nunique",))
    plain = aggregate_history(df.withColumn("c", F.col("c") + 100), "k", "ord", [], ["c"], cat_aggs=("nunique",))
    assert sorted(masked.collect()) == sorted(plain.collect())


def _long(spark):
    rows = []
    for m in ("a", "b"):
        for s in (1, 2, 3):
            for i in range(50):
                rows.append((i, m, s, float((i * (7 + s) + len(m)) % 17)))
    return spark.createDataFrame(rows, "customer_id long, model string, seed int, prediction double")


def test_seed_average_invariant_to_seed_scaling(spark):
    d = _long(spark)
    a = {(r["model"], r["customer_id"]): r["prediction"] for r in seed_average(d).collect()}
    b = {(r["model"], r["customer_id"]): r["prediction"]
         for r in seed_average(d.withColumn("prediction", F.col("prediction") * F.col("seed") + 5)).collect()}
    assert a == b
    assert all(0 < v <= 1 for v in a.values())


def test_grid_search_prefers_the_informative_model(spark):
    rows = [(i, int(i % 4 == 0), float(i % 4 == 0) + (i % 13) / 100, float((i * 7) % 11)) for i in range(400)]
    wide = spark.createDataFrame(rows, "customer_id long, target int, prediction_good double, prediction_noise double")
    grid = simplex_grid(2, 4)
    assert len(grid) == 5 and all(math.isclose(sum(g), 1.0) for g in grid)
    best = best_candidate(evaluate_candidates(wide, ["good", "noise"], grid), ["good", "noise"]).first()
    assert best["w_good"] == 1.0 and best["metric"] > 0.9
    blended = weighted_blend(wide, {"good": 1.0, "noise": 0.0}).collect()
    assert all(r["prediction"] == r["prediction_good"] for r in blended)


def test_pivot_models(spark):
    d = _long(spark).where("seed = 1")
    w = pivot_models(d, ["a", "b"])
    assert w.columns == ["customer_id", "prediction_a", "prediction_b"] and w.count() == 50


def test_pivot_aggregates_after_the_shuffle_only(spark):
    """A key's rows are dealt to one task before they are aggregated: no partial aggregate holds all keys of an input split."""
    from pyspark.sql import functions as F
    from scorewright.operators.ensemble import pivot_models
    rows = [(c, m, (c or 0) + len(m) / 10) for c in [*range(20), None] for m in ("a", "bb") if c != 3 or m == "a"] + [(90, "other", 1.0), (1, "a", None), (2, "bb", 9.0)]
    wide = pivot_models(spark.createDataFrame(rows, "customer_id long, model string, prediction double"), ["a", "bb"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[plan.index("Exchange"):]
    got = {r["customer_id"]: (r["prediction_a"], r["prediction_bb"]) for r in wide.collect()}
    assert len(got) == 22 and got[2] == (2.1, 9.0) and got[3] == (3.1, None) and got[90] == (None, None) and got[1] == (1.1, 1.2)
