"""Training sanity: OOF covers each row once, a planted signal is learnt, the
evaluators agree with the metric operator, and the search returns its trial history."""

import math

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from scorewright.operators.metrics import CompetitionEvaluator, combined_metric
from scorewright.operators.models import FAMILIES, best_trial, random_search, train_oof
from scorewright.plans.training import small_budget


def _planted(spark, n=600):
    rows = []
    for i in range(n):
        y = int(i % 5 == 0)
        rows.append((i, y, (i // 5) % 5, float(y * 2 + (i % 7) / 7.0), float((i * 13) % 11), None if i % 9 == 0 else 1.0))
    return spark.createDataFrame(rows, "customer_id long, target int, fold int, signal double, noise double, "
                                       "sparse double")


def test_oof_covers_each_row_once_and_learns(spark):
    df = _planted(spark)
    oof, sub, imp = train_oof(df, df.limit(50), ["signal", "noise", "sparse"], small_budget(FAMILIES["gbdt"], 8),
                              id_cols=["customer_id"])
    rows = oof.collect()
    assert len(rows) == 600 and len({r["customer_id"] for r in rows}) == 600
    m = combined_metric(oof.join(df.select("customer_id", "target"), "customer_id")).first()["metric"]
    assert m > 0.8
    top = imp.groupBy("feature").agg(F.avg("importance").alias("i")).orderBy(F.desc("i")).first()["feature"]
    assert top.startswith("signal")
    assert sub.count() == 50


def test_competition_evaluator_matches_operator(spark):
    rows = [(i, float(i % 3 == 0), Vectors.dense([1 - (i % 10) / 10, (i % 10) / 10])) for i in range(200)]
    df = spark.createDataFrame(rows, ["customer_id", "label", "probability"])
    ev = CompetitionEvaluator(labelCol="label", scoreCol="probability", idCol="customer_id")
    direct = combined_metric(df.select("customer_id", "label", F.col("probability").alias("p"))
                             .withColumn("s", F.udf(lambda v: float(v[1]), "double")("p")), "label", "s").first()
    assert math.isclose(ev.evaluate(df), direct["metric"], rel_tol=1e-12) and ev.isLargerBetter()


def test_random_search_history(spark):
    df = _planted(spark, 300)
    hist = random_search(df, ["signal", "noise"], n_trials=2, max_iter=3)
    assert hist.count() == 2 and {"trial", "max_depth", "value"} <= set(hist.columns)
    b = best_trial(hist).first()
    assert b["value"] == min(r["value"] for r in hist.collect())


def test_same_seed_same_scores(spark):
    df = _planted(spark, 300)
    learner = small_budget(FAMILIES["gbdt_deep"], 4)
    a, _, _ = train_oof(df, None, ["signal", "noise", "sparse"], learner, id_cols=["customer_id"], seed=7,
                        importance=False)
    b, _, _ = train_oof(df.repartition(3), None, ["signal", "noise", "sparse"], learner, id_cols=["customer_id"],
                        seed=7, importance=False)
    assert sorted(a.collect()) == sorted(b.collect())


def test_training_matrix_has_a_short_lineage_and_leaves_no_files(spark):
    """Every task of a boosting round is sent the matrix's lineage; the checkpoint's files go with the matrix."""
    import glob
    from scorewright.session import ensure_checkpoint_dir, hold, let_go
    df = _planted(spark).repartition(3, "customer_id").sortWithinPartitions("customer_id")
    before = df.collect()
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    files = set(glob.glob(f"{folder}/**/part-*", recursive=True))
    held = hold(df)
    assert held.collect() == before and held.rdd.getNumPartitions() == 3
    assert "Exchange" not in held._jdf.queryExecution().executedPlan().toString()
    assert set(glob.glob(f"{folder}/**/part-*", recursive=True)) > files
    let_go(held)
    assert set(glob.glob(f"{folder}/**/part-*", recursive=True)) == files


def test_large_matrices_get_partitions_by_their_cells(spark):
    """The work that a task has besides its rows must not outweigh them: 900,000 statements are not cut into 45 partitions."""
    from scorewright.operators.models import PARTITION_CELLS, laid_out, matrix_partitions
    assert matrix_partitions(0, 24) == matrix_partitions(20_000, 1000) == 1
    assert matrix_partitions(900_000, 24) == 6 and matrix_partitions(9_000_000, 24) == 54
    # wide rows: as many partitions as before, at most
    assert matrix_partitions(90_000, 1000) == 5
    for rows, features in ((10**6, 24), (10**7, 170), (10**9, 24)):
        parts = matrix_partitions(rows, features)
        assert rows / parts >= 20_000 - 1 and rows * 2 * features / parts <= max(PARTITION_CELLS, 20_000 * 2 * features)
    rows = spark.range(50_000).withColumnRenamed("id", "customer_id")
    assert laid_out(rows, ["customer_id"], 3).rdd.getNumPartitions() == 1


def test_small_matrices_are_read_from_the_checkpoint(spark):
    """Fits over a persisted block all run where it is: a matrix of a few partitions is not persisted, one of many is."""
    from scorewright.session import hold, let_go
    few, many = hold(spark.range(100).repartition(2, "id")), hold(spark.range(100).repartition(8, "id"))
    assert not few.is_cached and few.count() == 100
    assert many.is_cached and many.count() == 100
    let_go(few)
    let_go(many)
