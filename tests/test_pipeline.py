"""The whole run at the smallest scale factor with a tiny budget: every output exists and
the out-of-fold scores are sane."""

import os
import tempfile

from scorewright.plans.pipeline import run


def test_pipeline_end_to_end(spark):
    out = tempfile.mkdtemp(prefix="scorewright-pipeline-")
    summary = run(spark, "/root/testdata/sf0.001", out, seeds=(42,), budget=4, grid_steps=4, parallelism=5,
                  search_trials=2)
    for sub in ("feats/statement", "feats/customer", "output/oof_ensemble", "output/submission_ensemble",
                "imp/statement_model", "summary.json", "statement_features.json"):
        assert os.path.exists(os.path.join(out, sub)), sub
    assert abs(sum(summary["weights"].values()) - 1.0) < 1e-9
    assert set(summary["search_best"]) >= {"max_depth", "subsample"}
    assert -1.0 <= summary["oof_metric_blend"] <= 1.0
    sub = spark.read.csv(os.path.join(out, "output/submission_ensemble"), header=True)
    assert sub.count() == 50 and sub.select("customer_id").distinct().count() == 50
