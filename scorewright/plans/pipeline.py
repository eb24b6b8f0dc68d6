"""The whole scoring run, in the reference's step order, as one function (and a CLI).

    statement features -> statement model (OOF + fold-averaged test scores)
    -> customer features + stacked score features -> customer models (families x seeds)
    -> seed averaging -> weight search -> weighted blend -> optional external blend

Outputs under ``out_dir`` (use a shared location on a cluster): Parquet feature stores with
their manifests, prediction CSVs, importance CSVs and a JSON summary of the scores.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession, functions as F

from scorewright.operators.ensemble import external_blend, pivot_models, seed_average, weighted_blend
from scorewright.operators.folds import group_folds, stratified_folds
from scorewright.operators.importance import importance_totals
from scorewright.operators.metrics import combined_metric, logloss
from scorewright.operators.models import FAMILIES, SEARCH_SPACE, Learner, train_oof
from scorewright.operators.search import RUNGS, Rung, best_of, halving_search, learner_of
from scorewright.operators.stack import score_features, stack_onto
from scorewright.operators.weights import refine_weights
from scorewright.plans.features import customer_features, statement_features
from scorewright.plans.training import EXCLUDED, STATEMENT_FEATURES, small_budget, statement_model
from scorewright.session import cut_lineage
from scorewright.sources.feature_store import (read_manifest, read_predictions, write_features, write_manifest,
                                               write_predictions, write_text)
from scorewright.sources.fixtures import KEY, train_labels
from scorewright.sources.predictions import SEEDS


def _families(budget: int | None) -> dict[str, Learner]:
    return {k: (small_budget(v, budget) if budget else v) for k, v in FAMILIES.items()}


def _rungs(budget: int | None) -> tuple[Rung, ...]:
    """The search's rungs; a smaller budget caps the boosting rounds of each."""
    return tuple(Rung(min(r.rounds, budget), r.folds, r.keep) for r in RUNGS) if budget else RUNGS


def run(spark: SparkSession, sf_dir: str, out_dir: str, *, seeds=SEEDS, budget: int | None = None,
        grid_steps: int = 10, external_csv: str | None = None, parallelism: int = 2,
        exclude=EXCLUDED, search_trials: int = 0) -> dict:
    """Run every step; returns a summary with output paths and out-of-fold scores.
    ``search_trials > 0`` first searches the statement model's parameters with group folds
    (a restarted run goes on from its ledger) and writes the best ones into the statement-feature
    manifest, from which the statement model is then trained."""
    out = out_dir.rstrip("/")
    summary: dict = {"out_dir": out}

    # 1. statement-level features (feature store + manifest)
    s = cut_lineage(statement_features(spark, sf_dir))
    names = write_features(s.drop("ts"), f"{out}/feats/statement", partition_by="is_test")
    params = None
    if search_trials > 0:
        tr = s.where(~F.col("is_test"))
        tr = tr.join(group_folds(tr).select(KEY, "fold"), KEY, "inner")
        hist = halving_search(tr, STATEMENT_FEATURES, f"{out}/output/search_ledger", n_trials=search_trials, rungs=_rungs(budget),
                              parallelism=parallelism, layout_cols=[KEY, "seq"])
        hist.coalesce(1).write.mode("overwrite").csv(f"{out}/output/search_trials", header=True)
        params = {k: v for k, v in best_of(hist).first().asDict().items() if k in SEARCH_SPACE}
        summary["search_best"] = params
    write_manifest(names, f"{out}/statement_features.json", params, spark)

    # 2. statement model: OOF for training statements, fold-averaged for test ones; the manifest says which
    # columns are features and, after a search, what the learner's parameters are
    manifest = read_manifest(f"{out}/statement_features.json", spark)
    sl = _families(budget)["gbdt"]
    if "params" in manifest:
        sl = learner_of(manifest["params"], sl)
    used = [c for c in STATEMENT_FEATURES if c in manifest["features"]]
    scores, imp = statement_model(spark, sf_dir, sl, parallelism, statements_df=s, features=used)
    importance_totals(imp).coalesce(1).write.mode("overwrite").csv(f"{out}/imp/statement_model", header=True)
    train_scores = scores.where(~F.col("is_test")).join(s.select(KEY, "seq", "target"), [KEY, "seq"])
    summary["statement_logloss"] = logloss(train_scores, "target", "pred_no_agg").first()["logloss"]

    # 3. customer features with the stacked statement scores
    feats = cut_lineage(stack_onto(customer_features(spark, sf_dir, statements_df=s.drop("target")),
                                   score_features(scores)))
    write_features(feats, f"{out}/feats/customer", partition_by="is_test")
    cols = [c for c in feats.columns if c not in exclude]

    # 4. customer models: families x seeds, stratified folds per seed
    long_oof, long_sub = None, None
    for seed in seeds:
        train = stratified_folds(feats.where(~F.col("is_test")), KEY, "target", seed=seed)
        test = feats.where(F.col("is_test"))
        for name, learner in _families(budget).items():
            oof, sub, _ = train_oof(train, test, cols, learner, id_cols=[KEY], seed=seed,
                                    parallelism=parallelism, importance=False)
            tag = [F.lit(name).alias("model"), F.lit(seed).alias("seed")]
            o = oof.select(KEY, *tag, "prediction")
            u = sub.select(KEY, *tag, "prediction")
            long_oof = o if long_oof is None else long_oof.unionByName(o)
            long_sub = u if long_sub is None else long_sub.unionByName(u)
    long_oof, long_sub = cut_lineage(long_oof), cut_lineage(long_sub)
    labels = train_labels(spark, sf_dir)
    models = list(FAMILIES)

    # 5. seed averaging, weight search on the OOF ranks, weighted blend
    oof_sa = pivot_models(seed_average(long_oof), models).join(labels, KEY, "inner")
    sub_sa = pivot_models(seed_average(long_sub), models)
    for m in models:
        summary[f"oof_metric_{m}"] = combined_metric(oof_sa, "target", f"prediction_{m}").first()["metric"]
    best = refine_weights(oof_sa, models, first_steps=grid_steps)[-1][0]
    weights = dict(zip(models, best.weights))
    summary["weights"] = weights
    summary["oof_metric_blend"] = float(best.metric)
    blend_oof = weighted_blend(oof_sa, weights).select(KEY, "target", "prediction")
    blend_sub = weighted_blend(sub_sa, weights).select(KEY, "prediction")
    write_predictions(blend_oof, f"{out}/output/oof_ensemble")
    write_predictions(blend_sub, f"{out}/output/submission_ensemble")

    # 6. optional blend with an external submission (customer_id, prediction)
    if external_csv:
        ext = read_predictions(spark, external_csv)
        write_predictions(external_blend(blend_sub, ext), f"{out}/output/submission_external_blend")
    write_text(spark, f"{out}/summary.json", json.dumps(summary, indent=2, default=float))
    return summary


def main(argv: list[str] | None = None) -> None:
    from scorewright.session import build_session
    ap = argparse.ArgumentParser(description="Run the scoring pipeline end to end.")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out-dir", required=True)
    ap.add_argument("--budget", type=int, default=None, help="boosting rounds / trees per model")
    ap.add_argument("--seeds", default=",".join(map(str, SEEDS)))
    ap.add_argument("--external-csv", default=None)
    ap.add_argument("--search-trials", type=int, default=0, help="random-search trials before training")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = build_session(a.master) if a.master else SparkSession.builder.getOrCreate()
    print(json.dumps(run(spark, a.sf_dir, a.out_dir, seeds=tuple(int(x) for x in a.seeds.split(",")),
                         budget=a.budget, external_csv=a.external_csv, search_trials=a.search_trials),
                     default=float))


if __name__ == "__main__":
    main()
