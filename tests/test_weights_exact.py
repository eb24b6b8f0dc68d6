"""Candidates that are left are ordered inside their score bins only, with the exact metric of the ordered scan."""

import random

import pytest

from scorewright.operators import weights as W
from scorewright.operators.ensemble import evaluate_candidates
from scorewright.operators.ordered import ROWS_PER_BUCKET_CONF

MODELS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def tied(spark):
    rng = random.Random(5)
    rows = []
    for i in range(500):
        y = int(rng.random() < 0.2)
        rows.append((499 - i, y if i % 40 else None, *[round(min(1.0, max(0.0, rng.gauss(0.4 + s * y, 0.2))), 1) if i % 43 else None for s in (0.2, 0.1, 0.05)]))
    return spark.createDataFrame(rows, "customer_id long, target int, prediction_a double, prediction_b double, prediction_c double").cache()


def test_order_inside_bins_gives_the_exact_metric(spark, tied, monkeypatch):
    points = W.lattice(3, 5)
    want = {r["cand"]: r["metric"] for r in evaluate_candidates(tied, MODELS, [tuple(x / 5 for x in p) for p in points]).collect()}
    whole, calls = W.evaluate_candidates, []
    monkeypatch.setattr(W, "evaluate_candidates", lambda *a: calls.append(1) or whole(*a))
    for bins in (1, 9, 4096):
        level = W.search_level(tied, MODELS, points, len(points), bins=bins)
        assert {points.index(r.point): r.metric for r in level} == want
    assert not calls
    spark.conf.set(ROWS_PER_BUCKET_CONF, "100")
    try:
        level = W.search_level(tied, MODELS, points, len(points), bins=1)
    finally:
        spark.conf.unset(ROWS_PER_BUCKET_CONF)
    assert calls and {points.index(r.point): r.metric for r in level} == want
