"""Blend-weight search: bounds hold, pruning changes no result, refinement finds what an exhaustive search finds."""

import random

import pytest
from pyspark.sql import functions as F

from scorewright.operators import weights as W
from scorewright.operators.ensemble import evaluate_candidates, simplex_grid

MODELS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(3)
    rows = []
    for i in range(700):
        y = int(rng.random() < 0.25)
        rows.append((i, y if i % 50 else None, *[min(1.0, max(0.0, rng.gauss(0.45 + s * y, 0.2))) if i % 41 else None for s in (0.15, 0.1, 0.05)]))
    return spark.createDataFrame(rows, "customer_id long, target int, prediction_a double, prediction_b double, prediction_c double").cache()


def test_bounds_enclose_the_metric(spark, wide):
    points = W.lattice(3, 6)
    assert [tuple(x / 6 for x in p) for p in points] == simplex_grid(3, 6)
    weights = [tuple(x / 6 for x in p) for p in points]
    exact = {r["cand"]: r["metric"] for r in evaluate_candidates(wide, MODELS, weights).collect()}
    for bins in (1, 7, 64, 4096):
        bounds = {r["cand"]: (r["lower"], r["upper"]) for r in W.metric_bounds(wide, MODELS, weights, bins=bins).collect()}
        assert set(bounds) == set(exact)
        assert all(lo <= exact[c] + 1e-12 and exact[c] <= hi + 1e-12 for c, (lo, hi) in bounds.items())
        if bins == 4096:
            assert max(hi - lo for lo, hi in bounds.values()) < 0.05


def test_pruned_candidates_cannot_win(spark, wide):
    weights = [tuple(x / 6 for x in p) for p in W.lattice(3, 6)]
    exact = {r["cand"]: r["metric"] for r in evaluate_candidates(wide, MODELS, weights).collect()}
    for keep in (1, 5):
        level = W.search_level(wide, MODELS, W.lattice(3, 6), keep)
        want = sorted(exact.values(), reverse=True)[:keep]
        assert [r.metric for r in level[:keep]] == want
        pruned = [r for r in level if r.metric is None]
        assert pruned and all(exact[W.lattice(3, 6).index(r.point)] < want[-1] for r in pruned)
    with_scale = wide.withColumns({f"prediction_{m}": F.col(f"prediction_{m}") * 3 - 1 for m in MODELS})
    assert W.search_level(with_scale, MODELS, W.lattice(3, 3), 1)[0].metric is not None


def test_refinement_is_as_good_as_an_exhaustive_search(spark, wide):
    levels = W.refine_weights(wide, MODELS, first_steps=5, finest=0.02)
    best = [level[0].metric for level in levels]
    assert best == sorted(best) and 1 / sum(levels[-1][0].point) < 0.02
    full = W.search_level(W.narrow(wide, MODELS), MODELS, W.lattice(3, 40))
    assert best[-1] >= full[0].metric - 1e-12
    assert all(abs(sum(r.weights) - 1) < 1e-12 and min(r.point) >= 0 for level in levels for r in level)


def test_cells():
    assert len(W.offsets(3)) == 7 and len(W.offsets(4)) == 19
    assert W.around([(2, 0, 0)]) == [(3, 0, 1), (3, 1, 0), (4, 0, 0)]
