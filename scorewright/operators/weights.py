"""Blend-weight search on the simplex: bounds first, exact metric for what is left, finer and finer cells.

* *Bounds.* One pass counts the positives and negatives of every candidate's blend in ``BINS`` score bins: rows of the same
  bin may come in any order, and "positives first" and "negatives first" bound the Gini sum and the captured positives
  from above and below. A candidate whose upper bound is below the best lower bound cannot win and is never sorted. Only
  counts are shuffled (candidates x bins), no rows.
* *Exact metric.* The counts say what stands before each bin, so the order inside each bin is all that is left: the rows of
  the candidates that are not pruned are dealt by (candidate, bin) and ordered there, without a global order, a written
  copy or a sample. Candidates with a bin of more rows than one task may hold take the ordered scan of :mod:`metrics`.
* *Refinement.* A coarse lattice is searched whole; each further level halves the step and takes the points around the
  best few of the level before, until the step is under ``FINEST``. Candidate lists are sized by parameters, never by data.

All counts are exact integers, so the bounds hold for the very numbers that :mod:`metrics` gives."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from scorewright.operators.ensemble import KEY, evaluate_candidates
from scorewright.operators.metrics import _scores
from scorewright.operators.ordered import ROWS_PER_BUCKET, ROWS_PER_BUCKET_CONF
from scorewright.session import cut_lineage

BINS = 4096
#: Candidates that one pass over the rows counts.
BATCH = 64
#: Step of the first lattice, best points around which the next level looks, how far (in steps), and the step at which the search ends.
FIRST_STEPS, STARTS, RADIUS, FINEST = 10, 8, 2, 1e-3


@dataclass(frozen=True)
class Scored:
    """A candidate: lattice numerators, weights, bounds, and the exact metric (None: pruned)."""

    point: tuple[int, ...]
    weights: tuple[float, ...]
    lower: float
    upper: float
    metric: float | None


def lattice(n_models: int, steps: int) -> list[tuple[int, ...]]:
    """All points with non-negative numerators that sum to ``steps``, in lexicographic order."""
    heads = (c for c in itertools.product(range(steps + 1), repeat=n_models - 1) if sum(c) <= steps)
    return [(*c, steps - sum(c)) for c in heads]


def offsets(n_models: int, radius: int = 1) -> list[tuple[int, ...]]:
    """Steps to the points of a cell: numerators change by at most ``radius`` each, and not in sum."""
    return [c for c in itertools.product(range(-radius, radius + 1), repeat=n_models) if sum(c) == 0]


def around(points: list[tuple[int, ...]], radius: int = 1) -> list[tuple[int, ...]]:
    """The lattice of half the step around ``points``, these included."""
    found = {tuple(2 * a + d for a, d in zip(p, o)) for p in points for o in offsets(len(p), radius)}
    return sorted(p for p in found if min(p) >= 0)


def _blend(models: list[str], prefix: str):
    expr = None
    for m in models:
        term = F.col(f"c.w_{m}") * F.col(f"{prefix}{m}")
        expr = term if expr is None else expr + term
    return expr


def _binned(wide: DataFrame, models: list[str], batch: list[tuple], label: str, prefix: str, bins: int, *columns: str) -> DataFrame:
    """``cand, _y, _s, bin`` of every row with a label and a score, and ``columns``, for each (number, weights) of ``batch``."""
    cand = F.explode(F.array(*[F.struct(F.lit(i).alias("cand"), *[F.lit(float(w)).alias(f"w_{m}") for m, w in zip(models, ws)])
                               for i, ws in batch])).alias("c")
    bin_ = F.least(F.greatest(F.floor(F.col("_s") * F.lit(bins)), F.lit(0)), F.lit(bins - 1)).cast("int")
    return (wide.where(F.col(label).isNotNull()).select(F.col(label).cast("long").alias("_y"), *columns, *[f"{prefix}{m}" for m in models], cand)
            .select("c.cand", "_y", *columns, _blend(models, prefix).alias("_s")).where(F.col("_s").isNotNull()).withColumn("bin", bin_))


def _sums(wide: DataFrame, models: list[str], weights: list[tuple[float, ...]], label: str, prefix: str, bins: int) -> DataFrame:
    """Per candidate ``P, N``, the lowest and highest sum and capture that the bins allow, the bin in which the cut falls
    (``cut``), the weight that it has room for, the positives captured ``before`` it, and the rows of the largest bin."""
    parts = None
    for start in range(0, len(weights), BATCH):
        rows = _binned(wide, models, list(enumerate(weights))[start:start + BATCH], label, prefix, bins)
        counted = rows.groupBy("cand", "bin").agg(F.sum("_y").alias("pos"), F.sum(F.lit(1) - F.col("_y")).alias("neg"))
        parts = counted if parts is None else parts.unionByName(counted)
    whole = Window.partitionBy("cand")
    before = whole.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    weight = F.col("pos") + F.lit(20) * F.col("neg")
    b = parts.withColumns({"P": F.sum("pos").over(whole), "N": F.sum("neg").over(whole), "cp": F.coalesce(F.sum("pos").over(before), zero),
                           "cw": F.coalesce(F.sum(weight).over(before), zero)})
    room = F.expr("(P + 20 * N) div 25") - F.col("cw")
    cut = (room >= 0) & (room < weight)

    def held(r):
        return F.least(F.greatest(r, zero), F.col("pos"))

    own = F.expr("CAST(pos AS DECIMAL(18,0)) * cp + CAST(pos AS DECIMAL(18,0)) * (pos + 1) / 2").cast("decimal(28,0)")
    negatives = F.lit(20).cast("decimal(3,0)") * F.col("neg").cast("decimal(12,0)")
    return (b.withColumns({"own": own, "low": negatives * F.col("cp").cast("decimal(12,0)"),
                           "high": negatives * (F.col("cp") + F.col("pos")).cast("decimal(12,0)")})
            .groupBy("cand", "P", "N").agg(F.sum(F.col("own") + F.col("low")).alias("low"), F.sum(F.col("own") + F.col("high")).alias("high"),
                                           F.sum(held(room - F.lit(20) * F.col("neg"))).alias("held_low"), F.sum(held(room)).alias("held_high"),
                                           F.max(F.when(cut, F.col("bin"))).alias("cut"), F.max(F.when(cut, room)).alias("room"),
                                           F.max(F.when(cut, F.col("cp"))).alias("before"), F.max(F.col("pos") + F.col("neg")).alias("most")))


def _with_bounds(sums: DataFrame) -> DataFrame:
    metric = _scores(sums, "perfect")["metric"]
    out = sums.withColumns({"S1": F.col("low"), "captured": F.col("held_low")}).withColumn("lower", metric)
    return out.withColumns({"S1": F.col("high"), "captured": F.col("held_high")}).withColumn("upper", metric)


def metric_bounds(wide: DataFrame, models: list[str], weights: list[tuple[float, ...]], label: str = "target",
                  prefix: str = "prediction_", bins: int = BINS) -> DataFrame:
    """``cand, lower, upper``: bounds of the combined metric of each weight vector (numbered from 0). Rows with a missing
    label or score are ignored; scores outside [0, 1] fall into the first or last bin, which keeps their order."""
    return _with_bounds(_sums(wide, models, weights, label, prefix, bins)).select("cand", "lower", "upper")


def _inside_bins(wide: DataFrame, models: list[str], weights: list[tuple[float, ...]], found: dict, open_: list[int], label: str, key: str,
                 prefix: str, bins: int) -> dict[int, float]:
    """The exact metric of the candidates ``open_``, whose counts are ``found``: the order inside their bins adds, for each
    negative, the positives above it in its bin, and the positives of the cut's bin that there is room for."""
    parts = None
    run = Window.partitionBy("cand", "bin").orderBy("_neg", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for start in range(0, len(open_), BATCH):
        batch = open_[start:start + BATCH]
        limits = F.create_map(*[F.lit(x) for i in batch for x in (i, found[i]["room"])])
        cuts = F.create_map(*[F.lit(x) for i in batch for x in (i, found[i]["cut"])])
        rows = _binned(wide, models, [(i, weights[i]) for i in batch], label, prefix, bins, key).withColumn("_neg", -F.col("_s").cast("double"))
        rows = rows.select("cand", "bin", "_neg", key, "_y").withColumns({"rp": F.sum("_y").over(run), "rn": F.count(F.lit(1)).over(run)})
        of_bin = rows.groupBy("cand", "bin").agg(
            F.sum(F.when(F.col("_y") == 0, F.col("rp")).otherwise(F.lit(0))).alias("above"),
            F.sum(F.when((F.col("bin") == cuts[F.col("cand")]) & (F.col("rp") + F.lit(20) * (F.col("rn") - F.col("rp")) <= limits[F.col("cand")]),
                         F.col("_y")).otherwise(F.lit(0))).alias("held"))
        got = of_bin.groupBy("cand").agg(F.sum(F.col("above").cast("decimal(28,0)")).alias("above"), F.sum("held").alias("held"))
        parts = got if parts is None else parts.unionByName(got)
    sums = [(r["cand"], found[r["cand"]]["P"], found[r["cand"]]["N"], found[r["cand"]]["low"] + 20 * r["above"], found[r["cand"]]["before"] + r["held"])
            for r in parts.collect()]
    comp = wide.sparkSession.createDataFrame(sums, "cand int, P long, N long, S1 decimal(38,0), captured long")
    return {r["cand"]: r["metric"] for r in comp.select("cand", _scores(comp, "perfect")["metric"].alias("metric")).collect()}


def search_level(wide: DataFrame, models: list[str], points: list[tuple[int, ...]], keep: int = 1, label: str = "target", key: str = KEY,
                 prefix: str = "prediction_", bins: int = BINS) -> list[Scored]:
    """Bounds of every point, and the exact metric of those that may be among the best ``keep``; best first, then pruned
    ones. Equal metrics are in the order of their weights. One row a candidate reaches the driver."""
    weights = [tuple(a / sum(p) for a in p) for p in points]
    found = {r["cand"]: r for r in _with_bounds(_sums(wide, models, weights, label, prefix, bins)).collect()}
    bounds = [(found[i]["lower"], found[i]["upper"]) if i in found else (None, None) for i in range(len(points))]
    floors = sorted((lo for lo, _ in bounds if lo is not None), reverse=True)
    floor = floors[min(keep, len(floors)) - 1] if floors else None
    open_ = [i for i, (_, hi) in enumerate(bounds) if hi is not None and hi >= floor]
    most = int(wide.sparkSession.conf.get(ROWS_PER_BUCKET_CONF, str(ROWS_PER_BUCKET)))
    hot = [i for i in open_ if found[i]["most"] > most]
    even = [i for i in open_ if found[i]["most"] <= most]
    exact = _inside_bins(wide, models, weights, found, even, label, key, prefix, bins) if even else {}
    if hot:
        scored = evaluate_candidates(wide, models, [weights[i] for i in hot], label, key, prefix, BATCH).select("cand", "metric").collect()
        exact |= {hot[r["cand"]]: r["metric"] for r in scored}
    rows = [Scored(p, w, lo, hi, exact.get(i)) for i, (p, w, (lo, hi)) in enumerate(zip(points, weights, bounds))]
    return sorted(rows, key=lambda r: (r.metric is None, -(r.metric or 0.0), r.point))


def narrow(wide: DataFrame, models: list[str], label: str = "target", key: str = KEY, prefix: str = "prediction_") -> DataFrame:
    """The columns of the search, written once: every level reads them."""
    return cut_lineage(wide.select(key, label, *[f"{prefix}{m}" for m in models]))


def refine_weights(wide: DataFrame, models: list[str], label: str = "target", key: str = KEY, prefix: str = "prediction_",
                   first_steps: int = FIRST_STEPS, starts: int = STARTS, finest: float = FINEST, radius: int = RADIUS) -> list[list[Scored]]:
    """The levels of the search, coarse to fine; the best point of each is its first entry and is never worse than the
    one before."""
    wide = narrow(wide, models, label, key, prefix)
    steps, points, levels = first_steps, lattice(len(models), first_steps), []
    while True:
        level = search_level(wide, models, points, starts, label, key, prefix)
        levels.append(level)
        best = [r.point for r in level[:starts] if r.metric is not None]
        if 1 / steps < finest or not best:
            return levels
        steps, points = 2 * steps, around(best, radius)


def best_weights(wide: DataFrame, models: list[str], steps: int, label: str = "target", key: str = KEY, prefix: str = "prediction_") -> Scored:
    """The best point of one lattice, with all others pruned or scored."""
    return search_level(narrow(wide, models, label, key, prefix), models, lattice(len(models), steps), 1, label, key, prefix)[0]
