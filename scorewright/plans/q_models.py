"""Registered queries: ranks, metrics, folds, stacking and ensembles (build-plan steps 4-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.functions.hashing import unit_score
from scorewright.functions.numeric import comparable
from scorewright.operators.aggregate import SCORE_AGGS
from scorewright.operators.ensemble import (BY_AGG_SELECTED, BY_AGG_WEIGHTS, EXTERNAL_BLEND, SEED_AVG_WEIGHTS,
                                            external_blend, pivot_models,
                                            rank_pivot, seed_average, simplex_grid, weighted_blend)
from scorewright.operators.folds import group_folds, group_stratified_folds, stratified_folds
from scorewright.operators.joins import spine_join, union_train_test
from scorewright.operators.metrics import combined_metric, logloss, roc_points
from scorewright.operators.rank import rank_normalize
from scorewright.operators.weights import BINS, FINEST, RADIUS, STARTS, best_weights, lattice, narrow, offsets, refine_weights, search_level
from scorewright.operators.stack import fold_average, score_diff, score_features
from scorewright.plans import oracle as O
from scorewright.plans.registry import ORACLES, register
from scorewright.session import cut_lineage
from scorewright.sources.fixtures import KEY, statements, test_spine, train_labels
from scorewright.sources.predictions import (AGG_MODELS, MODELS, external_scores, fold_scores, prediction_long,
                                             statement_scores)
from scorewright.sources.tables import read_table

W = "WITH " + O.STATEMENTS


def _oof(spark, sf_dir, ties=False, seed=None, model=None):
    d = prediction_long(spark, sf_dir, "oof", ties=ties)
    if seed is not None:
        d = d.where(F.col("seed") == seed)
    if model is not None:
        d = d.where(F.col("model") == model)
    return d


# --- step 4: ranks and metrics ---------------------------------------------------------------

# every 11th customer has no score: its rank stays missing but it still counts in n
_RANK_SRC = (O.pred_long_cte("p0", ties=True) + ",\n"
             "p AS (SELECT customer_id, model, seed, CASE WHEN customer_id % 11 = 0 THEN NULL "
             "ELSE prediction END AS prediction FROM p0)")


@register("rank_normalize", W + ",\n" + _RANK_SRC + "\nSELECT customer_id, model, seed, "
          "CAST(prediction AS FLOAT) AS prediction, CAST(" + O.rank_norm_sql("prediction", ["model", "seed"])
          + " AS FLOAT) AS rank_norm FROM p")
def q_rank_normalize(spark, sf_dir):
    d = _oof(spark, sf_dir, ties=True).drop("target")
    d = d.withColumn("prediction", F.when(F.col(KEY) % 11 == 0, F.lit(None).cast("double"))
                     .otherwise(F.col("prediction")))
    return comparable(rank_normalize(d, "prediction", ["model", "seed"]).select(
        KEY, "model", "seed", "prediction", "rank_norm"))


def _metric_query(name, cols, variant="mod", ties=False, pk=("model", "seed"), seed=None):
    where = f" WHERE seed = {seed}" if seed is not None else ""
    src = O.pred_long_cte("p0", ties=ties) + f",\np AS (SELECT * FROM p0{where})"
    sql = (W + ",\n" + src + ",\n" + O.metric_ctes("p", list(pk), "target", "prediction", "customer_id", variant)
           + "\nSELECT " + ", ".join(list(pk) + [f"CAST({c} AS FLOAT) AS {c}" for c in cols]) + " FROM m_r")

    def q(spark, sf_dir):
        d = _oof(spark, sf_dir, ties=ties, seed=seed)
        m = combined_metric(d, "target", "prediction", KEY, partition_by=list(pk), variant=variant)
        return comparable(m.select(*pk, *cols))
    register(name, sql)(q)


_metric_query("metric_gini", ["gini"])
_metric_query("metric_capture", ["capture"])
_metric_query("metric_combined", ["gini", "capture", "metric"], ties=True)
_metric_query("metric_combined_np", ["gini", "capture", "metric"], variant="np")



@register("metric_rounded", ORACLES["metric_combined"].replace("CAST(gini AS FLOAT) AS gini, CAST(capture AS FLOAT) AS capture, CAST(metric AS FLOAT) AS metric",
                                                               "round(metric, 6) AS metric"))
def q_metric_rounded(spark, sf_dir):
    """The metric of every run rounded to six digits, as it is reported."""
    m = combined_metric(_oof(spark, sf_dir, ties=True), "target", "prediction", KEY, partition_by=["model", "seed"])
    return m.select("model", "seed", F.round("metric", 6).alias("metric"))


_LABELS_SCORE = O.score_sql("'doc'", "0", "doc_id", "quality")


@register("metric_labels", "WITH l AS (SELECT doc_id, quality, " + _LABELS_SCORE + " AS s FROM labels),\n"
          + O.metric_ctes("l", [], "quality", "s", "doc_id") +
          "\nSELECT CAST(gini AS FLOAT) AS gini, CAST(capture AS FLOAT) AS capture, "
          "CAST(metric AS FLOAT) AS metric FROM m_r")
def q_metric_labels(spark, sf_dir):
    """The combined metric on a second class balance (labels.quality, mostly positive)."""
    lab = read_table(spark, sf_dir, "labels")
    d = lab.select("doc_id", "quality", (unit_score(F.lit("doc"), F.lit(0), "doc_id") * F.lit(0.7)
                                         + F.lit(0.3) * F.col("quality")).alias("s"))
    return comparable(combined_metric(d, "quality", "s", "doc_id"))


_LL_SQL = (W + ",\n" + O.pred_long_cte("p") + "\nSELECT model, seed, CAST(AVG(-(CAST(target AS DOUBLE) * "
           "ln(least(greatest(prediction, 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE)) + (1.0::DOUBLE - "
           "CAST(target AS DOUBLE)) * ln(1.0::DOUBLE - least(greatest(prediction, 1e-15::DOUBLE), "
           "1.0::DOUBLE - 1e-15::DOUBLE)))) AS FLOAT) AS logloss FROM p GROUP BY model, seed")


@register("metric_logloss", _LL_SQL)
def q_metric_logloss(spark, sf_dir):
    return comparable(logloss(_oof(spark, sf_dir), partition_by=["model", "seed"]))


_FOLDS_SQL_CTE = ("k AS (SELECT customer_id, target, md5(concat_ws(':', '42', CAST(customer_id AS VARCHAR))) AS h "
                  "FROM lab),\nkf AS (SELECT customer_id, target, CAST((row_number() OVER (PARTITION BY target "
                  "ORDER BY h, customer_id) - 1) % 5 AS INTEGER) AS fold FROM k)")


@register("metric_by_fold", W + ",\n" + _FOLDS_SQL_CTE + ",\n" + O.pred_long_cte("p0") + ",\n"
          "p AS (SELECT p0.*, kf.fold FROM p0 JOIN kf USING (customer_id)),\n"
          + O.metric_ctes("p", ["model", "seed", "fold"], "target", "prediction", "customer_id", prefix="f") + ",\n"
          + O.metric_ctes("p", ["model", "seed"], "target", "prediction", "customer_id", prefix="o") +
          "\nSELECT model, seed, fold, CAST(gini AS FLOAT) AS gini, CAST(capture AS FLOAT) AS capture, "
          "CAST(metric AS FLOAT) AS metric FROM f_r UNION ALL SELECT model, seed, CAST(NULL AS INTEGER) AS fold, "
          "CAST(gini AS FLOAT), CAST(capture AS FLOAT), CAST(metric AS FLOAT) FROM o_r")
def q_metric_by_fold(spark, sf_dir):
    """Fold scores and the overall out-of-fold score of every run (I12); the overall row has fold NULL."""
    folds = stratified_folds(train_labels(spark, sf_dir)).select(KEY, "fold")
    # the long table looks as small as the customer file it is exploded from: never built into a broadcast
    d = cut_lineage(_oof(spark, sf_dir).hint("shuffle_merge").join(folds, on=KEY, how="inner"))
    per_fold = combined_metric(d, partition_by=["model", "seed", "fold"])
    overall = combined_metric(d, partition_by=["model", "seed"]).withColumn("fold", F.lit(None).cast("int"))
    return comparable(per_fold.unionByName(overall))


@register("roc_points", W + ",\n" + O.pred_long_cte("p", ties=True) + ",\n"
          "g AS (SELECT model, seed, prediction AS threshold, SUM(target) AS pos, SUM(1 - target) AS neg FROM p GROUP BY ALL),\n"
          "c AS (SELECT model, seed, threshold, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM g WINDOW w AS (PARTITION BY "
          "model, seed ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),\n"
          "t AS (SELECT model, seed, SUM(target) AS P, SUM(1 - target) AS N FROM p GROUP BY ALL)\n"
          "SELECT model, seed, CAST(threshold AS FLOAT) AS threshold, CAST(tp / P AS FLOAT) AS tpr, CAST(fp / N AS FLOAT) AS fpr "
          "FROM c JOIN t USING (model, seed)")
def q_roc_points(spark, sf_dir):
    """Points of the ROC curve of every run."""
    return comparable(roc_points(_oof(spark, sf_dir, ties=True), partition_by=["model", "seed"]))


# --- step 5: folds ---------------------------------------------------------------------------------

@register("kfold_stratified", W + ",\n" + _FOLDS_SQL_CTE + "\nSELECT customer_id, target, fold FROM kf")
def q_kfold_stratified(spark, sf_dir):
    return stratified_folds(train_labels(spark, sf_dir)).select(KEY, "target", "fold")


@register("kfold_group_stratified", W + ",\n" + _FOLDS_SQL_CTE +
          "\nSELECT s0.customer_id, s0.seq, kf.fold FROM s0 LEFT JOIN kf USING (customer_id) WHERE NOT s0.is_test")
def q_kfold_group_stratified(spark, sf_dir):
    s = statements(spark, sf_dir).where(~F.col("is_test")).select(KEY, "seq")
    return group_stratified_folds(s, train_labels(spark, sf_dir)).select(KEY, "seq", "fold")


def _greedy_folds_sql(k: int = 5) -> str:
    """Every customer in turn, largest first, to the lightest fold; a fold takes a run of the customers of one size."""
    loads = [f"l{f}" for f in range(k)]
    least = f"least({', '.join(loads)})"
    pick = "CASE " + " ".join(f"WHEN l{f} = {least} THEN {f}" for f in range(k)) + " END"
    return (W + """,
n AS (SELECT customer_id, COUNT(*) AS n_rows FROM s0 WHERE NOT is_test GROUP BY customer_id),
o AS MATERIALIZED (SELECT n_rows, row_number() OVER (ORDER BY n_rows DESC) AS i FROM n),
deal AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS INTEGER) AS fold, CAST(NULL AS BIGINT) AS n_rows, """
            + ", ".join(f"CAST(0 AS BIGINT) AS {x}" for x in loads) + f"""
  UNION ALL SELECT o.i, {pick}, o.n_rows, """ + ", ".join(f"l{f} + CASE WHEN {pick} = {f} THEN o.n_rows ELSE 0 END" for f in range(k)) + """
  FROM deal JOIN o ON o.i = deal.i + 1),
runs AS (SELECT n_rows, fold, SUM(COUNT(*)) OVER (PARTITION BY n_rows ORDER BY fold) AS hi, COUNT(*) AS m FROM deal WHERE i > 0 GROUP BY n_rows, fold),
r AS (SELECT customer_id, n_rows, row_number() OVER (PARTITION BY n_rows ORDER BY customer_id) AS pos FROM n)
SELECT r.customer_id, r.n_rows, runs.fold FROM r JOIN runs ON r.n_rows = runs.n_rows AND r.pos > hi - m AND r.pos <= hi""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("kfold_group", _greedy_folds_sql())
def q_kfold_group(spark, sf_dir):
    """Group k-fold with balanced rows: customers dealt largest first to the lightest fold."""
    s = statements(spark, sf_dir).where(~F.col("is_test"))
    return group_folds(s).select(KEY, "n_rows", "fold")


# --- step 6: stacking ------------------------------------------------------------------------------

_SS = O.STATEMENT_SCORES


@register("score_diff", W + ",\n" + _SS + "\nSELECT customer_id, seq, CAST(pred_no_agg AS FLOAT) AS pred_no_agg, "
          "CAST(pred_no_agg_diff AS FLOAT) AS pred_no_agg_diff FROM sd")
def q_score_diff(spark, sf_dir):
    d = score_diff(statement_scores(spark, sf_dir))
    return comparable(d.select(KEY, "seq", "pred_no_agg", "pred_no_agg_diff"))


def _stack_sql() -> str:
    raw, outs = [], []
    for c in ("pred_no_agg", "pred_no_agg_diff"):
        for a in SCORE_AGGS:
            raw.append(f"{O.agg_sql(a, c)[0]} AS {c}_{a}")
            outs.append(f"CAST(g.{c}_{a} AS FLOAT) AS {c}_{a}")
    return (W + ",\n" + _SS + f",\ng AS (SELECT customer_id, {', '.join(raw)} FROM sd GROUP BY customer_id),\n"
            "sp AS (SELECT customer_id, target, FALSE AS is_test FROM lab UNION ALL "
            "SELECT customer_id, CAST(NULL AS INTEGER) AS target, TRUE AS is_test FROM tspine)\n"
            f"SELECT sp.customer_id, sp.target, sp.is_test, {', '.join(outs)} FROM sp LEFT JOIN g USING (customer_id)")


@register("stack_features", _stack_sql())
def q_stack_features(spark, sf_dir):
    """Statement-model score -> customer features (I10): OOF rows for training customers and
    fold-averaged rows for test customers come as one statement-level score table."""
    feats = score_features(statement_scores(spark, sf_dir))
    train = spine_join(train_labels(spark, sf_dir), feats)
    test = spine_join(test_spine(spark, sf_dir), feats)
    return comparable(union_train_test(train, test))


@register("fold_average", W + ",\nf AS (SELECT t.customer_id, " + O.score_sql("'fold'", "k.fold", "t.customer_id", "t.truth")
          + " AS prediction FROM truth t CROSS JOIN (VALUES (0), (1), (2), (3), (4)) k(fold) WHERE t.is_test)\n"
          "SELECT customer_id, CAST(AVG(prediction) AS FLOAT) AS prediction FROM f GROUP BY customer_id")
def q_fold_average(spark, sf_dir):
    return comparable(fold_average(fold_scores(spark, sf_dir)))


@register("prediction_csv_roundtrip", W + ",\nf AS (SELECT t.customer_id, " + O.score_sql("'fold'", "k.fold", "t.customer_id", "t.truth")
          + " AS prediction FROM truth t CROSS JOIN (VALUES (0), (1), (2), (3), (4)) k(fold) WHERE t.is_test)\n"
          "SELECT customer_id, CAST(AVG(prediction) AS FLOAT) AS prediction FROM f GROUP BY customer_id")
def q_prediction_csv_roundtrip(spark, sf_dir):
    """Fold-averaged test scores written as a submission CSV and read back with an explicit
    schema (A2, A3, A6): the file path is in the shared checkpoint folder."""
    import uuid
    from scorewright.session import shared_dir
    from scorewright.sources.feature_store import read_predictions, write_predictions
    path = shared_dir(spark, f"submissions/{uuid.uuid4().hex}")
    write_predictions(fold_average(fold_scores(spark, sf_dir)), path)
    return comparable(read_predictions(spark, path))


# --- step 7: ensembles ------------------------------------------------------------------------------

_PIVOT = ", ".join(f"MAX(CASE WHEN model = '{m}' THEN prediction END) AS prediction_{m}" for m in MODELS)


@register("pivot_predictions", W + ",\n" + O.pred_long_cte("p") +
          f"\nSELECT customer_id, target, seed, " + ", ".join(f"CAST(prediction_{m} AS FLOAT) AS prediction_{m}" for m in MODELS)
          + f" FROM (SELECT customer_id, target, seed, {_PIVOT} FROM p GROUP BY customer_id, target, seed)")
def q_pivot_predictions(spark, sf_dir):
    """The models' predictions side by side, for every seed (C4)."""
    return comparable(pivot_models(_oof(spark, sf_dir), list(MODELS), keys=[KEY, "target", "seed"]))


def _seed_avg_ctes(src_cte: str, name: str = "sa") -> str:
    return (f"{name}_r AS (SELECT customer_id, model, seed, {O.avg_rank_sql('prediction', ['model', 'seed'])} AS ar "
            f"FROM {src_cte}),\n{name}_a AS (SELECT model, customer_id, SUM(ar) AS sar FROM {name}_r "
            f"GROUP BY model, customer_id),\n{name} AS (SELECT customer_id, model, "
            f"{O.rank_norm_sql('sar', ['model'])} AS prediction FROM {name}_a)")


@register("seed_average", W + ",\n" + O.pred_long_cte("p", ties=True) + ",\n" + _seed_avg_ctes("p") +
          "\nSELECT customer_id, model, CAST(prediction AS FLOAT) AS prediction FROM sa")
def q_seed_average(spark, sf_dir):
    return comparable(seed_average(_oof(spark, sf_dir, ties=True).drop("target")))


def _blend_expr(prefix: str = "") -> str:
    return " + ".join(f"{w}::DOUBLE * {prefix}prediction_{m}" for m, w in SEED_AVG_WEIGHTS.items())


_SA_PIVOT = ("sw AS (SELECT customer_id, " + _PIVOT + " FROM sa GROUP BY customer_id)")


@register("blend_weighted", W + ",\n" + O.pred_long_cte("p") + ",\n" + _seed_avg_ctes("p") + ",\n" + _SA_PIVOT +
          f"\nSELECT customer_id, CAST({_blend_expr()} AS FLOAT) AS prediction FROM sw")
def q_blend_weighted(spark, sf_dir):
    sa = seed_average(_oof(spark, sf_dir).drop("target"))
    wide = pivot_models(sa, list(MODELS))
    return comparable(weighted_blend(wide, SEED_AVG_WEIGHTS).select(KEY, "prediction"))


_EXT = ("ext AS (SELECT t.customer_id, " + O.score_sql("'ext'", "0", "t.customer_id", "t.truth") +
        " AS prediction FROM truth t WHERE t.is_test)")


@register("blend_external", W + ",\n" + O.pred_long_cte("p", split="sub") + ",\n" + _seed_avg_ctes("p") + ",\n"
          + _SA_PIVOT + ",\n" + _EXT + ",\n"
          f"own AS (SELECT customer_id, {_blend_expr()} AS prediction FROM sw),\n"
          f"ro AS (SELECT customer_id, {O.rank_norm_sql('prediction', [])} AS r FROM own),\n"
          f"rx AS (SELECT customer_id, {O.rank_norm_sql('prediction', [])} AS r FROM ext),\n"
          f"mix AS (SELECT ro.customer_id, {EXTERNAL_BLEND[0]}::DOUBLE * ro.r + {EXTERNAL_BLEND[1]}::DOUBLE * rx.r AS m "
          f"FROM ro LEFT JOIN rx USING (customer_id))\n"
          f"SELECT customer_id, CAST({O.rank_norm_sql('m', [])} AS FLOAT) AS prediction FROM mix")
def q_blend_external(spark, sf_dir):
    sa = seed_average(prediction_long(spark, sf_dir, "sub"))
    own = weighted_blend(pivot_models(sa, list(MODELS)), SEED_AVG_WEIGHTS).select(KEY, "prediction")
    return comparable(external_blend(own, external_scores(spark, sf_dir)))


GRID_STEPS = 10


def _best_row(spark, models, best):
    """The best candidate as a table of one row."""
    return comparable(spark.createDataFrame([(*best.weights, best.metric)], ", ".join(f"w_{m} double" for m in models) + ", metric double"))


def _search_sql() -> str:
    cands = simplex_grid(len(MODELS), GRID_STEPS)
    vals = ", ".join(f"({i}, " + ", ".join(f"{w!r}::DOUBLE" for w in c) + ")" for i, c in enumerate(cands))
    wcols = ", ".join(f"w_{m}" for m in MODELS)
    blend = " + ".join(f"c.w_{m} * o.prediction_{m}" for m in MODELS)
    return (W + ",\n" + O.pred_long_cte("p") + ",\n" + _seed_avg_ctes("p") + ",\n" + _SA_PIVOT + ",\n"
            "o AS (SELECT sw.*, lab.target FROM sw JOIN lab USING (customer_id)),\n"
            f"cands AS (SELECT * FROM (VALUES {vals}) v(cand, {wcols})),\n"
            f"b AS (SELECT c.cand, o.customer_id, o.target, {blend} AS s FROM o CROSS JOIN cands c),\n"
            + O.metric_ctes("b", ["cand"], "target", "s", "customer_id") +
            f"\nSELECT " + ", ".join(f"CAST(w_{m} AS FLOAT) AS w_{m}" for m in MODELS) +
            ", CAST(metric AS FLOAT) AS metric FROM m_r JOIN cands USING (cand) ORDER BY metric DESC, cand ASC LIMIT 1")


@register("blend_weight_search", _search_sql())
def q_blend_weight_search(spark, sf_dir):
    """Best blend weights on the simplex grid (step 1/10) by the combined metric on the
    seed-averaged out-of-fold ranks (I14, I17): 66 candidates, of which only those whose bound may win are sorted."""
    sa = seed_average(_oof(spark, sf_dir).drop("target"))
    wide = pivot_models(sa, list(MODELS)).join(train_labels(spark, sf_dir), on=KEY, how="inner")
    return _best_row(spark, list(MODELS), best_weights(wide, list(MODELS), GRID_STEPS))


def _blend_sql(n: str) -> str:
    return " + ".join(f"(c.a{i} / {n}.0::DOUBLE) * o.prediction_{m}" for i, m in enumerate(MODELS))


_OOF_RANKS = (W + ",\n" + O.pred_long_cte("p") + ",\n" + _seed_avg_ctes("p") + ",\n" + _SA_PIVOT + ",\n"
              "o AS MATERIALIZED (SELECT sw.*, lab.target FROM sw JOIN lab USING (customer_id))")
_POINT = [f"a{i}" for i in range(len(MODELS))]


def _level_ctes(level: int, steps: int) -> str:
    """Blends and exact metrics of the points of table ``c<level>``."""
    point = ", ".join(_POINT)
    return (f"b{level} AS (SELECT {point}, o.customer_id, o.target, {_blend_sql(str(steps))} AS s FROM o CROSS JOIN c{level} c),\n"
            + O.metric_ctes(f"b{level}", _POINT, "target", "s", "customer_id", prefix=f"l{level}"))


def _points_sql(points) -> str:
    return ", ".join("(" + ", ".join(map(str, p)) + ")" for p in points)


def _refined_sql() -> str:
    """Every level of the refinement as a few tables: points, blends, exact metrics of all, the best few."""
    point, steps, level = ", ".join(_POINT), GRID_STEPS, 0
    out = [_OOF_RANKS, f"c0 AS (SELECT * FROM (VALUES {_points_sql(lattice(len(MODELS), steps))}) v({point}))", _level_ctes(0, steps)]
    while 1 / steps >= FINEST:
        steps, level = 2 * steps, level + 1
        moved = ", ".join(f"2 * {a} + d{a} AS {a}" for a in _POINT)
        out += [f"k{level} AS MATERIALIZED (SELECT * FROM l{level - 1}_r ORDER BY metric DESC, {point} LIMIT {STARTS})",
                f"c{level} AS MATERIALIZED (SELECT DISTINCT {moved} FROM k{level} CROSS JOIN (VALUES {_points_sql(offsets(len(MODELS), RADIUS))}) "
                f"d({', '.join('d' + a for a in _POINT)}) WHERE " + " AND ".join(f"2 * {a} + d{a} >= 0" for a in _POINT) + ")", _level_ctes(level, steps)]
    return (",\n".join(out) + "\nSELECT " + ", ".join(f"CAST({a} / {steps}.0::DOUBLE AS FLOAT) AS w_{m}" for a, m in zip(_POINT, MODELS))
            + f", CAST(metric AS FLOAT) AS metric FROM l{level}_r ORDER BY metric DESC, {point} LIMIT 1")


def _seed_averaged(spark, sf_dir):
    sa = seed_average(_oof(spark, sf_dir).drop("target"))
    return pivot_models(sa, list(MODELS)).join(train_labels(spark, sf_dir), on=KEY, how="inner")


@register("blend_weight_refined", _refined_sql())
def q_blend_weight_refined(spark, sf_dir):
    """Best blend weights down to a step under 1/1000 (I14, J4): the whole lattice at 1/10, then level by level the points
    around the best eight, every level bounded in one pass before anything is sorted."""
    return _best_row(spark, list(MODELS), refine_weights(_seed_averaged(spark, sf_dir), list(MODELS))[-1][0])


def _bounds_sql() -> str:
    n, cut = str(GRID_STEPS), "(big_p + 20 * big_n) // 25"
    total = "(big_p + 20 * big_n)"
    part = f"(({total} * {total} + big_p + 400 * big_n) / 2)"
    gmax = f"((big_p * (big_p + 1) / 2 + 20 * big_n * big_p) / big_p - {part} / {total})"

    def metric(s1, held):
        return f"0.5::DOUBLE * (({s1} / big_p - {part} / {total}) / {gmax} + {held} / big_p)"

    own = "p * cp + p * (p + 1) / 2"
    point = ", ".join(_POINT)
    return (f"""{_OOF_RANKS},
c0 AS (SELECT * FROM (VALUES {_points_sql(lattice(len(MODELS), GRID_STEPS))}) v({point})),
{_level_ctes(0, GRID_STEPS)},
h AS (SELECT {point}, CAST(least(greatest(floor(s * {BINS}), 0), {BINS - 1}) AS INTEGER) AS bin, CAST(SUM(target) AS BIGINT) AS p,
  CAST(SUM(1 - target) AS BIGINT) AS n FROM b0 GROUP BY ALL),
hw AS (SELECT *, CAST(SUM(p) OVER w AS BIGINT) AS big_p, CAST(SUM(n) OVER w AS BIGINT) AS big_n,
  CAST(coalesce(SUM(p) OVER before, 0) AS BIGINT) AS cp, CAST(coalesce(SUM(p + 20 * n) OVER before, 0) AS BIGINT) AS cw
  FROM h WINDOW w AS (PARTITION BY {point}), before AS (PARTITION BY {point} ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
hs AS (SELECT {point}, big_p, big_n, CAST(SUM({own} + 20 * n * cp) AS BIGINT) AS low, CAST(SUM({own} + 20 * n * (cp + p)) AS BIGINT) AS high,
  CAST(SUM(least(greatest({cut} - cw - 20 * n, 0), p)) AS BIGINT) AS held_low, CAST(SUM(least(greatest({cut} - cw, 0), p)) AS BIGINT) AS held_high
  FROM hw GROUP BY ALL),
hb AS (SELECT {point}, {metric("low", "held_low")} AS lower, {metric("high", "held_high")} AS upper FROM hs),
j AS (SELECT hb.*, l0_r.metric, upper < (SELECT max(lower) FROM hb) AS pruned FROM hb JOIN l0_r USING ({point}))
SELECT """ + ", ".join(f"CAST({a} / {n}.0::DOUBLE AS FLOAT) AS w_{m}" for a, m in zip(_POINT, MODELS)) + """, CAST(lower AS FLOAT) AS lower,
  CAST(upper AS FLOAT) AS upper, pruned, CASE WHEN NOT pruned THEN CAST(metric AS FLOAT) END AS metric FROM j""")


@register("blend_search_bounds", _bounds_sql())
def q_blend_search_bounds(spark, sf_dir):
    """Bounds of every candidate of the 1/10 lattice, and the metric of those that the bounds leave."""
    models = list(MODELS)
    level = search_level(narrow(_seed_averaged(spark, sf_dir), models), models, lattice(len(models), GRID_STEPS))
    return comparable(spark.createDataFrame([(*r.weights, r.lower, r.upper, r.metric is None, r.metric) for r in level],
                                            ", ".join(f"w_{m} double" for m in models) + ", lower double, upper double, pruned boolean, metric double"))


# --- by aggregate type (13 predictions, 4 enter the blend) ---------------------------------------

def _by_agg_wide(spark, sf_dir):
    """Seed-averaged ensemble and the twelve single-aggregate models, each rank-normalised,
    one column per prediction, joined on the customer (the reference's 13-way merge)."""
    sa = seed_average(_oof(spark, sf_dir).drop("target"))
    own = weighted_blend(pivot_models(sa, list(MODELS)), SEED_AVG_WEIGHTS).select(KEY, "prediction")
    own = rank_normalize(own, "prediction", out="prediction_seed_avg").select(KEY, "prediction_seed_avg")
    aggs = prediction_long(spark, sf_dir, "oof", models=AGG_MODELS, seeds=(42,)).drop("seed", "target")
    wide = rank_pivot(aggs, list(AGG_MODELS))
    return wide.join(own, on=KEY, how="left").join(train_labels(spark, sf_dir), on=KEY, how="inner")


def _by_agg_ctes() -> str:
    grid = ", ".join(f"('{m}', 42)" for m in AGG_MODELS)
    aggs = (f"pa AS (SELECT t.customer_id, g.model, "
            f"{O.score_sql('g.model', 'g.seed', 't.customer_id', 't.truth')} AS prediction "
            f"FROM truth t CROSS JOIN (VALUES {grid}) g(model, seed) WHERE NOT t.is_test),\n"
            f"pr AS (SELECT customer_id, model, {O.rank_norm_sql('prediction', ['model'])} AS prediction FROM pa),\n"
            "pw AS (SELECT customer_id, " + ", ".join(
                f"MAX(CASE WHEN model = '{m}' THEN prediction END) AS prediction_{m}" for m in AGG_MODELS)
            + " FROM pr GROUP BY customer_id)")
    own = (f"own AS (SELECT customer_id, {_blend_expr()} AS prediction FROM sw),\n"
           f"ownr AS (SELECT customer_id, {O.rank_norm_sql('prediction', [])} AS prediction_seed_avg FROM own),\n"
           "o AS (SELECT pw.*, ownr.prediction_seed_avg, lab.target FROM pw LEFT JOIN ownr USING (customer_id) "
           "JOIN lab USING (customer_id))")
    return (W + ",\n" + O.pred_long_cte("p") + ",\n" + _seed_avg_ctes("p") + ",\n" + _SA_PIVOT + ",\n" + aggs
            + ",\n" + own)


_BY_AGG_BLEND = " + ".join(f"{w}::DOUBLE * prediction_{m}" for m, w in BY_AGG_WEIGHTS.items())


@register("blend_by_agg", _by_agg_ctes() + f"\nSELECT customer_id, CAST({_BY_AGG_BLEND} AS FLOAT) AS prediction FROM o")
def q_blend_by_agg(spark, sf_dir):
    """The by-aggregate-type blend with the reference's fixed weights (I15 over I17's selection)."""
    wide = _by_agg_wide(spark, sf_dir)
    return comparable(weighted_blend(wide, BY_AGG_WEIGHTS).select(KEY, "prediction"))


BY_AGG_STEPS = 10


def _by_agg_search_sql() -> str:
    cands = simplex_grid(len(BY_AGG_SELECTED), BY_AGG_STEPS)
    wcols = ", ".join(f"w_{m}" for m in BY_AGG_SELECTED)
    vals = ", ".join(f"({i}, " + ", ".join(f"{w!r}::DOUBLE" for w in c) + ")" for i, c in enumerate(cands))
    blend = " + ".join(f"c.w_{m} * o.prediction_{m}" for m in BY_AGG_SELECTED)
    return (_by_agg_ctes() + ",\n"
            f"cands AS (SELECT * FROM (VALUES {vals}) v(cand, {wcols})),\n"
            f"b AS (SELECT c.cand, o.customer_id, o.target, {blend} AS s FROM o CROSS JOIN cands c),\n"
            + O.metric_ctes("b", ["cand"], "target", "s", "customer_id") +
            "\nSELECT " + ", ".join(f"CAST(w_{m} AS FLOAT) AS w_{m}" for m in BY_AGG_SELECTED) +
            ", CAST(metric AS FLOAT) AS metric FROM m_r JOIN cands USING (cand) ORDER BY metric DESC, cand ASC LIMIT 1")


@register("blend_by_agg_search", _by_agg_search_sql())
def q_blend_by_agg_search(spark, sf_dir):
    """Weight search over the four selected predictions of the 13 (I14, I17): 286 simplex
    candidates at step 1/10, bounded in one pass; only those that may win are sorted."""
    wide = _by_agg_wide(spark, sf_dir)
    return _best_row(spark, BY_AGG_SELECTED, best_weights(wide, BY_AGG_SELECTED, BY_AGG_STEPS))
