"""DuckDB twins of the fixtures, shared by the oracle SQL of the registered queries."""

from __future__ import annotations

from scorewright.functions.hashing import unit_score_sql

MEASURES = ["o_totalprice", "n_lines", "sum_qty", "avg_discount", "max_price"]
CATS = ["status_code", "priority_code"]
TE_SRC = CATS + ["day", "month", "year"]
TE_COLS = [f"{c}_te" for c in TE_SRC]
DATE_COLS = ["day", "month", "year", "seasonality_m", "seasonality_y"]
NUM_COLS = MEASURES + ["days_diff"] + DATE_COLS + TE_COLS
# SQL result type of each statement column: True when floating point
IS_FLOAT = {**{c: True for c in MEASURES}, "days_diff": False, "day": False, "month": False, "year": False,
            "seasonality_m": True, "seasonality_y": True, **{c: True for c in TE_COLS},
            "status_code": False, "priority_code": False}

STATEMENTS = """
li AS (SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_quantity) AS sum_qty, AVG(l_discount) AS avg_discount,
              MAX(l_extendedprice) AS max_price FROM lineitem GROUP BY l_orderkey),
s0 AS (SELECT o.o_custkey AS customer_id, o.o_orderkey AS seq, o.o_orderdate AS ts, epoch_us(o.o_orderdate) AS ts_us,
              CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_totalprice END AS o_totalprice,
              CAST(li.n_lines AS DOUBLE) AS n_lines, CAST(li.sum_qty AS DOUBLE) AS sum_qty,
              CAST(li.avg_discount AS DOUBLE) AS avg_discount, CAST(li.max_price AS DOUBLE) AS max_price,
              CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status_code,
              CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS priority_code,
              (o.o_custkey % 3 = 0) AS is_test
       FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey WHERE o.o_custkey IS NOT NULL),
lab AS (SELECT c_custkey AS customer_id, CAST(c_acctbal < 0 AS INTEGER) AS target FROM customer
        WHERE c_custkey % 3 <> 0),
tspine AS (SELECT c_custkey AS customer_id FROM customer WHERE c_custkey % 3 = 0),
truth AS (SELECT c_custkey AS customer_id, CAST(c_acctbal < 0 AS INTEGER) AS truth,
                 (c_custkey % 3 = 0) AS is_test FROM customer),
s1 AS (SELECT s0.*, CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month,
              CAST(year(ts) AS INTEGER) AS year,
              cos(pi() * (CAST(day(ts) AS INTEGER) / 31.0::DOUBLE * 2.0::DOUBLE - 1.0::DOUBLE)) AS seasonality_m,
              cos(pi() * (CAST(dayofyear(ts) AS INTEGER) / 366.0::DOUBLE * 2.0::DOUBLE - 1.0::DOUBLE)) AS seasonality_y,
              row_number() OVER (PARTITION BY customer_id ORDER BY ts_us, seq) AS rn,
              CAST(floor((ts_us - lag(ts_us) OVER (PARTITION BY customer_id ORDER BY ts_us, seq)) / 86400000000.0::DOUBLE)
                   AS BIGINT) AS days_diff
       FROM s0),
s2 AS (SELECT s1.*, lab.target FROM s1 LEFT JOIN lab USING (customer_id))"""


def te_ctes(fit_where: str = "") -> str:
    """Encoding map over training statements (plus an optional extra filter) and its application."""
    extra = f" AND ({fit_where})" if fit_where else ""
    fits = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, AVG(CAST(target AS DOUBLE)) AS te FROM s2 "
        f"WHERE NOT is_test AND target IS NOT NULL AND {c} IS NOT NULL{extra} GROUP BY CAST({c} AS DOUBLE)"
        for c in TE_SRC)
    joins = " ".join(f"LEFT JOIN tem m_{c} ON m_{c}.feature = '{c}' AND m_{c}.value = CAST(s2.{c} AS DOUBLE)"
                     for c in TE_SRC)
    sel = ", ".join(f"m_{c}.te AS {c}_te" for c in TE_SRC)
    return f"tem AS ({fits}),\ns3 AS (SELECT s2.*, {sel} FROM s2 {joins})"


def with_statements(body: str, fit_where: str = "", te: bool = True) -> str:
    ctes = STATEMENTS + (",\n" + te_ctes(fit_where) if te else "")
    return f"WITH {ctes}\n{body}"


def f(expr: str, alias: str, is_float: bool) -> str:
    return f"CAST({expr} AS FLOAT) AS {alias}" if is_float else f"{expr} AS {alias}"


def agg_sql(agg: str, c: str) -> tuple[str, bool | None]:
    """SQL of one aggregate and whether its result is floating (None: same as the input)."""
    if agg == "mean":
        return f"AVG({c})", True
    if agg == "std":
        return f"STDDEV_SAMP({c})", True
    if agg == "min":
        return f"MIN({c})", None
    if agg == "max":
        return f"MAX({c})", None
    if agg == "sum":
        return f"COALESCE(CAST(SUM({c}) AS DOUBLE), 0.0)", True
    if agg == "last":
        return f"arg_max({c}, rn) FILTER (WHERE {c} IS NOT NULL)", None
    if agg == "first":
        return f"arg_min({c}, rn) FILTER (WHERE {c} IS NOT NULL)", None
    if agg == "count":
        return f"COUNT({c})", False
    if agg == "nunique":
        return f"COUNT(DISTINCT {c})", False
    raise ValueError(agg)


def score_sql(model: str, seed: str, id_expr: str, truth_expr: str, ties: bool = False) -> str:
    """Fixture P: 0.7 * md5 unit score + 0.3 * truth (tie variant: floor to 2 decimals)."""
    s = f"({unit_score_sql(model, seed, id_expr)} * 0.7::DOUBLE + 0.3::DOUBLE * {truth_expr})"
    return f"(floor({s} * 100.0::DOUBLE) / 100.0::DOUBLE)" if ties else s


MODELS = ("lgbm", "cb", "xgb")
SEEDS = (42, 52, 62)
_GRID = ", ".join(f"('{m}', {s})" for m in MODELS for s in SEEDS)


def pred_long_cte(name: str, split: str = "oof", ties: bool = False) -> str:
    """Long prediction table (customer_id, [target], model, seed, prediction) as a CTE."""
    where = "NOT t.is_test" if split == "oof" else "t.is_test"
    tgt = "t.truth AS target, " if split == "oof" else ""
    return (f"{name} AS (SELECT t.customer_id, {tgt}g.model, g.seed, "
            f"{score_sql('g.model', 'g.seed', 't.customer_id', 't.truth', ties)} AS prediction "
            f"FROM truth t CROSS JOIN (VALUES {_GRID}) g(model, seed) WHERE {where})")


def avg_rank_sql(score: str, pk: list[str]) -> str:
    part = ", ".join(pk)
    p1 = f"PARTITION BY {part}" if pk else ""
    p2 = f"PARTITION BY {part + ', ' if pk else ''}{score}"
    return (f"(rank() OVER ({p1} ORDER BY {score}) + "
            f"(count(*) OVER ({p2}) - 1) / 2.0::DOUBLE)")


def rank_norm_sql(score: str, pk: list[str]) -> str:
    p1 = f"PARTITION BY {', '.join(pk)}" if pk else ""
    return (f"CASE WHEN {score} IS NULL THEN NULL ELSE {avg_rank_sql(score, pk)} / "
            f"count(*) OVER ({p1}) END")


def metric_ctes(src: str, pk: list[str], y: str, s: str, id_col: str, variant: str = "mod",
                prefix: str = "m") -> str:
    """CTEs ending in ``{prefix}_r`` (pk..., gini, capture, metric) for the combined metric."""
    pkl = ", ".join(pk)
    sel = f"{pkl}, " if pk else ""
    part = f"PARTITION BY {pkl}" if pk else ""
    grp = f"GROUP BY {pkl}" if pk else ""
    join = f"JOIN {prefix}_t USING ({pkl})" if pk else f"CROSS JOIN {prefix}_t"
    cut = ("cw * 25 <= P + 20 * N" if variant == "mod" else "cw / (P + 20 * N) <= 0.04::DOUBLE")
    W = "(P + 20 * N)"
    Q = f"(({W} * {W} + P + 400 * N) / 2)"
    gmax = (f"((P * (P + 1) / 2 + 20 * N * P) / P - {Q} / {W})" if variant == "mod"
            else f"(10 * N * (P + 20 * N - 19) / {W})")
    frame = f"OVER ({part} ORDER BY s DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (
        f"{prefix}_m AS (SELECT {sel}{id_col} AS id, CAST({y} AS BIGINT) AS y, CAST({s} AS DOUBLE) AS s, "
        f"CAST(CASE WHEN {y} = 0 THEN 20 ELSE 1 END AS BIGINT) AS w FROM {src} "
        f"WHERE {y} IS NOT NULL AND {s} IS NOT NULL),\n"
        f"{prefix}_c AS (SELECT {sel}y, w, SUM(y) {frame} AS cp, SUM(w) {frame} AS cw FROM {prefix}_m),\n"
        f"{prefix}_t AS (SELECT {sel}CAST(SUM(y) AS BIGINT) AS P, CAST(SUM(1 - y) AS BIGINT) AS N "
        f"FROM {prefix}_m {grp}),\n"
        f"{prefix}_a AS (SELECT {sel}P, N, CAST(SUM(cp * w) AS BIGINT) AS S1, "
        f"CAST(SUM(CASE WHEN {cut} THEN y ELSE 0 END) AS BIGINT) AS captured FROM {prefix}_c {join} "
        f"GROUP BY {sel}P, N),\n"
        f"{prefix}_g AS (SELECT {sel}(S1 / P - {Q} / {W}) / {gmax} AS gini, captured / P AS capture "
        f"FROM {prefix}_a),\n"
        f"{prefix}_r AS (SELECT {sel}gini, capture, 0.5::DOUBLE * (gini + capture) AS metric FROM {prefix}_g)")


# statement-level scores of the statement model (fixture P) and their in-history difference
STATEMENT_SCORES = ("ss AS (SELECT s0.customer_id, s0.seq, s0.ts_us, " +
       score_sql("'stmt'", "0", "s0.seq", "COALESCE(truth.truth, 0)") +
       " AS pred_no_agg FROM s0 LEFT JOIN truth USING (customer_id)),\n"
       "sd AS (SELECT ss.*, row_number() OVER (PARTITION BY customer_id ORDER BY ts_us, seq) AS rn, pred_no_agg - "
       "lag(pred_no_agg) OVER (PARTITION BY customer_id ORDER BY ts_us, seq) AS pred_no_agg_diff FROM ss)")
