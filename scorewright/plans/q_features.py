"""Registered queries: statement and customer features (build-plan steps 1-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.functions.numeric import comparable
from scorewright.operators.aggregate import CATEGORICAL_AGGS, NUMERIC_AGGS, DIFF_FEATURES, aggregate_history
from scorewright.operators.dates import add_date_features
from scorewright.operators.history import order_history
from scorewright.operators.joins import label_join, spine_join, union_train_test
from scorewright.operators.narrow import narrow_types, narrowing_report
from scorewright.plans import oracle as O
from scorewright.plans.features import CAT_COLS, NUM_COLS, customer_features, statement_features
from scorewright.plans.registry import register
from scorewright.sources.feature_store import read_features, write_features
from scorewright.sources.fixtures import events_statements, statements, train_labels
from scorewright.session import shared_dir

# --- step 1 -------------------------------------------------------------------------------

_DATE_SQL = O.with_statements(
    "SELECT customer_id, seq, day, month, year, CAST(seasonality_m AS FLOAT) AS seasonality_m, "
    "CAST(seasonality_y AS FLOAT) AS seasonality_y FROM s1", te=False)


@register("date_features", _DATE_SQL)
def q_date_features(spark, sf_dir):
    s = add_date_features(statements(spark, sf_dir))
    return comparable(s.select("customer_id", "seq", "day", "month", "year", "seasonality_m", "seasonality_y"))


@register("days_diff", O.with_statements("SELECT customer_id, seq, rn, days_diff FROM s1", te=False))
def q_days_diff(spark, sf_dir):
    return order_history(statements(spark, sf_dir)).select("customer_id", "seq", "rn", "days_diff")


_EVENTS_DIFF_SQL = """
SELECT user_id AS customer_id, event_id AS seq,
       row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS rn,
       CAST(floor((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id))
                  / 86400000000.0::DOUBLE) AS BIGINT) AS days_diff
FROM events WHERE user_id IS NOT NULL"""


@register("days_diff_events", _EVENTS_DIFF_SQL)
def q_days_diff_events(spark, sf_dir):
    return order_history(events_statements(spark, sf_dir)).select("customer_id", "seq", "rn", "days_diff")


@register("label_join", O.with_statements("SELECT customer_id, seq, target FROM s2", te=False))
def q_label_join(spark, sf_dir):
    return label_join(statements(spark, sf_dir), train_labels(spark, sf_dir)).select("customer_id", "seq", "target")


# --- step 2 -------------------------------------------------------------------------------

def _agg_select(num_aggs, cat_aggs, diffs: bool) -> list[str]:
    out = []
    for c in NUM_COLS:
        for a in num_aggs:
            expr, fl = O.agg_sql(a, c)
            out.append(O.f(expr, f"{c}_{a}", O.IS_FLOAT[c] if fl is None else fl))
    for c in CAT_COLS:
        for a in cat_aggs:
            expr, fl = O.agg_sql(a, c)
            out.append(O.f(expr, f"{c}_{a}", O.IS_FLOAT[c] if fl is None else fl))
    return out


def _diff_select(src: str = "g") -> list[str]:
    out = []
    for c in NUM_COLS:
        for name, a, b in DIFF_FEATURES:
            fl = O.IS_FLOAT[c] or a == "mean" or b == "mean"
            out.append(O.f(f"{src}.{c}_{a} - {src}.{c}_{b}", f"{c}_{name}", fl))
    return out


def _customer_sql(num_aggs, cat_aggs, diffs: bool, scores: bool = False) -> str:
    """Aggregates in full precision (CTE g), spine joins, then FLOAT casts in the final select.
    ``scores``: also the same aggregates of the statement score and its difference."""
    raw = []
    for c in NUM_COLS:
        for a in num_aggs:
            raw.append(f"{O.agg_sql(a, c)[0]} AS {c}_{a}")
    for c in CAT_COLS:
        for a in cat_aggs:
            raw.append(f"{O.agg_sql(a, c)[0]} AS {c}_{a}")
    outs = []
    for c in NUM_COLS:
        for a in num_aggs:
            fl = O.agg_sql(a, c)[1]
            outs.append(O.f(f"g.{c}_{a}", f"{c}_{a}", O.IS_FLOAT[c] if fl is None else fl))
    for c in CAT_COLS:
        for a in cat_aggs:
            fl = O.agg_sql(a, c)[1]
            outs.append(O.f(f"g.{c}_{a}", f"{c}_{a}", O.IS_FLOAT[c] if fl is None else fl))
    if diffs:
        outs += _diff_select("g")
    score_cte, score_join = "", ""
    if scores:
        sraw = [f"{O.agg_sql(a, c)[0]} AS {c}_{a}" for c in ("pred_no_agg", "pred_no_agg_diff") for a in num_aggs]
        outs += [f"CAST(sg.{c}_{a} AS FLOAT) AS {c}_{a}" for c in ("pred_no_agg", "pred_no_agg_diff") for a in num_aggs]
        score_cte = O.STATEMENT_SCORES + f",\nsg AS (SELECT customer_id, {', '.join(sraw)} FROM sd GROUP BY customer_id),\n"
        score_join = " LEFT JOIN sg USING (customer_id)"
    body = (score_cte + f"g AS (SELECT customer_id, {', '.join(raw)} FROM s3 GROUP BY customer_id),\n"
            f"sp AS (SELECT customer_id, target, FALSE AS is_test FROM lab UNION ALL "
            f"SELECT customer_id, CAST(NULL AS INTEGER) AS target, TRUE AS is_test FROM tspine)\n"
            f"SELECT sp.customer_id, sp.target, sp.is_test, {', '.join(outs)} FROM sp LEFT JOIN g USING (customer_id)"
            + score_join)
    return "WITH " + O.STATEMENTS + ",\n" + O.te_ctes() + ",\n" + body


def _customer_query(num_aggs, cat_aggs, diffs, scores: bool = False):
    def q(spark, sf_dir):
        df = customer_features(spark, sf_dir, num_aggs=num_aggs, cat_aggs=cat_aggs, diffs=diffs)
        if scores:
            from scorewright.operators.stack import score_features, stack_onto
            from scorewright.sources.predictions import statement_scores
            df = stack_onto(df, score_features(statement_scores(spark, sf_dir), aggs=tuple(num_aggs)))
        return comparable(df)
    return q


register("customer_agg", _customer_sql(NUMERIC_AGGS, CATEGORICAL_AGGS, True))(
    _customer_query(NUMERIC_AGGS, CATEGORICAL_AGGS, True))
# the single-aggregate feature sets also carry that aggregate of the stacked statement score
for _agg in ("last", "mean", "max", "min"):
    register(f"agg_{_agg}_only", _customer_sql((_agg,), (_agg,), False, scores=True))(
        _customer_query((_agg,), (_agg,), False, scores=True))


_CAT_SQL = O.with_statements(
    "SELECT customer_id, " + ", ".join(
        f"{O.agg_sql(a, c)[0]} AS {c}_{a}" for c in CAT_COLS for a in CATEGORICAL_AGGS)
    + " FROM s1 GROUP BY customer_id", te=False)


@register("customer_cat_agg", _CAT_SQL)
def q_customer_cat_agg(spark, sf_dir):
    s = order_history(statements(spark, sf_dir), days_diff=None)
    return aggregate_history(s, "customer_id", "rn", [], CAT_COLS, cat_aggs=CATEGORICAL_AGGS)


_DIFF_SQL = ("WITH " + O.STATEMENTS + ",\n" + O.te_ctes() + ",\ng AS (SELECT customer_id, " + ", ".join(
    f"{O.agg_sql(a, c)[0]} AS {c}_{a}" for c in NUM_COLS for a in ("last", "mean", "first", "max", "min"))
    + " FROM s3 GROUP BY customer_id)\nSELECT customer_id, " + ", ".join(_diff_select("g")) + " FROM g")


@register("agg_diff_features", _DIFF_SQL)
def q_agg_diff_features(spark, sf_dir):
    from scorewright.operators.aggregate import add_diff_features
    s = statement_features(spark, sf_dir)
    g = aggregate_history(s, "customer_id", "rn", NUM_COLS, [], num_aggs=("last", "mean", "first", "max", "min"))
    d = add_diff_features(g, NUM_COLS)
    return comparable(d.select("customer_id", *[f"{c}_{n}" for c in NUM_COLS for n, _, _ in DIFF_FEATURES]))


_SPINE_SQL = O.with_statements(
    "SELECT lab.customer_id, lab.target, CAST(g.o_totalprice_mean AS FLOAT) AS o_totalprice_mean, g.n_statements "
    "FROM lab LEFT JOIN (SELECT customer_id, AVG(o_totalprice) AS o_totalprice_mean, COUNT(*) AS n_statements "
    "FROM s0 GROUP BY customer_id) g USING (customer_id)", te=False)


@register("spine_join", _SPINE_SQL)
def q_spine_join(spark, sf_dir):
    g = statements(spark, sf_dir).groupBy("customer_id").agg(
        F.avg("o_totalprice").alias("o_totalprice_mean"), F.count(F.lit(1)).alias("n_statements"))
    return comparable(spine_join(train_labels(spark, sf_dir), g))


# --- step 3 -------------------------------------------------------------------------------

# one priority code is withheld from the fitting rows: its statements get NULL encodings
UNSEEN_PRIORITY = 5

_TE_SQL = O.with_statements(
    "SELECT customer_id, seq, " + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in O.TE_COLS) + " FROM s3",
    fit_where=f"priority_code <> {UNSEEN_PRIORITY}")


@register("target_encode", _TE_SQL)
def q_target_encode(spark, sf_dir):
    s = statement_features(spark, sf_dir, fit_filter=F.col("priority_code") != UNSEEN_PRIORITY)
    return comparable(s.select("customer_id", "seq", *O.TE_COLS))


_UNION_SQL = O.with_statements(
    "SELECT customer_id, seq, target, FALSE AS is_test FROM s2 WHERE NOT is_test "
    "UNION ALL SELECT customer_id, seq, CAST(NULL AS INTEGER) AS target, TRUE AS is_test FROM s0 WHERE is_test",
    te=False)


@register("union_train_test", _UNION_SQL)
def q_union_train_test(spark, sf_dir):
    s = statements(spark, sf_dir)
    train = label_join(s.where(~F.col("is_test")), train_labels(spark, sf_dir)).select("customer_id", "seq", "target")
    test = s.where(F.col("is_test")).select("customer_id", "seq")
    return union_train_test(train, test)


_NARROW_COLS = ["seq", "n_lines", "sum_qty", "avg_discount", "max_price", "o_totalprice", "status_code",
                "priority_code", "rn", "days_diff"]
_NARROW_INT = {"seq", "status_code", "priority_code", "rn", "days_diff"}


def _narrow_sql() -> str:
    parts = []
    for c in _NARROW_COLS:
        if c in _NARROW_INT:
            t = (f"CASE WHEN MIN({c}) > -128 AND MAX({c}) < 127 THEN 'tinyint' "
                 f"WHEN MIN({c}) > -32768 AND MAX({c}) < 32767 THEN 'smallint' "
                 f"WHEN MIN({c}) > -2147483648 AND MAX({c}) < 2147483647 THEN 'int' ELSE 'bigint' END")
        else:
            t = (f"CASE WHEN MIN({c}) > -3.4028234663852886e38 AND MAX({c}) < 3.4028234663852886e38 "
                 f"THEN 'float' ELSE 'double' END")
        parts.append(f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_value, "
                     f"CAST(MAX({c}) AS DOUBLE) AS max_value, {t} AS narrow_type FROM s1")
    return O.with_statements(" UNION ALL ".join(parts), te=False)


@register("narrow_types", _narrow_sql())
def q_narrow_types(spark, sf_dir):
    s = order_history(statements(spark, sf_dir))
    return narrowing_report(s.select(*_NARROW_COLS))


@register("narrow_table", O.with_statements("SELECT " + ", ".join(
    c if c in _NARROW_INT else f"CAST({c} AS FLOAT) AS {c}" for c in _NARROW_COLS) + " FROM s1", te=False))
def q_narrow_table(spark, sf_dir):
    """The statements with every column in its narrowest type."""
    return narrow_types(order_history(statements(spark, sf_dir)).select(*_NARROW_COLS))


_STORE_COLS = ["o_totalprice_mean", "o_totalprice_last", "days_diff_max", "priority_code_nunique"]


@register("feature_store_roundtrip", "WITH " + O.STATEMENTS + ",\n" + O.te_ctes() + ",\n"
          "g AS (SELECT customer_id, AVG(o_totalprice) AS o_totalprice_mean, "
          "arg_max(o_totalprice, rn) FILTER (WHERE o_totalprice IS NOT NULL) AS o_totalprice_last, "
          "MAX(days_diff) AS days_diff_max, COUNT(DISTINCT priority_code) AS priority_code_nunique "
          "FROM s3 GROUP BY customer_id)\n"
          "SELECT customer_id, CAST(o_totalprice_mean AS FLOAT) AS \"o_totalprice-mean\", "
          "CAST(o_totalprice_last AS FLOAT) AS \"o_totalprice-last\", days_diff_max AS \"days_diff-max\", "
          "priority_code_nunique AS \"priority_code-nunique\" FROM g")
def q_feature_store_roundtrip(spark, sf_dir):
    import uuid
    s = statement_features(spark, sf_dir)
    g = aggregate_history(s, "customer_id", "rn", ["o_totalprice", "days_diff"], ["priority_code"],
                          num_aggs=("mean", "last", "max"), cat_aggs=("nunique",))
    g = g.select("customer_id", *[F.col(c).alias(c.replace("_mean", " mean").replace("_last", "/last")
                                                  .replace("_max", " max").replace("_nunique", "/nunique"))
                                  for c in _STORE_COLS])
    path = shared_dir(spark, f"feature_store/{uuid.uuid4().hex}")
    write_features(g, path)
    return comparable(read_features(spark, path))


# --- fixture E: the same customer aggregation over an event stream ------------------------------

_EV_NUM = ["value", "days_diff"]
_EV_FLOAT = {"value": True, "days_diff": False}


def _event_agg_sql() -> str:
    raw, outs = [], []
    for c in _EV_NUM:
        for a in NUMERIC_AGGS:
            raw.append(f"{O.agg_sql(a, c)[0]} AS {c}_{a}")
            fl = O.agg_sql(a, c)[1]
            outs.append(O.f(f"{c}_{a}", f"{c}_{a}", _EV_FLOAT[c] if fl is None else fl))
    for a in CATEGORICAL_AGGS:
        raw.append(f"{O.agg_sql(a, 'event_code')[0]} AS event_code_{a}")
        outs.append(f"event_code_{a}")
    for c in _EV_NUM:
        for name, a, b in DIFF_FEATURES:
            fl = _EV_FLOAT[c] or a == "mean" or b == "mean"
            outs.append(O.f(f"{c}_{a} - {c}_{b}", f"{c}_{name}", fl))
    codes = " ".join(f"WHEN '{k}' THEN {v}" for k, v in
                     {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}.items())
    return ("WITH e0 AS (SELECT user_id AS customer_id, event_id AS seq, epoch_us(ts) AS ts_us, CAST(value AS DOUBLE) "
            f"AS value, CAST(CASE event_type {codes} END AS INTEGER) AS event_code FROM events WHERE user_id IS NOT NULL),\n"
            "e1 AS (SELECT e0.*, row_number() OVER (PARTITION BY customer_id ORDER BY ts_us, seq) AS rn, "
            "CAST(floor((ts_us - lag(ts_us) OVER (PARTITION BY customer_id ORDER BY ts_us, seq)) / 86400000000.0::DOUBLE) "
            "AS BIGINT) AS days_diff FROM e0),\n"
            f"g AS (SELECT customer_id, {', '.join(raw)} FROM e1 GROUP BY customer_id)\n"
            f"SELECT customer_id, {', '.join(outs)} FROM g")


@register("event_agg", _event_agg_sql())
def q_event_agg(spark, sf_dir):
    """Fixture E through the same operators: ordered history with microsecond timestamps
    (floored day lags), the numeric and categorical bundles and the difference features."""
    from scorewright.operators.aggregate import add_diff_features
    e = order_history(events_statements(spark, sf_dir))
    g = aggregate_history(e, "customer_id", "rn", _EV_NUM, ["event_code"])
    return comparable(add_diff_features(g, _EV_NUM))
