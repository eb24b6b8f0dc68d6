"""Ordered scans (running sums, previous-row values) within groups, without one huge task.

``Window.partitionBy(g).orderBy(o)`` sends each group to a single task, and a window
with no ``partitionBy`` sends *everything* to one task. Both break when one group (one
customer, one stratum, one model) holds a large share of the rows.

The scan here splits the total order ``(partition_by..., order_by...)`` into contiguous
range buckets, the way Spark's range partitioner does: a bounded sample is sorted, and
``n_buckets - 1`` cut points become literals of a balanced ``CASE WHEN`` tree (log2
comparisons per row, deterministic on recompute). Because ``order_by`` is unique per row,
cut points split a hot group, too. Each ``(bucket, group)`` piece is then scanned by an
ordinary window; the only state crossing a cut is the last row of each bucket (one row per
bucket, broadcast with that proven bound), stitched in with one broadcast join.

Rows per bucket are bounded by ``rows_per_bucket`` (session conf
``scorewright.ordered.rowsPerBucket``), up to ``max_buckets`` = 16,384 buckets; above 1,023
cut points the lookup is a tree over every 64th cut point plus a scan of that segment's 63.
Small inputs use a single bucket and skip the sampling pass. The driver only ever holds the
sorted sample (at most 400,000 key tuples) and the tail table (one row per bucket).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 16384
SAMPLES_PER_BUCKET = 40
MAX_SAMPLE_ROWS = 400_000          # bound on the sample brought to the driver
TREE_LIMIT = 1023                  # cut points handled by one CASE WHEN tree
SEGMENT = 64                       # above that: a tree over every 64th cut point, then a scan
# session-level override of ROWS_PER_BUCKET (e.g. smaller on executors with little memory)
ROWS_PER_BUCKET_CONF = "scorewright.ordered.rowsPerBucket"


def _sample_bounds(df: DataFrame, key_cols: list[str], n_rows: int, n_buckets: int,
                   seed: int) -> list[tuple]:
    frac = min(1.0, min(SAMPLES_PER_BUCKET * n_buckets, MAX_SAMPLE_ROWS) / max(n_rows, 1))
    rows = (df.select(*key_cols).sample(withReplacement=False, fraction=frac, seed=seed)
            .orderBy(*key_cols).collect())          # bounded: ~SAMPLES_PER_BUCKET * n_buckets
    if not rows:
        return []
    bounds: list[tuple] = []
    for i in range(1, n_buckets):
        b = tuple(rows[min(len(rows) - 1, (i * len(rows)) // n_buckets)])
        if not bounds or b != bounds[-1]:
            bounds.append(b)
    return bounds


def _bucket_expr(df: DataFrame, key_cols: list[str], bounds: list[tuple], key_exprs: list[Column] | None = None
                 ) -> Column:
    """Number of cut points <= key. Up to TREE_LIMIT cut points: a balanced CASE WHEN tree
    (log2 comparisons). Beyond: the tree runs over every SEGMENT-th cut point and the
    remaining (< SEGMENT) cut points of that segment are counted with ``filter``/``size``,
    so the plan holds each cut point once and a row costs about log2(n/SEGMENT) + SEGMENT
    comparisons."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = key_exprs or [F.col(c) for c in key_cols]
    key = F.struct(*[e.cast(types[c]).alias(f"k{i}") for i, (c, e) in enumerate(zip(key_cols, exprs))])

    def lit(b: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(types[c]).alias(f"k{i}") for i, (c, v) in enumerate(zip(key_cols, b))])

    def tree(points: list[Column], lo: int, hi: int) -> Column:
        # number of points <= key, given points[:lo] <= key < points[hi:]
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= points[mid], tree(points, mid + 1, hi)).otherwise(tree(points, lo, mid))

    if len(bounds) <= TREE_LIMIT:
        lits = [lit(b) for b in bounds]
        return tree(lits, 0, len(lits))
    coarse = [lit(bounds[j]) for j in range(SEGMENT - 1, len(bounds), SEGMENT)]
    ci = tree(coarse, 0, len(coarse))                       # full segments below the key
    segments = F.array(*[F.array(*[lit(b) for b in bounds[j * SEGMENT: j * SEGMENT + SEGMENT - 1]])
                         for j in range(len(coarse) + 1)])
    inside = F.size(F.filter(F.element_at(segments, ci + 1), lambda b: b <= key))
    return ci * F.lit(SEGMENT) + inside


def _plan(df: DataFrame, key_cols: list[str], rows_per_bucket: int | None, max_buckets: int, seed: int,
          n_rows: int | None) -> list[tuple]:
    if rows_per_bucket is None:
        rows_per_bucket = int(df.sparkSession.conf.get(ROWS_PER_BUCKET_CONF, str(ROWS_PER_BUCKET)))
    n = df.count() if n_rows is None else n_rows
    nb = max(1, min(max_buckets, math.ceil(n / max(rows_per_bucket, 1))))
    return _sample_bounds(df, key_cols, n, nb, seed) if nb > 1 else []


def plan_buckets(df: DataFrame, key_cols: list[str], *, rows_per_bucket: int | None = None,
                 max_buckets: int = MAX_BUCKETS, seed: int = 17, n_rows: int | None = None) -> tuple[Column, int]:
    """Bucket id over the lexicographic order of ``key_cols`` and the number of cut points
    (one count unless ``n_rows`` is known, plus one bounded sample when more than one
    bucket is needed). ``rows_per_bucket`` defaults to the session setting
    ``scorewright.ordered.rowsPerBucket``, else ``ROWS_PER_BUCKET``."""
    bounds = _plan(df, key_cols, rows_per_bucket, max_buckets, seed, n_rows)
    return (_bucket_expr(df, key_cols, bounds), len(bounds)) if bounds else (F.lit(0), 0)


def ordered_scan(df: DataFrame, partition_by: list[str], order_by: list[str], *,
                 sums: dict[str, Column] | None = None, lags: dict[str, Column] | None = None,
                 rows_per_bucket: int | None = None, max_buckets: int = MAX_BUCKETS,
                 seed: int = 17, n_rows: int | None = None, attach: DataFrame | None = None) -> DataFrame:
    """Add inclusive running sums and previous-row values within ``partition_by`` groups,
    ordered ascending by ``order_by``.

    ``order_by`` columns must be non-null and, together with ``partition_by``, unique per
    row (add an id as the last tie-breaker; negate a column for descending order).
    ``sums``: output name -> expression summed from the group start to the current row.
    ``lags``: output name -> expression evaluated at the previous row of the group (NULL
    on the group's first row).
    ``attach``: an optional table keyed by ``partition_by`` (e.g. customer labels), left-joined
    to the rows *inside* the scan's partitioning. Each of its rows is repeated for the range
    of buckets its group spans (from ``(group, minimum)`` to ``(group, maximum)`` of the
    numeric order columns, so the repetition is bounded by groups + buckets), and the join
    on ``(bucket, group)`` moves only that table: the scanned rows are not shuffled again.
    """
    sums = dict(sums or {})
    lags = dict(lags or {})
    pk = list(partition_by)
    key_cols = pk + list(order_by)
    bounds = _plan(df, key_cols, rows_per_bucket, max_buckets, seed, n_rows)
    n_cuts = len(bounds)
    bkt = _bucket_expr(df, key_cols, bounds) if bounds else F.lit(0)
    d = df.withColumn("_bkt", bkt)
    for name, expr in lags.items():
        d = d.withColumn(f"_v_{name}", expr)
    for name, expr in sums.items():
        d = d.withColumn(f"_x_{name}", expr)

    w = Window.partitionBy("_bkt", *pk).orderBy(*order_by)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = d.withColumns({
        **{f"_s_{n}": F.sum(f"_x_{n}").over(wr) for n in sums},
        **{f"_l_{n}": F.lag(f"_v_{n}").over(w) for n in lags},
        "_first": F.row_number().over(w) == 1,
    })

    if n_cuts == 0:
        out = scanned.withColumns({**{n: F.col(f"_s_{n}") for n in sums}, **{n: F.col(f"_l_{n}") for n in lags}})
        out = _attach_by_bucket(out, df, attach, pk, key_cols, bounds)
        return out.drop(*_internal(out, df, sums, lags, attach))

    # Last row of every bucket: key fields, running sums and lag sources. One row per bucket.
    tail_fields = ([F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)]
                   + [F.col(f"_s_{n}").alias(f"s_{n}") for n in sums]
                   + [F.col(f"_v_{n}").alias(f"v_{n}") for n in lags])
    tails = (scanned.groupBy("_bkt").agg(F.max(F.struct(*tail_fields)).alias("t"))
             .select(F.col("_bkt").alias("_b"),
                     *[F.col(f"t.k{i}").alias(f"_p_{c}") for i, c in enumerate(pk)],
                     *[F.col(f"t.s_{n}").alias(f"_ts_{n}") for n in sums],
                     *[F.col(f"t.v_{n}").alias(f"_tv_{n}") for n in lags]))
    # carry of a group into the next non-empty bucket: the sum of its tails so far, and
    # the value of its last row
    by_group = Window.partitionBy(*[f"_p_{c}" for c in pk]).orderBy("_b") if pk else Window.orderBy("_b")
    # (windows over <= max_buckets rows: bounded)
    carry = tails.select(
        F.lead("_b").over(Window.orderBy("_b")).alias("_next_b"),
        *[F.col(f"_p_{c}") for c in pk],
        *[F.sum(f"_ts_{n}").over(by_group.rowsBetween(Window.unboundedPreceding, Window.currentRow))
          .alias(f"_c_{n}") for n in sums],
        *[F.col(f"_tv_{n}").alias(f"_c_{n}") for n in lags],
    ).where(F.col("_next_b").isNotNull())
    cond = [scanned["_bkt"] == F.col("_next_b")] + [scanned[c].eqNullSafe(F.col(f"_p_{c}")) for c in pk]
    joined = scanned.join(F.broadcast(carry), on=cond, how="left")
    has_carry = F.col("_next_b").isNotNull()
    outs = {}
    for n in sums:
        outs[n] = F.when(has_carry, F.coalesce(F.col(f"_s_{n}"), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))) \
                   .otherwise(F.col(f"_s_{n}"))
    for n in lags:
        outs[n] = F.when(F.col("_first") & has_carry, F.col(f"_c_{n}")).otherwise(F.col(f"_l_{n}"))
    out = _attach_by_bucket(joined.withColumns(outs), df, attach, pk, key_cols, bounds)
    return out.drop(*_internal(out, df, sums, lags, attach))


def _attach_by_bucket(out: DataFrame, src: DataFrame, attach: DataFrame | None, pk: list[str], key_cols: list[str],
                      bounds: list[tuple]) -> DataFrame:
    if attach is None:
        return out
    if not bounds:
        return out.join(attach.withColumn("_bkt", F.lit(0)), on=["_bkt", *pk], how="left")
    from pyspark.sql.types import DoubleType, FloatType
    types = {f.name: f.dataType for f in src.schema.fields}
    order_cols = key_cols[len(pk):]

    def extreme(c: str, high: bool) -> Column:
        if isinstance(types[c], (DoubleType, FloatType)):
            return F.lit(float("inf") if high else float("-inf"))
        return F.lit((1 << 63) - 1 if high else -(1 << 63))

    lo = _bucket_expr(src, key_cols, bounds, [F.col(c) for c in pk] + [extreme(c, False) for c in order_cols])
    hi = _bucket_expr(src, key_cols, bounds, [F.col(c) for c in pk] + [extreme(c, True) for c in order_cols])
    ranged = attach.withColumn("_bkt", F.explode(F.sequence(lo, hi)))
    return out.join(ranged, on=["_bkt", *pk], how="left")


_PREFIXES = ("_bkt", "_v_", "_x_", "_s_", "_l_", "_first", "_c_", "_p_", "_next_b")


def _internal(out: DataFrame, src: DataFrame, sums: dict, lags: dict, attach: DataFrame | None = None) -> list[str]:
    keep = set(src.columns) | set(sums) | set(lags) | (set(attach.columns) if attach is not None else set())
    return [c for c in out.columns if c.startswith(_PREFIXES) and c not in keep]
