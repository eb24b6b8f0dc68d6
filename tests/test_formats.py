"""Half precision against NumPy, CSV inference against a plain version, balanced group folds against greedy dealing."""

import heapq
import tempfile
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from scorewright.functions.half import halve, to_half
from scorewright.operators.folds import deal_sizes, group_folds
from scorewright.sources.csv_infer import infer_csv


def test_half_equals_numpy(spark):
    every = np.arange(65536, dtype=np.uint16).view(np.float16).astype(np.float64)
    rng = np.random.RandomState(0)
    finite = every[np.isfinite(every)]
    near = np.sort(finite)
    between = (near[1:] + near[:-1]) / 2
    wild = np.r_[rng.randn(5000) * 10.0 ** rng.randint(-12, 7, 5000), between, np.nextafter(between, np.inf), np.nextafter(between, -np.inf),
                 65504, 65519.999, 65520, -65520, 1e300, -1e300, 2.0 ** -24, 2.0 ** -25, 2.0 ** -25 * 1.0001, 5e-324, 0.0, -0.0]
    values = np.r_[every, wild]
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(values)], "i long, x double")
    got = np.array([r[1] for r in sorted(df.select("i", to_half("x")).collect())])
    with np.errstate(over="ignore"):
        want = values.astype(np.float16).astype(np.float64)
    same = (got == want) | (np.isnan(got) & np.isnan(want))
    assert same.all() and (np.signbit(got) == np.signbit(want))[~np.isnan(want)].all()
    out = halve(spark.createDataFrame([(None,), (1.0 / 3,)], "x double"), ["x"])
    assert out.dtypes == [("x", "float")] and [r[0] for r in out.collect()] == [None, float(np.float16(1 / 3))]


def test_csv_types_come_from_every_row(spark):
    path = tempfile.mkdtemp(prefix="scorewright-csv-") + "/x.csv"
    lines = ["id,price,day,late,when,words,none,big,NaNs"]
    for i in range(300):
        lines.append(f"{i},{i / 7 if i % 3 else ''},2024-02-{i % 28 + 1:02d},{'x' if i == 299 else i},2024-02-01{' 10:00:00' if i == 150 else ''},"
                     f"\"a, {i}\",,{9 * 10 ** 18 + i if i < 299 else 10 ** 19},{'nan' if i == 5 else '-inf' if i == 6 else i}")
    lines[10:10] = ["1,2", "1,2,3,4,5,6,7,8,9,10,11"]
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    found = infer_csv(spark, path)
    assert found.types == {"id": "bigint", "price": "double", "day": "date", "late": "string", "when": "timestamp", "words": "string", "none": "string",
                           "big": "double", "NaNs": "double"}
    assert found.malformed.count() == 2 and found.rows.count() == 300
    assert sorted(r["line"] for r in found.malformed.collect()) == ["1,2", "1,2,3,4,5,6,7,8,9,10,11"]
    assert {r["column_name"]: (r["n_values"], r["n_missing"]) for r in found.report.collect()}["price"] == (200, 100)
    r = {r["id"]: r for r in found.rows.collect()}
    assert r[299]["late"] == "x" and r[4]["price"] == 4 / 7 and r[4]["words"] == "a, 4" and str(r[150]["when"]) == "2024-02-01 10:00:00"
    assert np.isnan(r[5]["NaNs"]) and r[6]["NaNs"] == float("-inf")
    bare = infer_csv(spark, path, names=[f"c{i}" for i in range(9)], columns=["c0"])
    assert bare.types == {"c0": "string"} and bare.rows.columns == ["c0"]


def greedy(sizes, k):
    loads = [(0, f) for f in range(k)]
    heapq.heapify(loads)
    out = Counter()
    for s in sorted(sizes, reverse=True):
        load, f = heapq.heappop(loads)
        out[s, f] += 1
        heapq.heappush(loads, (load + s, f))
    return out


def test_groups_are_dealt_like_one_by_one():
    rng = np.random.RandomState(1)
    for _ in range(40):
        sizes = np.minimum(rng.zipf(1.6, rng.randint(1, 200)), 500).tolist()
        dealt = deal_sizes(list(Counter(sizes).items()), 5)
        assert Counter({(s, f): hi - lo for s, f, lo, hi in dealt}) == greedy(sizes, 5)


def test_heavy_groups_leave_balanced_folds(spark):
    rows = [(c, i) for c in range(60) for i in range(400 if c == 0 else 90 if c < 4 else c % 7 + 1)]
    folds = group_folds(spark.createDataFrame(rows, "customer_id long, x long"))
    got = folds.collect()
    assert len(got) == 60 and {r["fold"] for r in got} == set(range(5))
    loads = Counter()
    for r in got:
        loads[r["fold"]] += r["n_rows"]
    rest = sorted(loads.values())[:-1]
    assert max(loads.values()) == 400 and max(rest) - min(rest) <= 90
    assert group_folds(spark.createDataFrame([], "customer_id long, x long")).count() == 0
    assert folds.where(F.col("fold").isNull()).count() == 0
