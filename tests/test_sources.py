import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scorewright.operators.narrow import narrow_types, narrowing_report
from scorewright.sources.feature_store import (read_features, read_manifest, sanitize, write_features,
                                               write_manifest)


def test_feature_store_guards_and_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="scorewright-store-")
    df = spark.createDataFrame([(1, 2.0, True), (2, None, False)], "`customer_id` long, `x mean/7` double, is_test boolean")
    names = write_features(df, f"{d}/f", partition_by="is_test")
    assert names == ["customer_id", "x-mean-7", "is_test"] and sanitize("a b/c") == "a-b-c"
    back = read_features(spark, f"{d}/f", ["customer_id", "x-mean-7"])
    assert sorted(back.collect()) == sorted(df.select("customer_id", "`x mean/7`").collect())
    assert os.path.isdir(f"{d}/f/is_test=true")              # the split prunes directories
    with pytest.raises(ValueError):
        write_features(df.select("customer_id", F.col("customer_id").alias("customer_id")), f"{d}/g")
    with pytest.raises(ValueError):
        write_features(df.select(F.col("x mean/7").alias("a b"), F.col("x mean/7").alias("a/b")), f"{d}/h")
    write_manifest(names, f"{d}/m.json", params={"max_depth": 5})
    assert read_manifest(f"{d}/m.json") == {"features": names, "params": {"max_depth": 5}}


def test_narrowing_strict_bounds(spark):
    df = spark.createDataFrame([(0, 127, 1.5, 40000), (-127, 5, 2.5, 1)], "a long, b long, c double, d int")
    rep = {r["column_name"]: r["narrow_type"] for r in narrowing_report(df).collect()}
    # 127 is not strictly below the tinyint maximum, so b needs smallint (strict bounds)
    assert rep == {"a": "tinyint", "b": "smallint", "c": "float", "d": "int"}
    out = narrow_types(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["tinyint", "smallint", "float", "int"]


def test_written_tables_are_released(spark):
    import os
    from scorewright.session import cut_lineage, release_tables
    df = cut_lineage(spark.range(3).toDF("x"))
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    release_tables(spark)
    assert not os.path.exists(path)


def test_cluster_without_shared_folder_is_refused():
    import pytest
    from scorewright.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_nan_is_missing(spark):
    from scorewright.sources.tables import nan_to_null
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k int, x double")
    assert [r["x"] for r in nan_to_null(df).orderBy("k").collect()] == [1.0, None, None]
