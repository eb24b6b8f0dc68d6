"""Session construction and lineage cutting."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "scorewright",
                  extra: dict | None = None, driver_memory: str = "8g") -> SparkSession:
    """Session for tests and local benchmarks. On a cluster, use the cluster's session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset and the master is
    local (tests, local runs) fall back to a fresh scratch folder. On a cluster an unset folder is an
    error: executors would write their parts to disks of their own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="scorewright-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared checkpoint folder (never
    ``localCheckpoint``): Parquet, read back with the same schema. Survives executor loss,
    is columnar and compressed (an RDD checkpoint would Java-serialise every row), and the
    read-back plan carries real file sizes for the optimizer's join choices."""
    spark = df.sparkSession
    path = shared_dir(spark, f"tables/{_run_folder(spark)}/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scorewright_path = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of :func:`cut_lineage` before the session ends. What still reads them must have been written before."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._scorewright_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: A matrix of fewer partitions is not kept by executors: its fits read the shared checkpoint, each where there is room.
HELD_PARTITIONS = 6


def hold(df: DataFrame) -> DataFrame:
    """A training matrix as it is laid out, checkpointed and persisted. Boosting runs thousands of short tasks over it, and each
    of them is sent the lineage: that of a checkpoint is one step, in the same partitions. A matrix of a few partitions is
    only checkpointed: its fits would all follow the persisted blocks to the few executors that have them. See :func:`let_go`."""
    ensure_checkpoint_dir(df.sparkSession)
    held = df.checkpoint()
    if held._jdf.queryExecution().toRdd().getNumPartitions() < HELD_PARTITIONS:
        return held
    return held.persist(StorageLevel.MEMORY_AND_DISK)


def let_go(held: DataFrame) -> None:
    """Release a matrix of :func:`hold`, with its checkpoint's files. What still reads it must have been written before."""
    held.unpersist()
    sc = held.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(held._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def _run_folder(spark: SparkSession) -> str:
    """Folder of this session's written tables, removed when the driver's process ends."""
    sc = spark.sparkContext
    if not hasattr(sc, "_scorewright_run"):
        sc._scorewright_run = uuid.uuid4().hex
        atexit.register(release_tables, spark)
    return sc._scorewright_run


def release_tables(spark: SparkSession) -> None:
    """Remove the written tables of this session (through Spark's file system, for every scheme). Results
    that still read them must have been written or collected before."""
    sc = spark.sparkContext
    if sc._jsc is None or not hasattr(sc, "_scorewright_run"):
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, f"tables/{sc._scorewright_run}"))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
