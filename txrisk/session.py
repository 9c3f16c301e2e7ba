"""Session construction and cluster-shared folders."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package relies on. UTC makes timestamp <-> date
# arithmetic identical on every executor; AQE re-plans joins from runtime sizes
# (broadcast only when the materialised side is measured small) and splits
# skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "txrisk", extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the launcher supplies master and sizing; this only fills the
    settings above that are not already set.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared filesystem folder and is used as
    is. Only when it is unset under a local master (tests, local runs) a fresh
    scratch folder is created and registered; elsewhere that is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="txrisk-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some sessions reject core configs at runtime
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


class _Scopes(threading.local):
    """The scratch scopes that a thread is in, the innermost last: jobs of other threads keep their tables."""

    def __init__(self):
        self.open: list[list[str]] = []


_scopes = _Scopes()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    What reads it does not run the plan behind it again, also where an executor
    is lost. The folder goes when the ``scratch_scope`` around the call ends, else
    with the application.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    if _scopes.open:
        _scopes.open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables written inside at the end: for jobs that write their result before they return."""
    paths: list[str] = []
    _scopes.open.append(paths)
    try:
        yield
    finally:
        _scopes.open.pop()
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
