"""Session helpers: building a local session for tests/bench and finding the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "canopy", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.maxMetadataStringLength", "1000")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if not os.environ.get("SPARK_CHECKPOINT_DIR_SET"):
        b = b.config("spark.checkpoint.dir",
                     tempfile.mkdtemp(prefix="canopy-ckpt-", dir="/tmp"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session (``spark.checkpoint.dir`` / the context). Only a
    local session without one gets a folder of our own; on a cluster executors
    would each write to their own disk, so a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set at all
            d = None
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="canopy-ckpt-", dir="/tmp")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/canopy-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Removes, at its end, the scratch folders that were taken inside it: for
    steps whose result is stored by then. What is left of a step that failed
    goes as well; its next try takes folders of its own."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            drop_scratch(spark, path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table after a write to the shared scratch folder, without lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
