"""Session helpers: local session for tests/bench and the cluster's shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings the tests and the bench use (UI off, UTC, AQE on)."""
    spark = (SparkSession.builder.master(f"local[{cores}]")
             .appName("skytrace")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a temporary folder is made under a ``local`` master (driver and
    executors are one machine there); on any other master this raises, because executors
    would write to their own disks and later reads would miss those files.
    """
    sc = spark.sparkContext
    d = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
         or sc.getCheckpointDir())
    if not d:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        d = tempfile.mkdtemp(prefix="skytrace-ckpt-")
        _delete_on_exit(spark, d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for job outputs, deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/skytrace/{name}-{uuid.uuid4().hex[:12]}"
    _delete_on_exit(spark, path)
    return path


def materialise(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, and a lost
    executor repeats only its own tasks. ``tidy`` lets Spark delete the write's shuffle files as soon as it ends
    (for operators that write many tables in turn)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_TIDY, "false")
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialised tables that are no longer read."""
    for t in tables:
        for folder in {name.rsplit("/", 1)[0] for name in t.inputFiles()}:
            if "/skytrace/" in folder:
                p = t.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme for python-side file access in tests."""
    return path[5:] if path.startswith("file:") else path
