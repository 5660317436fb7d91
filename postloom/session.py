"""Session and scratch space."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "postloom", **conf: str) -> SparkSession:
    """Session for tests and single-node runs. On a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as `--py-files` would, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_postloom_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="postloom-ship-"), "postloom"), "zip", os.path.dirname(here), "postloom"
    )
    context.addPyFile(archive)
    context._postloom_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local master may fall back on a folder of its own; elsewhere a machine-local folder
    would be lost with its executor, so the missing setting is an error.
    """
    root = spark.conf.get(_CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(_CHECKPOINT_CONF)
    if root:
        return root
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="postloom-")


def _work_folder(spark: SparkSession) -> str:
    """One folder per Spark context below the shared folder."""
    context = spark.sparkContext
    if getattr(context, "_postloom_folder", None) is None:
        context._postloom_folder = f"{scratch_root(spark).rstrip('/')}/postloom-{uuid.uuid4().hex}"
    return context._postloom_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables written and read again."""
    return f"{_work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to the shared folder and read them back.

    The files outlive the executors that wrote them. Unlike a checkpoint the rows are computed once, and the
    next plan starts from a scan with a known size and without the constraints of the plan before, which
    pile up over the rounds of a loop.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def growing(df: DataFrame) -> DataFrame:
    """Mark a table with rows for points or edges: joins with it shuffle both sides, also while its file is small. Else the driver
    collects it for a broadcast, in every join of every round."""
    return df.hint("merge")


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `cut` that nobody reads any more."""
    for table in tables:
        spark = table.sparkSession
        own = f"/{_work_folder(spark).rpartition('/')[2]}/"
        for folder in {path.rpartition("/")[0] for path in table.inputFiles()}:
            if own in folder:  # only what this session wrote
                at = spark._jvm.org.apache.hadoop.fs.Path(folder)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Give disk back between the steps of a long job: discard these tables, and ask the
    JVM to collect, so that Spark's cleaner drops the shuffle files of finished steps (it does so by itself every half hour)."""
    discard(*tables)
    gc.collect()
    spark._jvm.System.gc()
