"""Session settings and the shared folder for job outputs."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import SparkSession


def get_spark(app: str = "wagewright", cpus: str = "8", **conf) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Executors on other machines must reach it, so the machine-local fallback
    is taken only where ``spark.checkpoint.dir`` is unset and Spark is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "wagewright")
    inside = _jobs.get(spark.sparkContext.applicationId)
    return "/".join([root.rstrip("/"), *(inside or []), f"{label}-{uuid.uuid4().hex}"])


_jobs: dict[str, list[str]] = {}


@contextmanager
def dropped_after(spark: SparkSession):
    """What is stored within goes when the block ends, also when it fails; write the result before, outside of the shared folder.

    ``with dropped_after(spark): report(spark, folder).write.parquet(out)``. Blocks can be nested.
    """
    folder = scratch(spark, "job")
    inside = _jobs.setdefault(spark.sparkContext.applicationId, [])
    inside.append(folder.rsplit("/", 1)[1])
    try:
        yield
    finally:
        inside.pop()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def parallelism(spark: SparkSession) -> int:
    """How many slices to cut an ordered column into: one per shuffle partition."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def settled(df, label: str = "settled"):
    """Write a frame once to the shared folder and go on from the file.

    For an input with joins or aggregates that several branches of a job read:
    it is computed once, and a lost executor costs a re-read, not a re-run.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df, level=StorageLevel.MEMORY_AND_DISK):
    """Cache a frame for several actions and release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
