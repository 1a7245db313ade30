"""Session settings and the shared scratch folder."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "hirelens", **settings) -> SparkSession:
    """A local session for tests and measurements. On a cluster bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only where that is unset and the session is a local one (tests), a temporary folder is made and
    set as checkpoint folder; on a cluster executors would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hirelens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def give_back() -> None:
    """Return freed memory to the system at the end of a task: the worker is kept for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def collect_unused(spark: SparkSession) -> None:
    """Have the driver's JVM collect what is no longer used, between the jobs of a long chain of steps.

    Left to itself its heap grows to the limit with plans and broadcasts of steps that are over, and
    Spark removes their shuffle files and broadcasts only once they are collected.
    """
    spark.sparkContext._jvm.System.gc()
