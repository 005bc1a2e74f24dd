"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import caselight


def build_session(app: str = "caselight", cores: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster spark-submit supplies master and sizes."""
    cores = cores or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per column expression
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session without the setting gets a
    folder of its own; on a cluster a missing setting is an error, because a machine-local folder would be lost with
    its machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="caselight-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, *paths: str) -> int:
    """Delete folders in whatever file system they are; returns how many were there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = 0
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(place.getFileSystem(conf).delete(place, True))
    return gone


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when their job ends, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ship_package() -> None:
    """Send this package's classes to Python workers by value.

    The data source and the stateful processor run in Python workers, some of them started before any file is shipped.
    With their code pickled by value the package need not be installed there.
    """
    cloudpickle.register_pickle_by_value(caselight)
