"""Session defaults, table loading and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: set[str] = set()
_written: list[str] = []


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session with the settings the operators rely on (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("khabarloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("KHABARLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    It is the cluster's ``spark.checkpoint.dir``; only a session that names none (tests, local
    runs) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("a cluster session needs spark.checkpoint.dir: a folder all executors share")
    own = os.path.join(tempfile.gettempdir(), f"khabarloom-{os.getpid()}")
    if own not in _own:
        _own.add(own)
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return f"file://{own}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The plan that follows starts from the written table: nothing upstream runs twice, and a lost
    executor loses no more than its running tasks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete every table ``cut`` has written so far; returns how many.

    For long sessions, once the results that read them are written or collected.
    """
    n = 0
    jvm = spark.sparkContext._jvm
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n
