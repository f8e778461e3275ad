"""Session helpers: durable intermediate results and input spreading."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="doctag-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session without one (tests, trial runs) gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# The stage tables of each application, oldest first.
_stages: dict[str, list[str]] = {}


def durable(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written to a table in the shared folder and read back: its lineage
    ends there, so neither a lost executor nor a second read can change it."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    _stages.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stages_released(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the stage tables that were stored inside of it. What is still to be
    read from them must be written before."""
    known = _stages.setdefault(spark.sparkContext.applicationId, [])
    before = len(known)
    try:
        yield
    finally:
        mine, known[before:] = known[before:], []
        for name in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a small file scan over all cores before CPU-heavy work. A scan with
    enough splits of its own, as any large table has, is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores, *keys)


def by_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` hashed by a key over as many tasks as it has, or all cores. What is made longer from its
    rows and then grouped, joined or numbered by the key moves no more."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, df.rdd.getNumPartitions()), key)
