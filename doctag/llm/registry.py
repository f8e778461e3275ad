"""The queries of this subpackage, by name."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import doctag
from doctag import session


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin where SQL can express it."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(fn, sql)
        return fn

    return register


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder and read back. The shuffle files of the stored
    plan are not needed once it is complete: Spark removes them with the query."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return session.durable(df)
    finally:
        conf.set(CLEANUP, before)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers, once per application: functions that run there
    import it, and a session need not have been started with it on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(doctag.__file__).parent
    with tempfile.TemporaryDirectory() as folder:
        copy = Path(folder) / "package" / root.name
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
        name = f"{root.name}-{context.applicationId}"
        kept = Path(tempfile.mkdtemp(prefix="doctag-")) / name
        context.addPyFile(shutil.make_archive(str(kept), "zip", copy.parent))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
