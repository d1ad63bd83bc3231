"""Session for tests and benchmarks, and the shared scratch folder of a session."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from sluicework.sinks import files

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_roots: dict[str, str] = {}
_owned: ContextVar[tuple[list[str], ...]] = ContextVar("_owned", default=())


def local_session(cpus: int | str = 8, app: str = "sluicework", **extra: str) -> SparkSession:
    """A single-JVM session. A cluster session comes from the cluster's own launcher."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    It is ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its
    own; on a cluster a machine-local folder would be lost with the machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="sluicework-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never the same twice."""
    path = f"{scratch_root(spark)}/sluicework/{name}-{uuid.uuid4().hex}"
    for owner in _owned.get()[-1:]:
        owner.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch tables made inside, and removes them when it ends, also after an error.

    Results that read them are lazy, so write or collect what is to stay before the end. Scopes can be
    nested: a table belongs to the innermost one.
    """
    paths: list[str] = []
    token = _owned.set((*_owned.get(), paths))
    try:
        yield
    finally:
        _owned.reset(token)
        for path in paths:
            files.delete(spark, path)


#: Whether Spark removes the shuffle files of an action when it ends; a release that does not know it ignores it.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the actions inside go when each ends, not when the driver's JVM collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
