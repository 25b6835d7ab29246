"""Session settings the operators count on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# AQE turns small shuffled joins into broadcast joins by their measured size
# and splits the partitions of a hot key; the operators give no join hints.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Has Spark remove a query's shuffle files at its end, not when the driver happens to collect garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Paths settled within each `scratch` that is open, the innermost last.
_open_scratch: list[list[str]] = []


def build_session(app: str = "roadpulse", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and hand-over tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, as in
    tests, may fall back to a temporary folder, which lasts as long as the
    Python process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="roadpulse-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Jobs within run under these settings of the session."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def write(df: DataFrame, path: str) -> None:
    """Write a frame as Parquet; what it shuffled goes at once, as nothing else reads that."""
    conf = df.sparkSession.conf
    before = conf.get(_DROP_SHUFFLES)
    conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_DROP_SHUFFLES, before)


def settle(df: DataFrame, name: str, session: SparkSession | None = None) -> DataFrame:
    """Write a frame to the shared folder and go on from there, in `session` if given.

    For results that several later steps read, or that must not change when a
    task is repeated. The lineage ends here, so a lost executor costs no
    recomputation of what lies before.
    """
    path = fresh_path(df.sparkSession, name)
    if _open_scratch:
        _open_scratch[-1].append(path)
    write(df, path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in whatever store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever store it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what was settled within; for jobs that have written their result by then."""
    paths: list[str] = []
    _open_scratch.append(paths)
    try:
        yield
    finally:
        _open_scratch.remove(paths)
        for path in paths:
            delete(spark, path)


def settle_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that `make` returns, settled; what `make` settled on its way goes."""
    path = fresh_path(spark, name)
    if _open_scratch:
        _open_scratch[-1].append(path)
    with scratch(spark):
        df = make()
        write(df, path)
    return spark.read.schema(df.schema).parquet(path)
