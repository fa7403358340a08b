"""Spark session set-up and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app: str = "agora", cpus: int | None = None, **conf: str) -> SparkSession:
    """Session for local runs and tests; on a cluster use the session it provides."""
    builder = SparkSession.builder.appName(app)
    if cpus is not None:
        builder = builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(cpus))
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Skip the sort of a join whose measured build partitions are all small.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The application's checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder, because there every executor
    is this machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="agora-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_scopes: ContextVar[tuple[str, ...]] = ContextVar("scratch_scopes", default=())


def scratch_path(spark: SparkSession, label: str, outer: bool = False) -> str:
    """A new folder in the present scope, or with ``outer`` in the one around it."""
    scopes = _scopes.get()[:-1] if outer else _scopes.get()
    folder = scopes[-1] if scopes else f"{checkpoint_dir(spark)}/tables"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Tables materialized inside are deleted at the end, as a training epoch's are, but for those that go to the outer scope."""
    folder = scratch_path(spark, "scope")
    token = _scopes.set((*_scopes.get(), folder))
    try:
        yield folder
    finally:
        _scopes.reset(token)
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None, outer: bool = False) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the files.

    Like ``checkpoint()`` this survives the loss of any executor. Being
    Parquet, it also keeps column pruning and gives the optimizer true sizes.
    It is written in zstd, which makes ids, slots and keys much smaller.
    ``outer`` keeps the files when the present scope ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, outer)
    df.write.parquet(path, partitionBy=partition_by, compression="zstd")
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_counted(df: DataFrame, label: str, outer: bool = False, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize``, and aggregates of the rows that were written, without another job."""
    seen = Observation()
    stored = materialize(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), label, outer=outer)
    found = seen.get  # empty if Spark found out that there is nothing to write
    return stored, {name: found.get(name) or 0 for name in counts}
