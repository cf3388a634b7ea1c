"""Session defaults and the shared folder for lineage cuts."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: AQE carries the runtime decisions: broadcast only when the measured side is
#: small, split skewed join partitions, merge small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "viewtide", master: str | None = None, **conf) -> SparkSession:
    """A session with :data:`DEFAULT_CONF`; ``conf`` overrides it (``__`` for ``.``).

    Object-store classes, credentials and warehouse options are plain Spark
    settings and are passed here rather than written into the library.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` or ``setCheckpointDir``.

    A missing setting is an error: the library invents no folder, since a
    machine-local one dies with its host.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{kind}-{uuid4().hex}"


def materialise(df: DataFrame, kind: str = "table", codec: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once, compressed by ``codec`` or the session's default, and read it back.

    ``options`` are those of the Parquet writer, ``__`` for ``.``.

    The copy survives lost executors, fixes row placement for anything that
    depends on it, and gives the optimizer real sizes to choose joins by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    named = {k.replace("__", "."): v for k, v in options.items()}
    df.write.options(**named).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


#: Whether Spark removes the shuffle files of a query as it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Tables written inside leave no shuffle files behind when their write has ended.

    Otherwise these stay until the driver happens to collect its garbage, and the steps of a
    long job add up on the disks.
    """
    return settings(spark, {FREED: "true"})


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files and kept blocks that no plan holds any more."""
    # Python gives up its plans in a thread of its own, a moment after they are collected.
    gc.collect()
    time.sleep(0.5)
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that this library wrote below :func:`shared_dir` and no longer reads."""
    root = shared_dir(spark)
    if not path.startswith(f"{root}/") or ".." in path:
        raise ValueError(f"{path} is not below {root}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
