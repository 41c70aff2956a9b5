"""Session settings and staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans joins from measured sizes and splits skewed
# partitions. Plans here are built from many small expressions, so recording
# the Python call site of each would take a quarter of the planning time.
SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "factorfall", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session that runs in one process gets a folder of its
    own; anything with executors is refused, as they would not share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="factorfall-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one staged table."""
    application = spark.sparkContext.applicationId
    return f"{staging_dir(spark)}/{application}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a shared intermediate once and read it back.

    The result has no lineage to recompute, and its file size is exact, so
    Catalyst broadcasts it only under ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_staged(df: DataFrame) -> None:
    """Remove a table made by ``stage_table`` that nothing reads any more; without files, nothing is done."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_together(spark: SparkSession, actions: Sequence[Callable[[], object]], at_once: int = 8) -> list:
    """Submit independent jobs side by side, so that the short ones fill idle executors."""
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(actions)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]]


def stage_tables(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Stage several independent tables side by side; returns them in order."""
    spark = next(iter(tables.values())).sparkSession
    return run_together(spark, [lambda n=n, t=t: stage_table(t, n) for n, t in tables.items()])
