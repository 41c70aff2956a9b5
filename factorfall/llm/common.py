"""Helpers of the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: a run of characters other than the six ASCII white-space ones. On
# bytes, ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = b" \t\n\x0b\x0c\r"


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when the driver found it by path only."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}" if known else root
    return spark


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def raw_text(df: DataFrame, text: str = "text") -> Column:
    """A text column as UTF-8 bytes; null reads as empty."""
    return F.coalesce(df[text].cast("binary"), F.lit(b""))

# A side is broadcast up to this many bytes, counted and not guessed.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a staged table when its rows fit ``limit``; otherwise leave the join to a shuffle.

    ``row_bytes`` is the width of a row of fixed-width columns. The result of a
    join is the same either way.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


@contextmanager
def _setting(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """The jobs run inside hand rows to Python in Arrow batches of about ``size`` bytes; a larger row is a batch of its own."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """The shuffle files of each query run inside are removed at its end, not when the driver's garbage is collected."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
