"""Helpers shared by the training-data operators.

Row conventions used by every operator of this package: input columns are selected and
renamed first, so extra columns with clashing names never reach the internal plan; a
null text counts as empty; null keys keep their rows; repeated rows each keep a row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

#: Above this many rows a side is joined by shuffling instead of broadcasting (a row of
#: the sides below has under 100 bytes, so a broadcast stays under about 50 MB).
BROADCAST_ROWS = 500_000


#: Bytes of an Arrow batch between the JVM and Python; Spark's default of 64 MB is held several times over.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_BYTES`` if they may be larger."""
    now = str(spark.conf.get(_BATCH_KEY)).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    This cuts the lineage with files that every executor can read, so a lost executor
    costs its running tasks only.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a side whose counted rows are within ``limit``; else no hint."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def words(text: Column) -> Column:
    """Words of a text as an array; null and empty texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def uniform(hash64: Column) -> Column:
    """A 64-bit hash as a double strictly between 0 and 1."""
    return (F.shiftrightunsigned(hash64, 11).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 53))


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
