"""What the operators of this subpackage share: table access, the shared folder, Arrow batches, checkpoints."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.session import shared_dir, table  # noqa: F401  what the operators take from here

#: Rows and bytes of one Arrow batch handed to a Python worker. Texts can be long, so batches are short.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20
#: White space and words, as the contracts write them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def _batches(spark: SparkSession, rows: int) -> None:
    """Bounds the memory of Python workers. The session's setting counts when a query runs, not when it is built, so the
    bound on bytes is the same for all: whichever bound on rows is in force, a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def short_batches(spark: SparkSession) -> None:
    """For tables of texts."""
    _batches(spark, BATCH_ROWS)


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder; its lineage is cut, and lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Gives back the disk of shuffles that no frame needs any more: Spark drops them when the driver's garbage is collected.

    What a job has just ended with is held a second more, hence the rounds.
    """
    for _ in range(4):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: Bytes taken for a row where the optimizer knows no size.
ROW_BYTES = 2048


def input_bytes(df: DataFrame) -> int:
    """The size of what df reads: the optimizer's figures for the leaves of its plan, from file sizes, without a job; by
    a count where they are unknown. A join reads its sides once each, whatever the optimizer makes of their product.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    known = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return known if known < 1 << 52 else df.count() * ROW_BYTES


def partitions_for(df: DataFrame, mb: int = 8, least: int = 12) -> int:
    """A number of partitions that grows with the (compressed) input, so a partition's size stays the same."""
    return max(least, -(-input_bytes(df) // (mb << 20)))


class OnBatches:
    """A module-level function of Arrow batches with arguments; pickled by name, so workers keep its module's state."""

    def __init__(self, function: Callable, *args):
        self.function, self.args = function, args

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from self.function(batches, *self.args)


_KEPT: dict = {}


def kept(key: str, build: Callable):
    """What build() gives, made once for key in this Python process; the last key only."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def long_batches(spark: SparkSession, rows: int = 65_536) -> None:
    """For tables of a few numbers a row."""
    _batches(spark, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until df has no column of that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def joined_anew(left: DataFrame, right: DataFrame, key: str, other: str) -> DataFrame:
    """left joined with right where the columns key and other (not null) are equal.

    The join goes by a digest of the key, so a side that an aggregate has dealt by the key itself is dealt anew: Spark
    splits a hot key of a join only if the join reads its exchange directly.
    """
    mine, theirs = fresh(left, "_mine")[0], fresh(right, "_theirs")[0]
    same = (F.col(mine) == F.col(theirs)) & (F.col(key) >= F.col(other)) & (F.col(key) <= F.col(other))
    return left.withColumn(mine, F.xxhash64(key)).join(right.withColumn(theirs, F.xxhash64(other)), same).drop(mine, theirs)
