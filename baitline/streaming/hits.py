"""Hits that keep arriving: running counts and best targets over a watched folder of tabular hits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from baitline.operators import distribute
from baitline.sources.text import TABULAR


def watch(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """New files of a folder of tabular hits as a stream, with taxon and gene."""
    raw = spark.readStream.schema(TABULAR).option("sep", "\t").option("maxFilesPerTrigger", files_a_batch).csv(folder)
    return distribute.named_hits(raw)


def running_scores(stream: DataFrame) -> DataFrame:
    """(gene, taxon, total) so far; state grows with the targets, not with the hits."""
    return stream.groupBy("gene", "taxon").agg(F.sum(F.col("score").cast("long")).alias("total"))


def best_so_far(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Calls write(best targets, batch number) after each batch."""
    from pyspark.sql import Window

    def each(scores: DataFrame, number: int) -> None:
        rank = F.row_number().over(Window.partitionBy("gene").orderBy(F.desc("total"), "taxon"))
        write(scores.withColumn("rank", rank).where("rank = 1").drop("rank"), number)

    writer = running_scores(stream).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(availableNow=True) if once else writer).start()
