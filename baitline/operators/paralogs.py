"""Paralog detection: long hits, their ranking by depth or identity, names, and coverage along the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import ranges
from baitline.operators.hits import keys_of


def long_hits(hsps: DataFrame, share: float = 0.75, frags: str = "q_frags", query_len: str = "query_len") -> DataFrame:
    """Hits that cover more than share of their target, by untrimmed fragments."""
    return hsps.where(ranges.span(F.col(frags)) / F.col(query_len) > share)


def with_main(hits: DataFrame, keys: tuple[str, ...] | None = None, multiplier: float = 10.0) -> DataFrame:
    """Marks each gene's main hit: the deepest if it is multiplier times as deep as all others, else the most similar.

    A multiplier of 0 leaves depth out.
    """
    keys = keys_of(hits, keys)
    deep = Window.partitionBy(*keys).orderBy(F.desc("depth"), "contig")
    alike = Window.partitionBy(*keys).orderBy(F.desc("sim"), F.desc("depth"), "contig")
    ranked = hits.withColumns({"by_depth": F.row_number().over(deep), "by_sim": F.row_number().over(alike), "second": F.lead("depth").over(deep)})
    clear = F.max(F.when((F.col("by_depth") == 1) & (F.coalesce(F.col("second"), F.lit(0.0)) * multiplier <= F.col("depth")), True)).over(Window.partitionBy(*keys)) if multiplier else F.lit(None).cast("boolean")
    return ranked.withColumn("clear", clear).withColumn("main", F.when(F.col("clear"), F.col("by_depth") == 1).otherwise(F.col("by_sim") == 1)).drop("by_depth", "by_sim", "second", "clear")


def named(hits: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Suffixes main, 0, 1, ... in hit order."""
    keys = keys_of(hits, keys)
    others = Window.partitionBy(*keys, "main").orderBy("s", "e", "contig")
    return hits.withColumn("suffix", F.when(F.col("main"), "main").otherwise((F.row_number().over(others) - 1).cast("string")))


def covered_twice(hsps: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Target positions covered by more than one hit, by a sweep over range ends."""
    keys = keys_of(hsps, keys)
    ends = hsps.select(*keys, F.explode(F.array(F.struct(F.col("s").alias("p"), F.lit(1).alias("d")), F.struct(F.col("e").alias("p"), F.lit(-1).alias("d")))).alias("x")).select(*keys, "x.p", "x.d")
    steps = ends.groupBy(*keys, "p").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(*keys).orderBy("p")
    swept = steps.withColumn("depth", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("width", F.lead("p").over(order) - F.col("p"))
    return swept.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("depth") > 1, F.col("width"))), F.lit(0)).cast("long").alias("deep"))


def depth_warning(hsps: DataFrame, lengths: DataFrame, share: float = 0.75, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Genes whose target is covered more than once over more than share of its length."""
    keys = keys_of(hsps, keys)
    return covered_twice(hsps, keys).join(lengths, list(keys)).withColumn("paralog_depth", F.col("deep") / F.col("query_len") > share)
