"""Supercontigs and introns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import ranges


def repeated_contigs(hits: DataFrame, keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """Contigs with two hits or more: whether on one strand, and whether their hits follow each other."""
    order = Window.partitionBy(*keys).orderBy("s", "e", "contig", "ln")
    breaks = F.when(F.lag("contig").over(order).eqNullSafe(F.col("contig")), 0).otherwise(1)
    marked = hits.withColumn("_break", breaks)
    return marked.groupBy(*keys, "contig").agg(F.count("*").alias("hits"), (F.countDistinct("strand") == 1).alias("one_strand"), (F.sum("_break") == 1).alias("consecutive")).where("hits >= 2")


def coherent(hits: DataFrame, keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """The keys whose contigs with several hits have all their hits on one strand, and two of them next to each other.

    Other genes have no supercontig: something is odd about their hits.
    """
    order = Window.partitionBy(*keys).orderBy("rank")
    marked = hits.withColumn("_next", F.coalesce(F.lead("contig").over(order).eqNullSafe(F.col("contig")), F.lit(False)))
    contigs = marked.groupBy(*keys, "contig").agg(F.count("*").alias("n"), F.countDistinct("strand").alias("strands"), F.max("_next").alias("adjacent"))
    return contigs.groupBy(*keys).agg(F.min((F.col("n") < 2) | ((F.col("strands") == 1) & F.col("adjacent"))).alias("fine")).where("fine").drop("fine")


def furthest(hits: DataFrame, keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """Of each contig the hit that ends furthest on the target, at the place of the contig's first hit (rank)."""
    own = Window.partitionBy(*keys, "contig")
    best = hits.withColumns({"_nth": F.row_number().over(own.orderBy(F.desc("e"), "rank")), "_first": F.min("rank").over(own)}).where("_nth = 1")
    return best.withColumn("rank", F.col("_first")).drop("_nth", "_first")


def slice_end(frags: Column, length: Column) -> Column:
    """Where a contig is cut so that its fragments hold ``length`` bases: the place inside the fragment that they end in.

    Null where the fragments end before.
    """
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("end"))

    def step(acc: Column, f: Column) -> Column:
        at = f["s"] + length - acc["before"]
        inside = acc["end"].isNull() & (at >= f["s"]) & (at < f["e"])
        return F.struct((acc["before"] + F.when(inside, F.lit(0)).otherwise(f["e"] - f["s"])).cast("long").alias("before"), F.coalesce(acc["end"], F.when(inside, at)).cast("long").alias("end"))

    return F.aggregate(frags, start, step, lambda acc: acc["end"])


def cut_contig(seq: Column, frags: Column, length: Column, cut_bases: Column, most: int = 9) -> Column:
    """A contig up to the end of its hit, where an overlap took more than ``most`` bases from it; else all of it.

    frags are the hit's ranges on seq, both seen from the hit's strand; length is the number of the hit's bases left.
    """
    end = F.when(F.size(frags) > 1, slice_end(frags, length)).otherwise(F.get(frags, F.lit(0))["e"] - cut_bases)
    return F.when(F.coalesce(cut_bases, F.lit(0)) > most, F.substr(seq, F.lit(1), F.coalesce(end, F.length(seq).cast("long")).cast("int"))).otherwise(seq)


def supercontig(pieces: DataFrame, keys: tuple[str, ...] = ("gene",), filler: int = 10) -> DataFrame:
    """Contigs of a gene joined in order with N between them."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "seq")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["seq"]), "N" * filler).alias("supercontig"))


def intron_texts(hits: DataFrame, seq: str = "seq", frags: str = "h_frags") -> DataFrame:
    return hits.withColumn("introns", ranges.slices(F.col(seq), ranges.introns(F.col(frags))))
