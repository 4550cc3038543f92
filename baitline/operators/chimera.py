"""Chimera test: read pairs that map to different contigs of a stitched sequence with discordant edit distances."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import ranges


def offsets(pieces: DataFrame, keys: tuple[str, ...] = ("gene",), length: str = "len") -> DataFrame:
    """(lo, hi) of each piece in the stitched sequence."""
    before = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("lo", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long")).withColumn("hi", (F.col("lo") + F.col(length)).cast("long"))


def in_ranges(points: DataFrame, lots: DataFrame, keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """Reads (start, end) joined with the range that encloses them."""
    return points.join(lots, list(keys)).where("start >= lo and end <= hi")


def discordant(pairs: DataFrame, distance: int = 5) -> DataFrame:
    """Pairs of which one mate has no edits and the other at least distance."""
    return pairs.where(((F.col("nm1") == 0) & (F.col("nm2") >= distance)) | ((F.col("nm2") == 0) & (F.col("nm1") >= distance)))


def chimeric_genes(pairs: DataFrame, more_than: int = 5, distance: int = 5, keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """Genes with more than so many discordant pairs whose mates lie in different contigs."""
    return discordant(pairs, distance).where("contig1 <> contig2").groupBy(*keys).agg(F.count("*").alias("pairs")).where(F.col("pairs") > more_than)


def in_exons(reads: DataFrame, exons: str = "exons", start: str = "start", end: str = "end") -> DataFrame:
    """Reads that lie in one exon; null exons: the hit has no introns."""
    return reads.where(F.col(exons).isNull() | F.exists(exons, lambda x: (F.col(start) >= x["s"]) & (F.col(end) <= x["e"])))


def exon_lots(pieces: DataFrame, keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """pieces(keys, contig, rank, piece[, h_frags]) with lo, hi and, for hits of several fragments, exons on the stitched sequence."""
    placed = offsets(pieces.withColumn("len", F.length("piece")), keys)
    if "h_frags" not in pieces.columns:
        return placed.withColumn("exons", F.lit(None).cast("array<struct<s:bigint,e:bigint>>"))
    shifted = lambda x: F.struct((x["s"] + F.col("lo")).alias("s"), (x["e"] + F.col("lo")).alias("e"))
    return placed.withColumn("exons", F.when(F.size("h_frags") > 1, F.transform(ranges.exons(F.col("h_frags")), shifted)))


def mates(reads: DataFrame) -> DataFrame:
    """Placed reads(gene, pair, mate, start, end, nm[, sample]) as pairs of which both mates are placed."""
    keys = [c for c in ("sample", "gene", "pair") if c in reads.columns]
    side = lambda n: reads.where(F.col("mate") == n).select(*keys, *(F.col(c).alias(f"{c}{n}") for c in ("start", "end", "nm")))
    return side(1).join(side(2), keys)


def between_contigs(pairs: DataFrame, lots: DataFrame, distance: int = 5, keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """Discordant pairs(keys, start1, end1, nm1, start2, end2, nm2) whose mates lie in exons of different contigs.

    Only discordant pairs are joined with the contigs' ranges (lots of exon_lots); reads over a join of contigs go.
    """
    out = discordant(pairs, distance)
    for n in (1, 2):
        lot = lots.select(*keys, F.col("contig").alias(f"contig{n}"), F.col("lo").alias(f"lo{n}"), F.col("hi").alias(f"hi{n}"), F.col("exons").alias(f"exons{n}"))
        out = in_exons(out.join(lot, list(keys)).where(f"start{n} >= lo{n} and end{n} <= hi{n}"), f"exons{n}", f"start{n}", f"end{n}")
    return out.where("contig1 <> contig2").drop("lo1", "hi1", "exons1", "lo2", "hi2", "exons2")
