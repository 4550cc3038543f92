"""Routing reads to genes, and choosing a target per gene.

Reads and hits meet in one shuffle by read id. Ties between targets go to the smaller taxon name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions.sequences import gene_of, read_id, taxon_of


def named_hits(hits: DataFrame, id_col: str = "read_id", target_col: str = "target") -> DataFrame:
    """Hits with taxon and gene; read ids without mate suffix if they are text."""
    if dict(hits.dtypes)[id_col] == "string":
        hits = hits.withColumn(id_col, read_id(F.col(id_col)))
    return hits.withColumns({"taxon": taxon_of(F.col(target_col)), "gene": gene_of(F.col(target_col))})


def without_taxon(hits: DataFrame, excluded: str) -> DataFrame:
    return hits.where(~F.col("taxon").contains(excluded))


def read_genes(hits: DataFrame) -> DataFrame:
    """Distinct (read_id, gene)."""
    return hits.select("read_id", "gene").distinct()


def genes_per_read(hits: DataFrame) -> DataFrame:
    return hits.groupBy("read_id").agg(F.array_join(F.sort_array(F.collect_set("gene")), ",").alias("genes"))


def reads_to_genes(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """Every read once for each gene it hits."""
    return reads.join(read_genes(hits), "read_id")


def pairs_to_genes(pairs: DataFrame, hits: DataFrame, unpaired: DataFrame | None = None) -> DataFrame:
    """Every pair (id1, id2) once for each gene of its first mate, or of its second where the first has none.

    Genes are collected once a read, so pairs are joined twice, by either mate, and never counted again. unpaired are
    reads without a mate (read_id): they come with read_id as id1 and a null id2.
    """
    genes = hits.groupBy("read_id").agg(F.collect_set("gene").alias("genes"))
    one, two = (genes.select(F.col("read_id").alias(f"id{n}"), F.col("genes").alias(f"_genes{n}")) for n in (1, 2))
    routed = pairs.join(one, "id1", "left").join(two, "id2", "left")
    out = routed.select(*pairs.columns, F.explode(F.coalesce("_genes1", "_genes2")).alias("gene"))
    if unpaired is None:
        return out
    alone = unpaired.join(read_genes(hits), "read_id").withColumnRenamed("read_id", "id1")
    return out.unionByName(alone, allowMissingColumns=True)


def total_reads(reads: DataFrame, paired: bool = False) -> DataFrame:
    """The number of input reads: rows, or twice as many where a row is a pair."""
    return reads.agg((F.count("*") * (2 if paired else 1)).alias("reads"))


def below_evalue(hits: DataFrame, most: float) -> DataFrame:
    return hits.where(F.col("evalue") <= most)


def gene_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("gene").agg(F.count("*").alias("reads"))


def target_scores(hits: DataFrame) -> DataFrame:
    return hits.groupBy("gene", "taxon").agg(F.sum(F.col("score").cast("long")).alias("total"))


def best_targets(hits: DataFrame) -> DataFrame:
    """(gene, taxon, total): per gene the taxon with the largest summed score."""
    rank = F.row_number().over(Window.partitionBy("gene").orderBy(F.desc("total"), "taxon"))
    return target_scores(hits).withColumn("rank", rank).where("rank = 1").drop("rank")


def tally(best: DataFrame) -> DataFrame:
    return best.groupBy("taxon").agg(F.count("*").alias("genes"))


def preferred(best: DataFrame, wanted: DataFrame) -> DataFrame:
    """best with the taxa of wanted(gene, taxon) where it names the gene."""
    named = wanted.select("gene", F.col("taxon").alias("wanted"))
    return best.join(named, "gene", "left").select("gene", F.coalesce("wanted", "taxon").alias("taxon"))


def chosen_sequences(targets: DataFrame, best: DataFrame) -> DataFrame:
    return targets.join(best.select("gene", "taxon"), ["gene", "taxon"])


def genes_without_hits(targets: DataFrame, hits: DataFrame) -> DataFrame:
    return targets.select("gene").distinct().join(hits.select("gene"), "gene", "left_anti")


def mapped_reads(hits: DataFrame) -> DataFrame:
    return hits.agg(F.countDistinct("read_id").alias("mapped"))
