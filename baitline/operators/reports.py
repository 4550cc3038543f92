"""Cross-sample reports. Matrices stay long (sample, gene, value); only sinks pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import sequences


def mean_lengths(targets: DataFrame, protein: bool = False) -> DataFrame:
    """Mean target length of each gene in nucleotides, rounded half to even."""
    return targets.groupBy("gene").agg(F.bround(F.avg(F.length("seq") * (3 if protein else 1)), 0).cast("long").alias("mean_len"))


def length_without_n(seq: Column) -> Column:
    return F.length(F.replace(seq, F.lit("N"), F.lit(""))).cast("long")


def thresholds(lengths: DataFrame, means: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75, 1.5)) -> DataFrame:
    """Per sample the genes longer than shares of their mean target."""
    joined = lengths.join(means, "gene")
    return joined.groupBy("sample").agg(*(F.count_if(F.col("len") > F.col("mean_len") * s).alias(f"above_{round(s * 100)}") for s in shares))


def recovery(lengths: DataFrame, means: DataFrame) -> DataFrame:
    """Share of the mean target that was recovered, at most 1."""
    return lengths.join(means, "gene").select("sample", "gene", F.least(F.col("len") / F.col("mean_len"), F.lit(1.0)).alias("recovered"))


def grid(samples: DataFrame, genes: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Every sample with every gene, 0 where values has none. Both lists are report axes, not data."""
    axes = samples.select("sample").distinct().crossJoin(genes.select("gene").distinct())
    return axes.join(values, ["sample", "gene"], "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def wide(values: DataFrame, value: str, genes: list | None = None) -> DataFrame:
    """One row a sample, one column a gene."""
    return values.groupBy("sample").pivot("gene", genes).agg(F.first(value))


def enrichment(reads: DataFrame) -> DataFrame:
    return reads.withColumn("pct_on_target", sequences.percent(F.col("mapped"), F.col("total"), 1))


def passing(stats: DataFrame, rules: list[tuple[str, str, float]], genes: int) -> DataFrame:
    """Samples that meet all rules (column, greater|smaller, threshold); fractions are shares of the genes, half to even."""
    for column, side, threshold in rules:
        limit = threshold if isinstance(threshold, int) else round(threshold * genes)
        stats = stats.where(F.col(column) > limit if side == "greater" else F.col(column) < limit)
    return stats


def without_chimeras(sequences_: DataFrame, chimeras: DataFrame) -> DataFrame:
    return sequences_.join(chimeras, ["sample", "gene"], "left_anti")


def paralogs_or_gene(paralogs: DataFrame, genes: DataFrame) -> DataFrame:
    """All paralogs, and the gene's sequence where a sample has no paralogs."""
    return paralogs.unionByName(genes.join(paralogs.select("sample", "gene").distinct(), ["sample", "gene"], "left_anti"))


def paralog_counts(sequences_: DataFrame) -> DataFrame:
    return sequences_.groupBy("sample", "gene").agg(F.count("*").alias("copies"))


def genes_over(copies: DataFrame, samples: int, share: float) -> DataFrame:
    """Genes with paralogs in at least share of the samples."""
    return copies.where("copies > 1").groupBy("gene").agg(F.count("*").alias("samples")).where(F.col("samples") / samples >= share)


def samples_over(copies: DataFrame, genes: int, share: float) -> DataFrame:
    """Samples with paralogs in at least share of the genes."""
    return copies.where("copies > 1").groupBy("sample").agg(F.count("*").alias("genes")).where(F.col("genes") / genes >= share)


def denied(lengths: DataFrame, means: DataFrame, least: int = 0, share: float = 0.0) -> DataFrame:
    """Recovered sequences that are too short, absolutely or against the mean target."""
    return lengths.join(means, "gene").where((F.col("len") > 0) & ((F.col("len") < least) | (F.col("len") < F.col("mean_len") * share))).select("sample", "gene")


def deny_list(rows: DataFrame) -> DataFrame:
    return rows.groupBy("gene").agg(F.array_join(F.array_sort(F.collect_list(F.col("sample"))), ",").alias("samples"))


def without_denied(values: DataFrame, rows: DataFrame) -> DataFrame:
    return values.join(rows, ["sample", "gene"], "left_anti")


def missing_samples(wanted: DataFrame, found: DataFrame) -> DataFrame:
    return wanted.join(found, "sample", "left_anti")


def status_counts(flags: DataFrame) -> DataFrame:
    """Per sample the genes in each state."""
    return flags.groupBy("sample").agg(
        F.count_if(F.col("stitched") == "single").alias("without_stitched"), F.count_if(F.col("stitched") == "stitched").alias("with_stitched"), F.count_if(F.col("stitched") == "skipped").alias("skipped"),
        F.count_if("chimera").alias("chimeras"), F.count_if("paralog_long").alias("paralogs_long"), F.count_if("paralog_depth").alias("paralogs_depth"),
    )


#: The columns of the report of samples.
STATS_COLUMNS = [
    "Name", "NumReads", "ReadsMapped", "PctOnTarget", "GenesMapped", "GenesWithContigs", "GenesWithSeqs", "GenesAt25pct", "GenesAt50pct", "GenesAt75pct", "GenesAt150pct", "ParalogWarningsLong", "ParalogWarningsDepth",
    "GenesWithoutStitchedContigs", "GenesWithStitchedContigs", "GenesWithStitchedContigsSkipped", "GenesWithChimeraWarning", "TotalBasesRecovered",
]


def stats(samples: DataFrame, reads: DataFrame, lengths: DataFrame, means: DataFrame, flags: DataFrame, mapped_genes: DataFrame | None = None, contig_genes: DataFrame | None = None) -> DataFrame:
    """The per-sample report (STATS_COLUMNS), one row a sample, zeros where nothing was recovered.

    mapped_genes and contig_genes are (sample, gene) of genes with mapped reads and with contigs; without them, genes
    with sequences are counted.
    """
    count = lambda frame, name: frame.select("sample", "gene").distinct().groupBy("sample").agg(F.count("*").alias(name))
    with_seqs = lengths.where("len > 0")
    found = with_seqs.groupBy("sample").agg(F.count("*").alias("genes_with_seqs"), F.sum("len").alias("bases"))
    parts = [enrichment(reads), count(mapped_genes if mapped_genes is not None else with_seqs, "genes_mapped"), count(contig_genes if contig_genes is not None else with_seqs, "genes_with_contigs"), found, thresholds(lengths, means), status_counts(flags)]
    out = samples.select("sample")
    for part in parts:
        out = out.join(part, "sample", "left")
    own = ["sample", "total", "mapped", "pct_on_target", "genes_mapped", "genes_with_contigs", "genes_with_seqs", "above_25", "above_50", "above_75", "above_150", "paralogs_long", "paralogs_depth", "without_stitched", "with_stitched", "skipped", "chimeras", "bases"]
    return out.select(*(F.col(c).alias(name) if c == "sample" else F.coalesce(F.col(c), F.lit(0)).alias(name) for c, name in zip(own, STATS_COLUMNS)))


def threshold_report(samples: DataFrame, genes: DataFrame, share: float) -> DataFrame:
    """(rank, value): the lines of the report on samples and genes with paralogs in at least share of the others."""
    listed = lambda frame, c: frame.agg(F.array_sort(F.collect_list(F.col(c).cast("string"))).alias("n"))
    of = lambda what, other: F.concat(F.lit("There are "), F.size("n").cast("string"), F.lit(f" {what}s with paralogs in >= {share}% of {other}s. The {what} names are:"))
    first = listed(samples, "sample").select(F.concat(F.array(of("sample", "gene")), F.col("n"), F.array(F.lit(""))).alias("a"))
    second = listed(genes, "gene").select(F.concat(F.array(of("gene", "sample")), F.col("n")).alias("b"))
    return first.crossJoin(second).select(F.posexplode(F.concat("a", "b")).alias("rank", "value"))


def aligned(files: DataFrame) -> DataFrame:
    """Every name in every file(file, name, seq); a name that a file lacks gets gaps of the file's length."""
    size = files.groupBy("file").agg(F.max(F.length("seq")).alias("size"))
    names = files.select("name").distinct()
    return names.crossJoin(size).join(files, ["file", "name"], "left").select("file", "name", F.coalesce("seq", F.repeat(F.lit("-"), F.col("size").cast("int"))).alias("seq"))


def concatenated(files: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("file", "seq")))
    return aligned(files).groupBy("name").agg(F.array_join(F.transform(ordered, lambda x: x["seq"]), "").alias("seq"))


def partitions(files: DataFrame, codons: bool = False) -> DataFrame:
    """(file, part, from_pos, to_pos, stride) of each file in the concatenated alignment; codon parts are 1+2 and 3."""
    size = files.groupBy("file").agg(F.max(F.length("seq")).cast("long").alias("size"))
    end = F.sum("size").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0))
    whole = size.withColumn("to_pos", end).withColumn("from_pos", F.col("to_pos") - F.col("size") + 1)
    if not codons:
        return whole.select("file", F.lit("all").alias("part"), "from_pos", "to_pos", F.lit(1).cast("long").alias("stride"))
    rows = F.explode(F.array(*(F.struct(F.lit(p).alias("part"), F.lit(i).cast("long").alias("shift")) for p, i in (("codon1", 0), ("codon2", 1), ("codon3", 2)))))
    return whole.withColumn("x", rows).select("file", "x.part", (F.col("from_pos") + F.col("x.shift")).alias("from_pos"), "to_pos", F.lit(3).cast("long").alias("stride"))
