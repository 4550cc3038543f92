"""The engine's commands as functions of DataFrames; each returns DataFrames and writes nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import checks, ranges, sequences
from baitline.operators import assembly, chimera, distribute, hits, introns, mapping, paralogs, reports, targets


@dataclass
class Options:
    """Parameters that change results, with their defaults; nucleotide paths use ``nucleotide()``."""

    thresh: float = 55.0
    unit: int = 3
    window: int = 5
    window_threshold: float = 75.0
    paralog_min_length_percentage: float = 0.75
    depth_multiplier: float = 10.0
    stitched_contig_pad_n: bool = True
    no_stitched_contig: bool = False
    skip_frameshifts: bool = False
    skip_internal_stops: bool = False
    chimera_edit_distance: int = 5
    chimera_pair_cutoff: int = 5
    chimera_subfilter: int = 7
    max_target_seqs: int = 10
    evalue: float = 1e-4
    word_size: int | None = None
    cov_cutoff: int = 8
    kvals: tuple[int, ...] | None = None

    def __post_init__(self) -> None:
        if self.word_size is not None:
            checks.word_size(self.word_size)
        checks.identity(self.thresh)
        checks.identity(self.window_threshold)
        checks.fraction(self.paralog_min_length_percentage)

    @classmethod
    def nucleotide(cls, **changes) -> Options:
        return cls(**{"unit": 1, "window": 15, "window_threshold": 65.0, **changes})


def map_reads(reads: DataFrame, target_set: DataFrame, protein: bool = False, most: int = 10, word_size: int | None = None) -> DataFrame:
    """(read_id, target, score, taxon, gene) by k-mer votes; precomputed hits can take its place."""
    k = word_size or (5 if protein else 21)
    votes = mapping.map_reads(reads, target_set.select(F.col("name").alias("target"), "seq"), k=k, most=most, both_strands=not protein, translated=protein)
    return distribute.named_hits(votes.withColumnRenamed("votes", "score"))


def distribute_reads(reads: DataFrame, read_hits: DataFrame, paired: bool = False, unpaired: DataFrame | None = None, options: Options | None = None) -> dict[str, DataFrame]:
    """Reads by gene, reads a gene, the number of mapped reads and that of all reads.

    Pairs may come with reads that lost their mate (unpaired). Hits that carry an evalue must not exceed the options'.
    """
    if options is not None and "evalue" in read_hits.columns:
        read_hits = distribute.below_evalue(read_hits, options.evalue)
    routed = distribute.pairs_to_genes(reads, read_hits, unpaired) if paired else distribute.reads_to_genes(reads, read_hits)
    total = distribute.total_reads(reads, paired)
    if unpaired is not None:
        total = total.unionByName(distribute.total_reads(unpaired)).agg(F.sum("reads").alias("reads"))
    return {"reads": routed, "counts": distribute.gene_counts(routed), "mapped": distribute.mapped_reads(read_hits), "total": total}


def select_targets(target_set: DataFrame, read_hits: DataFrame, wanted: DataFrame | None = None, exclude: str | None = None) -> dict[str, DataFrame]:
    """The best (or preferred) target sequence of each gene, the taxon tally, and genes without hits."""
    best = distribute.best_targets(distribute.without_taxon(read_hits, exclude) if exclude else read_hits)
    chosen = distribute.preferred(best, wanted) if wanted is not None else best
    return {"targets": distribute.chosen_sequences(target_set, chosen), "tally": distribute.tally(chosen), "without_hits": distribute.genes_without_hits(target_set, read_hits)}


def extract_contigs(hsps: DataFrame, keys: tuple[str, ...] | None = None, options: Options = Options()) -> dict[str, DataFrame]:
    """Gene sequences, paralogs with names, and the hits after each stage, from alignments.

    hsps: keys, contig, s, e, ident, hit_seq (gapped), sim, depth, strand; query_len for paralogs; h_frags (contig
    ranges) and q_frags (target ranges) where alignments have several fragments.
    """
    o = options
    keys = hits.keys_of(hsps, keys)
    if "q_frags" not in hsps.columns:
        hsps = hsps.withColumn("q_frags", F.array(F.struct("s", "e")))
    similar = kept = hits.trimmed(hits.above_identity(hsps, o.thresh), o.unit, o.window, o.window_threshold)
    stages = {"identity": similar}
    if o.skip_frameshifts:
        kept = stages["frameshifts"] = hits.without_frameshifts(kept)
    if o.skip_internal_stops:
        kept = stages["stops"] = hits.without_internal_stops(kept)
    tiled = stages["tiled"] = hits.uncontained(kept, keys)
    pieces = stages["cut"] = hits.overlap_trimmed(tiled, keys, o.unit, o.stitched_contig_pad_n)
    genes = hits.longest(tiled, keys).withColumn("seq", sequences.without_gaps(F.col("seq"))) if o.no_stitched_contig else hits.stitched(pieces, keys)
    if o.unit == 3:
        genes = genes.withColumn("protein", sequences.translate(sequences.pad_codons(F.col("seq")))).withColumn("internal_stop", sequences.internal_stops(F.col("protein")) > 0)
    out = {"genes": genes, "pieces": pieces, "stages": hits.stage_report(stages, keys)}
    if {"strand", "sim"} <= set(hsps.columns):
        out["stage_rows"] = hits.stage_rows(stages, keys)
    if "query_len" in hsps.columns:
        out |= paralog_hits(similar, keys, o)
    return out


def paralog_hits(similar: DataFrame, keys: tuple[str, ...] | None = None, options: Options = Options()) -> dict[str, DataFrame]:
    """Paralogs (named, with sequences), their warnings, and the warning by depth, of hits after trimming.

    Long by the ranges as aligned (q_frags); ranked, named and written as trimmed.
    """
    o, keys = options, hits.keys_of(similar, keys)
    found = paralogs.long_hits(similar, o.paralog_min_length_percentage)
    several = found.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n > 1").drop("_n")
    named = paralogs.named(paralogs.with_main(several, keys, o.depth_multiplier), keys).withColumn("seq", sequences.without_gaps(F.col("hit_seq")))
    spans = similar.select(*keys, F.explode("q_frags").alias("f")).select(*keys, "f.s", "f.e")
    lengths = similar.groupBy(*keys).agg(F.max("query_len").alias("query_len"))
    return {"paralogs": named, "paralog_warnings": named.select(*keys, "contig"), "depth": paralogs.depth_warning(spans, lengths, o.paralog_min_length_percentage, keys)}


def assemble(reads: DataFrame, target_set: DataFrame, protein: bool = False, options: Options | None = None) -> dict[str, DataFrame]:
    """One sample from reads(read_id, seq) to gene sequences, with native mapping, assembly and alignment."""
    options = options or (Options() if protein else Options.nucleotide())
    read_hits = map_reads(reads, target_set, protein, options.max_target_seqs, options.word_size)
    routed = distribute.reads_to_genes(reads, read_hits)
    chosen = select_targets(target_set, read_hits)["targets"]
    contigs = assembly.assemble(routed, ("gene",), options.kvals or 31, least_depth=options.cov_cutoff)
    pairs = contigs.join(chosen.select("gene", F.col("seq").alias("target_seq")), "gene").withColumnRenamed("seq", "contig_seq")
    lengths = pairs.select("gene", "contig", "depth", F.length("target_seq").alias("query_len"))
    hsps = (assembly.align_spliced(pairs) if protein else assembly.align(pairs)).join(lengths, ["gene", "contig"])
    return {"hits": read_hits, "counts": distribute.gene_counts(routed), "contigs": contigs, **extract_contigs(hsps, ("gene",), options)}


def chimera_check(pieces: DataFrame, pairs: DataFrame, options: Options = Options()) -> dict[str, DataFrame]:
    """Genes with chimeric stitching, from reads: pieces (gene, contig, rank, piece[, h_frags]) and pairs(gene, pair, seq1, seq2).

    Reads are placed on the stitched sequence without gaps; pairs with both mates placed are kept.
    """
    stitched = hits.stitched(pieces, ("gene",)).select("gene", F.col("seq").alias("ref"))
    reads = pairs.select("gene", "pair", F.explode(F.array(*(F.struct(F.lit(n).alias("mate"), F.col(f"seq{n}").alias("seq")) for n in (1, 2)))).alias("r"))
    asked = reads.select("gene", F.struct("pair", "r.mate").alias("read_id"), "r.seq")
    placed = assembly.ungapped(asked, stitched, options.chimera_subfilter).select("gene", "read_id.pair", "read_id.mate", "start", "end", "nm")
    return chimeras(pieces, chimera.mates(placed), options)


def chimeras(pieces: DataFrame, mates: DataFrame, options: Options = Options()) -> dict[str, DataFrame]:
    """The discordant pairs between contigs, and the genes with more of them than the cutoff.

    mates(gene, pair, start1, end1, nm1, start2, end2, nm2) are pairs placed on the stitched sequence.
    """
    found = chimera.between_contigs(mates, chimera.exon_lots(pieces), options.chimera_edit_distance)
    return {"pairs": found, "genes": found.groupBy("gene").agg(F.count("*").alias("pairs")).where(F.col("pairs") > options.chimera_pair_cutoff)}


def intronerate(pieces: DataFrame, contigs: DataFrame, pad: bool = True, unit: int = 3, proteins: DataFrame | None = None) -> dict[str, DataFrame]:
    """Supercontigs and intron texts of genes whose hits are coherent.

    pieces: hits after overlaps were cut (gene, contig, rank, e, strand, h_frags, piece, cut_bases); contigs(gene,
    contig, seq). A contig that an overlap took more than three residues from ends where its hit ends. Introns are those
    of the hits, or, with proteins(gene, protein), those of each protein (without X) aligned anew with its supercontig.
    """
    fine = pieces.join(introns.coherent(pieces), "gene", "left_semi")
    placed = introns.furthest(fine).join(contigs.select("gene", "contig", F.col("seq").alias("contig_seq")), ["gene", "contig"])
    back = F.col("strand") == -1
    turned = F.when(back, sequences.reverse_complement(F.col("contig_seq"))).otherwise(F.col("contig_seq"))
    frags = F.when(back, ranges.reversed_ranges(F.col("h_frags"), F.length("contig_seq").cast("long"))).otherwise(F.col("h_frags"))
    whole = placed.withColumn("_turned", turned).withColumn("h_frags", F.array_sort(frags))
    cut = whole.withColumn("seq", introns.cut_contig(F.col("_turned"), F.col("h_frags"), F.length("piece").cast("long"), F.col("cut_bases"), 3 * unit))
    within = F.filter(ranges.introns(F.col("h_frags")), lambda x: x["e"] <= F.length("seq"))
    texts = cut.withColumn("introns", ranges.slices(F.col("seq"), within))
    whole = introns.supercontig(cut, filler=10 if pad else 0)
    if proteins is None:
        return {"supercontigs": whole, "introns": texts.where(F.size("introns") > 0).select("gene", "contig", "rank", "introns")}
    target = F.replace(F.replace("protein", F.lit("X"), F.lit("")), F.lit("*"), F.lit(""))
    anew = assembly.align_spliced(whole.join(proteins.select("gene", target.alias("target_seq")), "gene").select("gene", F.lit("supercontig").alias("contig"), "target_seq", F.col("supercontig").alias("contig_seq")))
    between = F.filter(ranges.introns(F.array_sort("h_frags")), lambda x: x["e"] - x["s"] >= assembly.LEAST_INTRON)
    found = anew.where("strand = 1").join(whole, "gene").select("gene", "contig", F.lit(1).alias("rank"), ranges.slices(F.col("supercontig"), between).alias("introns"))
    return {"supercontigs": whole, "introns": found.where(F.size("introns") > 0)}


def stats(samples: DataFrame, reads: DataFrame, lengths: DataFrame, target_set: DataFrame, flags: DataFrame, protein: bool = False, mapped_genes: DataFrame | None = None, contig_genes: DataFrame | None = None) -> dict[str, DataFrame]:
    """The per-sample report, and the long table behind the length matrix with every sample and gene."""
    means = reports.mean_lengths(target_set, protein)
    return {"stats": reports.stats(samples, reads, lengths, means, flags, mapped_genes, contig_genes), "lengths": reports.grid(samples, means, lengths, "len"), "means": means}


def retrieve_sequences(genes: DataFrame, kind: str, wanted: DataFrame | None = None, passing: DataFrame | None = None, chimeras: DataFrame | None = None) -> DataFrame:
    """Sequences of one kind of the wanted samples that pass, without chimeric genes."""
    out = genes.where(F.col("kind") == kind)
    for names in (wanted, passing):
        if names is not None:
            out = out.join(names.select("sample"), "sample", "left_semi")
    return reports.without_chimeras(out, chimeras.select("sample", "gene")) if chimeras is not None else out


def paralog_retriever(samples: DataFrame, found: DataFrame, genes: DataFrame, chimeras: DataFrame | None = None, share: float = 0.0) -> dict[str, DataFrame]:
    """All paralogs (or the gene's sequence), those without chimeras, the copy matrix, and the threshold lists."""
    every = reports.paralogs_or_gene(found, genes)
    copies = reports.paralog_counts(every)
    n_samples, n_genes = samples.select("sample").distinct().count(), every.select("gene").distinct().count()
    over = {"genes": reports.genes_over(copies, max(n_samples, 1), share), "samples": reports.samples_over(copies, max(n_genes, 1), share)}
    out = {"paralogs_all": every, "matrix": reports.grid(samples, every, copies, "copies"), **over, "report": reports.threshold_report(over["samples"], over["genes"], share)}
    if chimeras is not None:
        out["paralogs_no_chimeras"] = reports.without_chimeras(every, chimeras.select("sample", "gene"))
    return out


def recovery_heatmap(lengths: DataFrame, means: DataFrame) -> DataFrame:
    """(sample, gene, recovered): what the heatmap shows; drawing is left to the caller."""
    return reports.recovery(lengths, means)


def check_targetfile(target_set: DataFrame, protein: bool = False) -> DataFrame:
    return targets.check(target_set, protein)


def fix_targetfile(target_set: DataFrame, share: float = 0.0, low_complexity_names: DataFrame | None = None, allow_gene_removal: bool = False, **options) -> dict[str, DataFrame]:
    """The repaired set, what was left out and why, and the genes that lost all their sequences.

    Unless it is allowed, a gene that loses all its sequences is an error. options are those of targets.fix; references
    may be proteins(gene, seq, ord) of which the first of each gene counts.
    """
    if (given := options.get("references")) is not None and "reference" not in given.columns:
        options["references"] = targets.first_references(given)
    report = targets.fix(target_set, checks.fraction(share), low_complexity_names, maximum_distance=checks.fraction(options.pop("maximum_distance", 0.5)), **options)
    kept = report.where("reason is null").drop("reason")
    lost = targets.lost_genes(target_set, kept)
    if not allow_gene_removal and (names := [r.gene for r in lost.orderBy("gene").limit(20).collect()]):
        raise ValueError(f"genes that would lose all their sequences: {', '.join(map(str, names))}")
    return {"kept": kept, "removed": report.where("reason is not null").select("name", "gene", "reason").join(target_set.select("name", "gene", F.col("seq")), ["name", "gene"]), "lost_genes": lost, "proteins": kept.withColumn("seq", sequences.translate(F.col("seq")))}


def filter_by_length(genes: DataFrame, lengths: DataFrame, means: DataFrame, length_filter: int = 0, percent_filter: float = 0.0) -> dict[str, DataFrame]:
    rows = reports.denied(lengths, means, length_filter, percent_filter)
    return {"genes": reports.without_denied(genes, rows), "denied": rows, "deny_list": reports.deny_list(rows)}


def concatenate_alignments(files: DataFrame, codons: bool = False) -> dict[str, DataFrame]:
    return {"alignment": reports.concatenated(files), "partitions": reports.partitions(files, codons)}
