"""Filtering, trimming, tiling and stitching of contig-to-target alignments.

All steps after the first shuffle share the partitioning by the gene key. Codon paths have unit 3, nucleotide paths 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import ranges, sequences


def above_identity(hsps: DataFrame, threshold: float = 55.0, sim: str = "sim") -> DataFrame:
    return hsps.where(F.col(sim) > threshold)


def without_frameshifts(hsps: DataFrame, spans: str = "intron_spans") -> DataFrame:
    return hsps.where(~ranges.frameshift(F.col(spans)))


def without_internal_stops(hsps: DataFrame, seq: str = "hit_seq", terminal_is_fine: bool = True) -> DataFrame:
    return hsps.where(~sequences.stops_inside(sequences.without_gaps(F.col(seq)), terminal_is_fine))


def keys_of(frame: DataFrame, keys: tuple[str, ...] | None) -> tuple[str, ...]:
    """The grouping keys: those given, or sample (where frame has it) and gene."""
    return keys or (("sample", "gene") if "sample" in frame.columns else ("gene",))


def hit_name(hsps: DataFrame) -> Column:
    """A name that tells a contig's hits apart: contig, gene, target range, identity, strand and, where known, contig range."""
    text = lambda c: F.col(c).cast("string")
    parts = [text("contig"), text("gene"), text("s"), text("e"), F.format_string("%.2f", F.col("sim").cast("double")), F.concat(F.lit("("), text("strand"), F.lit(")"))]
    if "h_frags" in hsps.columns:
        parts += [low_end(F.col("h_frags")).cast("string"), high_end(F.col("h_frags")).cast("string")]
    return F.concat_ws(",", *parts)


def low_end(frags: Column) -> Column:
    return F.array_min(F.transform(frags, lambda f: f["s"]))


def high_end(frags: Column) -> Column:
    return F.array_max(F.transform(frags, lambda f: f["e"]))


def trimmed(hsps: DataFrame, unit: int = 3, window: int = 5, threshold: float = 75.0) -> DataFrame:
    """Hits with weak ends cut: ident, hit_seq (gapped), s, e and sim; hits without a good window go.

    s_untrimmed and e_untrimmed keep the ranges as aligned, and sim_untrimmed the identity, where it was given. Contig
    ranges (h_frags) shrink too: the lowest start by what is cut in front, the highest end by what is cut behind, with
    h_frags_untrimmed as aligned.
    """
    cut = hsps.withColumn("trim", ranges.terminal_trim(F.col("ident"), window, threshold)).where("trim.five is not null and trim.three is not null")
    left = cut.withColumn("keep", F.size("ident") - F.col("trim.five") - F.col("trim.three")).where("keep > 0")
    five, three = F.col("trim.five") * unit, F.col("trim.three") * unit
    changed = {
        "s_untrimmed": F.col("s"),
        "e_untrimmed": F.col("e"),
        "ident": F.slice("ident", (F.col("trim.five") + 1).cast("int"), F.col("keep").cast("int")),
        "hit_seq": F.substr(F.col("hit_seq"), (five + 1).cast("int"), (F.col("keep") * unit).cast("int")),
        "s": F.col("s") + F.col("trim.five"),
        "e": F.col("e") - F.col("trim.three"),
    }
    if "sim" in hsps.columns:
        changed["sim_untrimmed"] = F.col("sim")
    if "h_frags" in hsps.columns:
        low, high = low_end(F.col("h_frags")), high_end(F.col("h_frags"))
        narrowed = lambda f: F.struct(F.when(f["s"] == low, f["s"] + five).otherwise(f["s"]).alias("s"), F.when(f["e"] == high, f["e"] - three).otherwise(f["e"]).alias("e"))
        changed |= {"h_frags_untrimmed": F.col("h_frags"), "h_frags": F.transform("h_frags", narrowed)}
    return left.withColumns(changed).withColumn("sim", ranges.identity(F.col("ident"))).drop("trim", "keep")


def uncontained(hsps: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Hits whose range lies in no other hit's range of the gene; of equal ranges the most similar (then deepest) stays.

    One shuffle: sorted by start, and the longer first, a hit is contained if an earlier one reaches as far.
    """
    keys = keys_of(hsps, keys)
    same = Window.partitionBy(*keys, "s", "e").orderBy(F.desc("sim"), F.desc("depth"), "contig")
    ahead = Window.partitionBy(*keys).orderBy("s", F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    once = hsps.repartition(*keys).withColumn("_nth", F.row_number().over(same)).where("_nth = 1")
    return once.withColumn("_reach", F.max("e").over(ahead)).where(F.coalesce(F.col("_reach") < F.col("e"), F.lit(True))).drop("_nth", "_reach")


def overlap_trimmed(hsps: DataFrame, keys: tuple[str, ...] | None = None, unit: int = 3, pad: bool = True) -> DataFrame:
    """Neighbours cut where they overlap, or padded with N where they don't touch; gaps are taken out.

    cut_bases is the number of bases that an overlap takes from a hit's end; null without one.
    """
    keys = keys_of(hsps, keys)
    order = Window.partitionBy(*keys).orderBy("s", "e", "contig")
    apart = F.col("next_s") - F.col("e")
    cut = F.substr(F.col("hit_seq"), F.lit(1), F.greatest(F.length("hit_seq") + apart * unit, F.lit(0)).cast("int"))
    filler = F.repeat(F.lit("N"), (apart * unit).cast("int")) if pad else F.lit("")
    plain = sequences.without_gaps
    return hsps.withColumn("next_s", F.lead("s").over(order)).withColumn("rank", F.row_number().over(order)).withColumn(
        "piece",
        F.when(F.col("next_s").isNull(), plain(F.col("hit_seq"))).when(apart < 0, plain(cut)).otherwise(F.concat(plain(F.col("hit_seq")), filler)),
    ).withColumn("cut_bases", F.when(apart < 0, F.length(plain(F.col("hit_seq"))) - F.length("piece")).cast("long"))


def stitched(pieces: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """One sequence a gene: its pieces in order, and their number."""
    keys = keys_of(pieces, keys)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "piece")))
    return pieces.groupBy(*keys).agg(F.count("*").alias("hits"), F.array_join(F.transform(ordered, lambda x: x["piece"]), "").alias("seq"))


def extract(hsps: DataFrame, keys: tuple[str, ...] | None = None, unit: int = 3, threshold: float = 55.0, window: int = 5, window_threshold: float = 75.0, skip_frameshifts: bool = False, skip_stops: bool = False, pad: bool = True) -> DataFrame:
    """The whole path from alignments to one sequence a gene."""
    kept = trimmed(above_identity(hsps, threshold, "sim"), unit, window, window_threshold)
    if skip_frameshifts:
        kept = without_frameshifts(kept)
    if skip_stops:
        kept = without_internal_stops(kept)
    out = stitched(overlap_trimmed(uncontained(kept, keys), keys, unit, pad), keys)
    if unit == 3:
        out = out.withColumn("protein", sequences.translate(sequences.pad_codons(F.col("seq")))).withColumn("internal_stop", sequences.internal_stops(F.col("protein")) > 0)
    return out


def longest(hsps: DataFrame, keys: tuple[str, ...] | None = None, seq: str = "hit_seq") -> DataFrame:
    """Per gene the longest hit; ties to the smaller contig name."""
    keys = keys_of(hsps, keys)
    return hsps.groupBy(*keys).agg(F.min_by(F.struct("contig", seq), F.struct(-F.length(seq), F.col("contig"))).alias("x")).select(*keys, "x.contig", F.col(f"x.{seq}").alias("seq"))


def stage_report(stages: dict[str, DataFrame], keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """Hits by gene after each named stage."""
    out = None
    for name, frame in stages.items():
        part = frame.groupBy(*keys).agg(F.count("*").alias("hits")).withColumn("stage", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


#: The columns of the report of hits by stage.
STAGE_COLUMNS = [
    "query_id", "query_length", "hit_id", "query_HSP_range_limits_original", "query_HSP_range_limits_trimmed", "query_HSPFragment_ranges", "hit_percent_similarity_original", "hit_percent_similarity_trimmed",
    "hit_strand", "hit_HSP_range_limits_original", "hit_HSP_range_limits_trimmed", "hit_HSPFragment_ranges_original", "hit_HSPFragment_ranges_trimmed", "3-prime_bases_trimmed",
]


def stage_rows(stages: dict[str, DataFrame], keys: tuple[str, ...] = ("gene",)) -> DataFrame:
    """A row for each hit after each named stage: stage, keys and STAGE_COLUMNS, ranges written as (from, to).

    Needs trimmed hits; what a frame lacks is empty. Bases cut are N/A before overlaps are cut and where there is none.
    """
    pair = lambda a, b: F.concat(F.lit("("), a.cast("string"), F.lit(", "), b.cast("string"), F.lit(")"))
    listed = lambda frags: F.concat(F.lit("["), F.array_join(F.transform(frags, lambda f: pair(f["s"], f["e"])), ", "), F.lit("]"))
    out = None
    for name, frame in stages.items():
        has = lambda c: c in frame.columns  # noqa: B023, E731
        of = lambda c, column, need=None: column if has(need or c) else F.lit(None).cast("string")  # noqa: B023, E731
        columns = [
            F.col("gene").cast("string"), of("query_len", F.col("query_len").cast("string") if has("query_len") else None), F.col("contig"), pair(F.col("s_untrimmed"), F.col("e_untrimmed")), pair(F.col("s"), F.col("e")),
            listed(F.col("q_frags")) if has("q_frags") else F.concat(F.lit("["), pair(F.col("s_untrimmed"), F.col("e_untrimmed")), F.lit("]")), F.col("sim_untrimmed").cast("string"), F.col("sim").cast("string"), F.col("strand").cast("string"),
            *((pair(low_end(F.col(c)), high_end(F.col(c))) if has("h_frags") else F.lit(None).cast("string")) for c in ("h_frags_untrimmed", "h_frags")), *((listed(F.col(c)) if has("h_frags") else F.lit(None).cast("string")) for c in ("h_frags_untrimmed", "h_frags")),
            F.coalesce(F.col("cut_bases").cast("string"), F.lit("N/A")) if has("cut_bases") else F.lit("N/A"),
        ]
        part = frame.select(F.lit(name).alias("stage"), *keys, *(c.alias(n) for c, n in zip(columns, STAGE_COLUMNS)))
        out = part if out is None else out.unionByName(part)
    return out
