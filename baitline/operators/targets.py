"""Checks and repairs of target sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import sequences


def bad_headers(targets: DataFrame) -> DataFrame:
    return targets.where(~sequences.good_header(F.col("name")))


def duplicate_names(targets: DataFrame) -> DataFrame:
    return targets.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")


def frames(targets: DataFrame) -> DataFrame:
    """Each sequence in three forward frames, with the stops inside; open frames have none."""
    rows = None
    for offset in range(3):
        part = targets.withColumn("frame", F.lit(offset).cast("long")).withColumn("protein", sequences.translate(sequences.frame(F.col("seq"), offset)))
        rows = part if rows is None else rows.unionByName(part)
    return rows.withColumn("inside", sequences.internal_stops(F.col("protein"))).withColumn("open", F.col("inside") == 0)


def low_complexity(targets: DataFrame, window: int | None = None, threshold: float | None = None, protein: bool = False) -> DataFrame:
    """Sequences with a window of low entropy; None takes the kind's default."""
    window = window if window is not None else (50 if protein else 100)
    threshold = threshold if threshold is not None else (3.0 if protein else 1.5)
    return targets.where(least_entropy(window)(F.col("seq")) <= threshold)


def least_entropy(window: int):
    """A function of sequences: the least Shannon entropy (bits) of any window; a shorter sequence is one window.

    Counts of a letter in all windows come from its running count, so the work is length times letters, whatever the
    window; column expressions would count anew in each window.
    """
    from pyspark.sql.functions import pandas_udf

    share = np.arange(window + 1) / window
    part = np.where(share > 0, share * np.log2(np.where(share > 0, share, 1)), 0.0)

    def of(letters: np.ndarray) -> float:
        total = np.zeros(len(letters) - window + 1)
        for letter in np.unique(letters):
            seen = np.concatenate(([0], np.cumsum(letters == letter)))
            total += part[seen[window:] - seen[:-window]]
        return float(-total.max())

    @pandas_udf("double")
    def least(seqs: pd.Series) -> pd.Series:
        known = seqs.notna().to_numpy()
        texts = seqs[known].tolist()
        letters = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        found = np.zeros(len(texts))
        short = sizes < window
        for i in np.flatnonzero(~short):
            found[i] = of(letters[ends[i] - sizes[i] : ends[i]])
        found[short] = _entropies(letters[np.repeat(short, sizes)], sizes[short])
        out = np.full(len(seqs), np.nan)
        out[known] = found
        return pd.Series(out, dtype="float64").where(known, None)

    return least


def _entropies(letters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Entropy of each text, of texts that follow each other in letters; 0 for empty ones. One count over all of them."""
    known, number = np.unique(letters, return_inverse=True) if len(letters) and letters.max() > 255 else (np.arange(256), letters)
    seen = np.flatnonzero(np.bincount(number, minlength=len(known))) if len(letters) else np.empty(0, np.int64)
    place = np.zeros(len(known), np.int64)
    place[seen] = np.arange(len(seen))
    out = np.zeros(len(sizes))
    step = max(1, (1 << 22) // max(len(seen), 1))
    ends = np.cumsum(sizes)
    for low in range(0, len(sizes), step):
        n = sizes[low : low + step]
        own = place[number[ends[low] - n[0] : ends[low + len(n) - 1]]]
        counts = np.bincount(np.repeat(np.arange(len(n)), n) * len(seen) + own, minlength=len(n) * len(seen)).reshape(len(n), len(seen))
        shares = counts / np.maximum(n, 1)[:, None]
        out[low : low + len(n)] = -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(axis=1)
    return out


def relative_length(targets: DataFrame, share: float) -> DataFrame:
    """Sequences that are their gene's only one, or longer than share of its longest."""
    gene = Window.partitionBy("gene")
    return targets.withColumns({"_n": F.count("*").over(gene), "_max": F.max(F.length("seq")).over(gene)}).where((F.col("_n") == 1) | (F.length("seq") > F.col("_max") * share)).drop("_n", "_max")


def lost_genes(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.select("gene").distinct().join(after.select("gene"), "gene", "left_anti")


def check(targets: DataFrame, protein: bool = False, window: int | None = None, threshold: float | None = None) -> DataFrame:
    """(section, name): every violation; low-complexity, stops inside, length not whole codons, bad or repeated names."""
    of = lambda section, frame: frame.select(F.lit(section).alias("section"), "name")
    out = of("header", bad_headers(targets)).unionByName(of("duplicate", duplicate_names(targets))).unionByName(of("low_complexity", low_complexity(targets, window, threshold, protein)))
    if protein:
        return out
    seq = F.col("seq")
    return out.unionByName(of("not_codons", targets.where(F.length("seq") % 3 != 0))).unionByName(of("stops", targets.where(sequences.stops_inside(seq)))).unionByName(of("terminal_stop", targets.where(sequences.ends_in_stop(seq) & (sequences.stop_codons(seq) == 1))))


def control_rows(report: DataFrame, settings: dict[str, object]) -> DataFrame:
    """(rank, key, values) of the control file for fix, from a report of check: settings by key, and the names with low complexity."""
    spark = report.sparkSession
    rows = spark.createDataFrame([(i, k, [str(v)]) for i, (k, v) in enumerate(settings.items())], "rank int, key string, values array<string>")
    names = F.array_sort(F.collect_set("name"))
    # a filter, so the report's other sections aren't worked out
    low = report.where(F.col("section") == "low_complexity").agg(names.alias("n")).select(F.lit(len(settings)).alias("rank"), F.lit("LOW_COMPLEXITY_SEQUENCES").alias("key"), F.when(F.size("n") > 0, F.col("n")).otherwise(F.array(F.lit("None"))).alias("values"))
    return rows.unionByName(low)


def first_references(proteins: DataFrame) -> DataFrame:
    """(gene, reference) of proteins(gene, seq, ord): the first of each gene."""
    return proteins.groupBy("gene").agg(F.min_by("seq", "ord").alias("reference"))


def open_frames(targets: DataFrame, no_terminal_stop: bool = False) -> DataFrame:
    """The frames of each sequence without stops, but for one at the very end if that is allowed: frame, protein and bases.

    Stops are sought in the frame padded to whole codons, so a stop before a cut-off codon counts as inside.
    """
    rows = None
    for offset in range(3):
        rest = F.substr(F.col("seq"), F.lit(offset + 1), F.length("seq"))
        part = targets.where(~sequences.stops_inside(rest, terminal_is_fine=not no_terminal_stop))
        part = part.withColumns({"frame": F.lit(offset).cast("long"), "bases": sequences.frame(F.col("seq"), offset)})
        rows = part if rows is None else rows.unionByName(part)
    return rows.withColumn("protein", sequences.translate(F.col("bases")))


def distances(pairs: DataFrame, scores: dict[tuple[str, str], float] | None = None) -> DataFrame:
    """pairs(..., protein, reference) with their distance after global alignment; null where there is no reference."""
    from pyspark.sql.functions import pandas_udf

    from baitline.operators.assembly import protein_distances

    @pandas_udf("double")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        known = b.notna()
        out = pd.Series(np.nan, index=a.index, dtype="float64")
        out[known] = protein_distances(a[known].tolist(), b[known].tolist(), scores)
        return out.where(known, None)

    return pairs.withColumn("distance", distance("protein", "reference"))


def fix(
    targets: DataFrame, share: float = 0.0, low_complexity_names: DataFrame | None = None, references: DataFrame | None = None, maximum_distance: float = 0.5, no_terminal_stop: bool = False,
    keep_low_complexity: bool = False, scores: dict[tuple[str, str], float] | None = None,
) -> DataFrame:
    """Targets with the reason to leave them out (null: kept), and the frame and sequence to use.

    A sequence without an open frame goes. Open frames are compared, by the distance of their proteins, with the gene's
    reference (references(gene, reference)); the nearest is taken, and one farther than maximum_distance goes. Without a
    reference, a single open frame is right, and several are compared with the longest sequence of the gene that has a
    single one; where there is none, the frame is undetermined. Then sequences go that are no longer than share of their
    gene's longest, and those named as of low complexity, unless they are to be kept.
    """
    name = Window.partitionBy("name", "gene")
    opened = open_frames(targets.select("name", "gene", "seq"), no_terminal_stop).withColumn("_frames", F.count("*").over(name))
    given = references.select("gene", "reference") if references is not None else None
    judged = opened.join(given, "gene", "left") if given is not None else opened.withColumn("reference", F.lit(None).cast("string"))
    single = judged.where(F.col("reference").isNull() & (F.col("_frames") == 1))
    model = single.groupBy("gene").agg(F.max(F.struct(F.length("bases").alias("n"), F.col("protein"))).alias("_m")).select("gene", F.col("_m.protein").alias("_model"))
    asked = judged.join(model, "gene", "left").withColumn("reference", F.coalesce("reference", F.when(F.col("_frames") > 1, F.col("_model"))))
    nearest = distances(asked, scores).withColumn("_nth", F.row_number().over(name.orderBy(F.col("distance").asc_nulls_last(), "frame"))).where("_nth = 1")
    wrong = F.when(F.col("reference").isNull() & (F.col("_frames") > 1), "frame undetermined").when((F.col("distance") > maximum_distance) | (F.col("distance") >= 1), "too far from its reference")
    chosen = nearest.select("name", "gene", "frame", F.col("bases").alias("seq"), "distance", wrong.alias("_wrong"))
    # as relative_length, over those that aren't wrong; a window, so the distances are worked out once
    right = lambda c: F.when(F.col("_wrong").isNull(), c)
    gene = Window.partitionBy("gene")
    size = F.length("seq")
    long_enough = (F.count(right(F.lit(1))).over(gene) == 1) | (size > F.max(right(size)).over(gene) * share)
    chosen = chosen.withColumn("_long", right(F.when(long_enough, True)))
    out = targets.select("name", "gene").distinct().join(chosen, ["name", "gene"], "left")
    reason = F.coalesce(F.when(F.col("frame").isNull(), "no open frame"), F.col("_wrong"), F.when(F.col("_long").isNull(), "too short"))
    if low_complexity_names is not None:
        out = out.join(low_complexity_names.select("name").distinct().withColumn("low_complexity", F.lit(True)), "name", "left").withColumn("low_complexity", F.coalesce("low_complexity", F.lit(False)))
        if not keep_low_complexity:
            reason = F.coalesce(reason, F.when(F.col("low_complexity"), "low complexity"))
    return out.withColumn("reason", reason).drop("_long", "_wrong")
