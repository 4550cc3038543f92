"""Text formats that Spark's own readers take: FASTA, SAM, tabular hits, reports and lists. Schemas are declared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The twelve columns of tabular hits.
TABULAR = "read_id string, target string, pct double, length int, mismatches int, gaps int, q_start int, q_end int, t_start int, t_end int, evalue double, score double"
#: Fixed value: the keys of a control file.
CONTROL_KEYS = ("TARGETFILE", "TARGETFILE_TYPE", "CHANGE_LENGTH", "TRANSLATE_TARGET_FILE", "NO_TERMINAL_STOP_CODONS", "SLIDING_WINDOW_SIZE", "COMPLEXITY_MINIMUM_THRESHOLD", "ALLOW_GENE_REMOVAL", "LOW_COMPLEXITY_SEQUENCES")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq_name, description, seq) of FASTA files; the name is the header's first word."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^>", "").alias("v"))
    header = F.regexp_replace(F.substring_index("v", "\n", 1), "\r$", "")
    body = F.when(F.instr("v", "\n") > 0, F.regexp_replace(F.expr("substr(v, instr(v, '\n') + 1)"), r"\s+", "")).otherwise("")
    rows = raw.where(F.trim("v") != "")
    return rows.select("file", F.substring_index(header, " ", 1).alias("seq_name"), F.regexp_extract(header, r"^\S+\s+(.*)$", 1).alias("description"), body.alias("seq"))


def targets(spark: SparkSession, path: str) -> DataFrame:
    """A target file as (name, taxon, gene, seq)."""
    from baitline.functions.sequences import gene_of, taxon_of

    return fasta(spark, path).select(F.col("seq_name").alias("name"), taxon_of(F.col("seq_name")).alias("taxon"), gene_of(F.col("seq_name")).alias("gene"), "seq")


def contigs(spark: SparkSession, path: str) -> DataFrame:
    from baitline.functions.sequences import contig_depth

    return fasta(spark, path).select(F.col("seq_name").alias("contig"), "seq", F.length("seq").alias("length"), contig_depth(F.col("seq_name")).alias("depth"))


def sam(spark: SparkSession, path: str, mapped_only: bool = True) -> DataFrame:
    """(read_id, flag, target, pos, mapq, seq, nm, score) of SAM lines; score is the mapping quality."""
    cells = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != "")).select(F.split("value", "\t").alias("c"), "value")
    rows = cells.select(
        F.col("c")[0].alias("read_id"), F.col("c")[1].cast("int").alias("flag"), F.col("c")[2].alias("target"), F.col("c")[3].cast("int").alias("pos"), F.col("c")[4].cast("int").alias("mapq"), F.col("c")[9].alias("seq"),
        F.expr("try_cast(nullif(regexp_extract(value, '\\tNM:i:([0-9]+)', 1), '') as int)").alias("nm"), F.col("c")[4].cast("double").alias("score"),
    )
    return rows.where(F.col("flag").bitwiseAND(4) == 0) if mapped_only else rows


def tabular(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=TABULAR)


def blast_xml(spark: SparkSession, path: str) -> DataFrame:
    """(target, hsp fields) of BLAST XML; the midline keeps its blanks."""
    hsp = "struct<`Hsp_bit-score`:double,`Hsp_evalue`:double,`Hsp_query-from`:int,`Hsp_query-to`:int,`Hsp_hit-from`:int,`Hsp_hit-to`:int,`Hsp_identity`:int,`Hsp_align-len`:int,`Hsp_qseq`:string,`Hsp_hseq`:string,`Hsp_midline`:string>"
    hits = spark.read.schema(f"Hit_def string, Hit_len int, Hit_hsps struct<Hsp:array<{hsp}>>").format("xml").option("rowTag", "Hit").option("ignoreSurroundingSpaces", "false").load(path)
    rows = hits.select(F.trim("Hit_def").alias("contig"), F.col("Hit_len").alias("contig_len"), F.explode("Hit_hsps.Hsp").alias("h"))
    ident = F.transform(F.split(F.col("h.Hsp_midline"), ""), lambda c: F.when(c == "|", 1).otherwise(0))
    return rows.select(
        "contig", "contig_len", (F.least("h.`Hsp_query-from`", "h.`Hsp_query-to`") - 1).cast("long").alias("s"), F.greatest("h.`Hsp_query-from`", "h.`Hsp_query-to`").cast("long").alias("e"),
        (F.least("h.`Hsp_hit-from`", "h.`Hsp_hit-to`") - 1).cast("long").alias("h_s"), F.greatest("h.`Hsp_hit-from`", "h.`Hsp_hit-to`").cast("long").alias("h_e"),
        F.when(F.col("h.`Hsp_hit-from`") > F.col("h.`Hsp_hit-to`"), -1).otherwise(1).alias("strand"), F.col("h.Hsp_hseq").alias("hit_seq"), ident.alias("ident"),
    )


def primary_mapped(spark: SparkSession, path: str) -> DataFrame:
    """(file, mapped) from flagstat tables: first cell of the lines that end in 'primary mapped'."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.col("value").rlike(r"\bprimary mapped$"))
    return lines.groupBy("file").agg(F.sum(F.substring_index("value", "\t", 1).cast("long")).alias("mapped"))


def control(spark: SparkSession, path: str, keys: tuple[str, ...] = CONTROL_KEYS) -> DataFrame:
    """(key, values) of a control file; an unknown key is an error."""
    cells = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("c"))
    known = F.col("c")[0].isin(*keys)
    return cells.select(F.when(known, F.col("c")[0]).otherwise(F.raise_error(F.concat(F.lit("unknown key "), F.col("c")[0])).cast("string")).alias("key"), F.expr("slice(c, 2, size(c))").alias("values"))


def names(spark: SparkSession, path: str) -> DataFrame:
    """(sample) of a name list; slashes and repeated names are errors, blank lines are skipped."""
    lines = spark.read.text(path).select(F.trim("value").alias("sample")).where("sample <> ''").groupBy("sample").agg(F.count("*").alias("n"))
    wrong = F.col("sample").contains("/") | (F.col("n") > 1)
    return lines.select(F.when(wrong, F.raise_error(F.concat(F.lit("bad or repeated sample name "), F.col("sample"))).cast("string")).otherwise(F.col("sample")).alias("sample"))


def denied(spark: SparkSession, path: str) -> DataFrame:
    """(gene, sample) of a deny list; a gene without samples gives one row with a null sample, which denies nothing."""
    rows = spark.read.csv(path, sep="\t", schema="gene string, samples string")
    named = F.filter(F.split(F.coalesce("samples", F.lit("")), ","), lambda x: x != "")
    return rows.select("gene", F.explode_outer(named).alias("sample"))


def length_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lengths(sample, gene, len), means(gene, mean_len)) of a wide length table."""
    wide = spark.read.csv(path, sep="\t", header=True)
    first, *genes = wide.columns
    long = wide.unpivot([F.col(f"`{first}`").alias("sample")], [F.col(f"`{g}`") for g in genes], "gene", "len").withColumn("len", F.col("len").cast("double"))
    return long.where("sample <> 'MeanLength'").withColumn("len", F.col("len").cast("long")), long.where("sample = 'MeanLength'").select("gene", F.col("len").alias("mean_len"))


def preferred(spark: SparkSession, path: str) -> DataFrame:
    """(gene, taxon) of a preference file, separated by white space."""
    words = spark.read.text(path).where(F.trim("value") != "").select(F.split(F.trim("value"), r"\s+").alias("c"))
    return words.select(F.col("c")[0].alias("gene"), F.col("c")[1].alias("taxon"))


def stats(spark: SparkSession, path: str) -> DataFrame:
    """A report of samples with the types of its columns: names, counts and one percentage."""
    from baitline.operators.reports import STATS_COLUMNS

    kinds = {"Name": "string", "PctOnTarget": "double"}
    return spark.read.csv(path, sep="\t", header=True, enforceSchema=False, schema=", ".join(f"{c} {kinds.get(c, 'long')}" for c in STATS_COLUMNS))


def marked_block(text, marker: str):
    """The first block between two markers."""
    return F.get(F.split(text, marker), F.lit(1))


#: Fixed value: what stands around the feature lines in an aligner's output.
GFF_MARKERS = r"# --- END OF GFF DUMP ---|# --- START OF GFF DUMP ---\n#\n#\n"


def gff(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, source, feature, start, end, score, strand, phase, attributes) of the first feature block of each file."""
    block = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), marked_block(F.col("value"), GFF_MARKERS).alias("b"))
    cells = block.select("file", F.explode(F.split("b", "\n")).alias("line")).where("line <> '' and not startswith(line, '#')").select("file", F.split("line", "\t").alias("c"))
    names = ["seq", "source", "feature", "start", "end", "score", "strand", "phase", "attributes"]
    return cells.select("file", *((F.col("c")[i].cast("long") if n in ("start", "end") else F.get("c", F.lit(i))).alias(n) for i, n in enumerate(names)))


def score_matrix(spark: SparkSession, path: str) -> dict[tuple[str, str], float]:
    """A substitution matrix in the usual text form (a row of letters, then a letter and its scores a line; # comments)."""
    lines = [r.value.split() for r in spark.read.text(path, wholetext=False).collect() if r.value.strip() and not r.value.startswith("#")]
    return {(row[0], other): float(v) for row in lines[1:] for other, v in zip(lines[0], row[1:])}
