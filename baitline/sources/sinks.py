"""Writers: FASTA by gene, tab-separated tables, matrices. Order inside a file is by the given columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fasta(rows: DataFrame, path: str, by: tuple[str, ...] = (), name: str = "seq_id", order: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """rows(name, seq[, description]) as FASTA text, one folder for each value of ``by``."""
    head = F.concat(F.lit(">"), F.col(name))
    if "description" in rows.columns:
        head = F.when(F.coalesce("description", F.lit("")) != "", F.concat(head, F.lit(" "), F.col("description"))).otherwise(head)
    keys = [F.col(c) for c in by]
    if keys:
        rows = rows.repartition(*keys).sortWithinPartitions(*by, *(order or (name,)))
    elif order:
        rows = rows.sortWithinPartitions(*order)
    out = rows.select(*by, F.concat(head, F.lit("\n"), F.col("seq")).alias("value"))
    writer = out.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).text(path)


def samples_fasta(rows: DataFrame, path: str, by: tuple[str, ...] = ("gene",), gene_in_name: bool = False, mode: str = "errorifexists") -> None:
    """rows(sample, gene, seq) as FASTA; names are samples, or sample-gene where a file holds several genes."""
    name = F.concat_ws("-", "sample", "gene") if gene_in_name else F.col("sample").cast("string")
    fasta(rows.withColumn("seq_id", name), path, by, mode=mode)


def unaligned(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rows(name, gene, seq) as a folder of unaligned FASTA for each gene, ready for an aligner."""
    fasta(rows.withColumn("seq_id", F.col("name")), path, ("gene",), mode=mode)


def removed(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rows(name, reason, seq) as a folder of FASTA for each reason."""
    fasta(rows.withColumns({"seq_id": F.col("name"), "reason": F.replace("reason", F.lit(" "), F.lit("_"))}), path, ("reason",), mode=mode)


def fastq(rows: DataFrame, path: str, by: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """rows(id, seq, qual, ord) as FASTQ text."""
    out = rows.sortWithinPartitions(*by, "ord").select(*by, F.concat(F.lit("@"), F.col("id"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual")).alias("value"))
    writer = out.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).text(path)


def interleaved(pairs: DataFrame) -> DataFrame:
    """Pairs as rows (gene, ord, seq_id, seq), mates next to each other."""
    mates = F.explode(F.array(F.struct(F.lit(0).alias("n"), F.col("id1").alias("seq_id"), F.col("seq1").alias("seq")), F.struct(F.lit(1).alias("n"), F.col("id2").alias("seq_id"), F.col("seq2").alias("seq"))))
    return pairs.select("gene", "ord", mates.alias("m")).select("gene", (F.col("ord") * 2 + F.col("m.n")).alias("ord"), "m.seq_id", "m.seq")


def interleaved_fastq(pairs: DataFrame) -> DataFrame:
    """Pairs as rows (gene, ord, id, seq, qual), mates next to each other."""
    mates = F.explode(F.array(*(F.struct(F.lit(n - 1).alias("n"), F.col(f"id{n}").alias("id"), F.col(f"seq{n}").alias("seq"), F.col(f"qual{n}").alias("qual")) for n in (1, 2))))
    return pairs.select("gene", "ord", mates.alias("m")).select("gene", (F.col("ord") * 2 + F.col("m.n")).alias("ord"), "m.id", "m.seq", "m.qual")


def lines(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rows(rank, value) as one text file, in the order of rank; for reports, whose size is that of their lists of names."""
    rows.coalesce(1).sortWithinPartitions("rank").select("value").write.mode(mode).text(path)


def control(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rows(rank, key, values) as a control file."""
    lines(rows.select("rank", F.concat_ws("\t", "key", F.array_join("values", "\t")).alias("value")), path, mode)


def paralogs(rows: DataFrame, path: str, keys: tuple[str, ...] = ("sample", "gene"), mode: str = "errorifexists") -> None:
    """Named paralogs (keys, suffix, contig, seq) as FASTA, a folder for each key: names are sample.suffix, then the contig."""
    named = rows.withColumn("seq_id", F.concat_ws(".", "sample", "suffix")).withColumn("description", F.col("contig"))
    fasta(named, path, keys, order=("suffix",), mode=mode)


def paralog_warnings(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The contigs of long paralogs: gene and contig."""
    table(rows.select("gene", "contig"), path, header=False, order=("gene", "contig"), mode=mode)


def depth_warnings(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A line for each sample and gene of rows(sample, gene, paralog_depth)."""
    flag = F.initcap(F.col("paralog_depth").cast("string"))
    line = F.concat(F.lit("Sample "), F.col("sample").cast("string"), F.lit(", gene "), F.col("gene").cast("string"), F.lit(", paralog warning via contig depth across query protein, "), flag)
    rows.orderBy("sample", "gene").select(line.alias("value")).write.mode(mode).text(path)


def sam(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rows(read_id, flag, target, pos, mapq, seq, nm) as SAM lines."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("*"))
    cigar = F.concat(F.length("seq").cast("string"), F.lit("M"))
    tag = F.concat(F.lit("NM:i:"), F.col("nm").cast("string"))
    rows.select(F.concat_ws("\t", text("read_id"), text("flag"), text("target"), text("pos"), text("mapq"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), text("seq"), F.lit("*"), tag).alias("value")).write.mode(mode).text(path)


def table(rows: DataFrame, path: str, header: bool = True, order: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    (rows.orderBy(*order) if order else rows).write.mode(mode).csv(path, sep="\t", header=header, emptyValue="", nullValue="")


def matrix(values: DataFrame, path: str, value: str, genes: list | None = None, mode: str = "errorifexists") -> None:
    """Long values(sample, gene, value) as a wide table; ``genes`` fixes the columns and saves a pass."""
    from baitline.operators.reports import wide

    table(wide(values, value, genes).withColumnRenamed("sample", "Species").orderBy("Species"), path, mode=mode)


def partition_file(parts: DataFrame, path: str, kind: str = "DNA", mode: str = "errorifexists") -> None:
    """Lines 'kind, file = from-to' or with a stride, in alignment order."""
    stride = F.when(F.col("stride") > 1, F.concat(F.lit("\\"), F.col("stride").cast("string"))).otherwise("")
    name = F.when(F.col("part") == "all", F.col("file")).otherwise(F.concat_ws("_", "file", "part"))
    line = F.concat(F.lit(f"{kind}, "), name, F.lit(" = "), F.col("from_pos").cast("string"), F.lit("-"), F.col("to_pos").cast("string"), stride)
    parts.orderBy("file", "part").select(line.alias("value")).write.mode(mode).text(path)
