"""Native substitutes for read mappers: k-mer seeds, an equi-join, and votes.

Results are those of the vote, not of the external mappers; their output can be read instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baitline.functions import sequences


def kmers(seq: Column, k: int) -> Column:
    last = F.length(seq) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.substr(seq, i + 1, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def _votes_by_class(of_read: DataFrame, of_target: DataFrame) -> DataFrame:
    """(read_id, target, votes): shared k-mers of (read_id, kmer) and (target, kmer), both distinct.

    K-mers that occur in the same targets form a class, told apart by two digests and a count. A read's k-mers are
    counted by class, and only these counts are multiplied with the classes' targets. The size of a table of k-mers is
    guessed from that of the compressed files, which is far too little, so no side is left to be broadcast.
    """
    name = F.col("target").cast("string")
    key = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64(name)).alias("x"), F.bit_xor(F.xxhash64(F.reverse(name), F.lit(7))).alias("y"))
    of_kmer = of_target.groupBy("kmer").agg(key.alias("class"))
    members = of_target.join(of_kmer.hint("merge"), "kmer").select("class", "target").distinct()
    counted = of_read.join(of_kmer.hint("merge"), "kmer").groupBy("read_id", "class").agg(F.count("*").alias("n"))
    return counted.join(members.hint("merge"), "class").groupBy("read_id", "target").agg(F.sum("n").alias("votes"))


def map_reads(reads: DataFrame, targets: DataFrame, k: int = 21, least: int = 3, most: int = 10, both_strands: bool = False, translated: bool = False, classes: bool = True) -> DataFrame:
    """(read_id, target, votes): targets that share at least ``least`` distinct k-mers with a read, the best ``most``.

    translated: reads are read in six frames against protein targets. Ties go to the smaller target name. classes: votes
    are counted by sets of targets first, so k-mers that many targets share don't multiply rows; without, pair by pair.
    """
    if translated:
        strands = F.array("seq", sequences.reverse_complement(F.col("seq")))
        turned = reads.select("read_id", F.explode(strands).alias("seq"))
        proteins = F.array(*(sequences.translate(sequences.frame(F.col("seq"), f)) for f in range(3)))
        reads = turned.select("read_id", F.explode(proteins).alias("seq"))
    elif both_strands:
        reads = reads.select("read_id", F.explode(F.array("seq", sequences.reverse_complement(F.col("seq")))).alias("seq"))
    seeds = lambda frame, name: frame.select(name, F.explode(kmers(F.col("seq"), k)).alias("kmer")).distinct()
    of_target = seeds(targets, "target")
    of_read = seeds(reads, "read_id")
    votes = _votes_by_class(of_read, of_target) if classes else of_read.join(of_target.hint("merge"), "kmer").groupBy("read_id", "target").agg(F.count("*").alias("votes"))
    votes = votes.where(F.col("votes") >= least)
    rank = F.row_number().over(Window.partitionBy("read_id").orderBy(F.desc("votes"), "target"))
    return votes.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank")
