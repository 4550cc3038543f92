"""Exact dedup by skew-safe combining; DataFrame functions only.

Three combining stages, each comparing the digest *and* the full normalised text (both are grouping keys):

1. locally: Spark's map-side partial aggregate leaves one row per text and input partition;
2. salted: the partial rows of one digest are dealt over ``salts`` reducers, so a group that holds a third of all
   rows reaches no single task as more than one row per input partition of that salt;
3. globally: at most ``salts`` winners per text are combined.

The winners are then looked up by digest for every row. A join on a hot digest is split by Spark's skew join. Two
different texts with one SHA-256 (none is known) would be told apart by stages 1 to 3, and the query then stops with
an error instead of merging them.

Defined cases: null text counts as empty; equal texts keep the smallest id; null ids sort last (a group of null ids
only has keep_id null, and one of its rows stays); of rows equal in id and text exactly one stays; an empty table
gives an empty result; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.llm.common import SPACE, fresh, text_or_empty


def _normalised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.regexp_replace(text_or_empty(text_col), SPACE, " ")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("norm")).withColumn("sha", F.sha2("norm", 256))


def winners(rows: DataFrame, salts: int = 16) -> DataFrame:
    """(sha, norm, keep_id, group_size): one row per distinct text of rows(doc_id, norm, sha)."""
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("sha", "salt", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return salted.groupBy("sha", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _normalised(docs, id_col, text_col)
    classes = (
        winners(rows, salts)
        .groupBy("sha")
        .agg(F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .select(
            F.unhex("sha").alias("digest"),
            F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts have one SHA-256")).cast("long")).otherwise(F.col("keep_id")).alias("keep_id"),
            "group_size",
        )
    )
    nth = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy(F.lit(0)))  # before the join, which then has its own exchange
    found = rows.select("doc_id", F.unhex("sha").alias("digest")).withColumn("nth", nth).join(classes, "digest")
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of docs that stay, with docs' own columns. Rows equal in id and normalised text leave one row."""
    row, other = fresh(docs, "_row", "_kept")
    # one digest of id and text is the key of the join and of what is left of repeated rows: one exchange serves both
    of = lambda number, sha: F.sha2(F.concat(F.coalesce(number.cast("string"), F.lit("null")), F.lit(" "), sha), 256)
    kept = exact_groups(docs, id_col, text_col, salts).where("kept").select(of(F.col("doc_id"), F.col("text_sha256")).alias(other))
    text = F.regexp_replace(text_or_empty(text_col), SPACE, " ")
    keyed = docs.withColumn(row, of(F.col(id_col).cast("long"), F.sha2(text, 256)))
    return keyed.join(kept, F.col(row) == F.col(other), "left_semi").dropDuplicates([row]).drop(row)
