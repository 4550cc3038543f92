"""Capture-shaped views over the shared tables, as DataFrames and as SQL: targets, hits, hsps, lengths, flags, pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from baitline.functions.ranges import let
from baitline.session import table

#: One SQL text for both engines, by view; later views may use earlier ones.
SQL = {
    "targets": """select p_partkey as seq_no, concat('tax-', cast(p_partkey % 5 as string), '-g', cast(p_partkey % 40 as string)) as name,
        concat('tax-', cast(p_partkey % 5 as string)) as taxon, concat('g', cast(p_partkey % 40 as string)) as gene,
        substr(translate(concat(md5(cast(p_partkey as string)), md5(p_name), md5(p_type)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, cast(60 + p_size % 30 as int)) as seq from part""",
    "hits": """select l_orderkey as read_id, cast(l_linenumber as bigint) as ln, concat('tax-', cast(l_suppkey % 5 as string)) as taxon, concat('g', cast(l_partkey % 40 as string)) as gene,
        concat('tax-', cast(l_suppkey % 5 as string), '-g', cast(l_partkey % 40 as string)) as target, l_quantity as score from lineitem""",
    "hsps": """select l_partkey as gene, concat(cast(l_orderkey as string), '_', cast(l_linenumber as string)) as contig, cast(l_linenumber as bigint) as ln,
        cast(cast(l_quantity as int) as bigint) as s, cast(cast(l_quantity as int) + 1 + l_orderkey % 40 as bigint) as e, cast(55 + (l_orderkey * 7) % 46 as bigint) as sim,
        l_extendedprice as depth, cast(case when l_returnflag = 'R' then -1 else 1 end as bigint) as strand from lineitem""",
    "lengths": """select c_nationkey as sample, cast(o_custkey % 40 as int) as gene, cast(count(*) * 37 as bigint) as len
        from orders join customer on o_custkey = c_custkey group by c_nationkey, cast(o_custkey % 40 as int)""",
    "means": """select cast(p_partkey % 40 as int) as gene, cast(floor(avg(p_size) * 10) as bigint) as mean_len from part group by cast(p_partkey % 40 as int)""",
    "seqs": """select c_nationkey as sample, cast(o_custkey % 40 as int) as gene, o_orderkey as contig, cast(o_orderkey % 3 as bigint) as kind
        from orders join customer on o_custkey = c_custkey""",
    "flags": """select cast(s_nationkey as int) as sample, s_suppkey as gene, case s_suppkey % 4 when 0 then 'single' when 1 then 'skipped' else 'stitched' end as stitched,
        s_suppkey % 5 = 0 as chimera, s_suppkey % 3 = 0 as paralog_long, s_acctbal < 0 as paralog_depth from supplier""",
    "pairs": """select l_partkey % 40 as gene, concat('c', cast(l_orderkey % 3 as string)) as contig1, concat('c', cast(l_suppkey % 3 as string)) as contig2,
        cast(l_linenumber - 1 as bigint) as nm1, cast(l_orderkey % 9 as bigint) as nm2, l_orderkey as read_id from lineitem""",
}
#: Identity flags (one a target position) and the gapped bases of a hit, from a digest of its contig.
IDENT = "list_transform(range(1, (e - s + 1)::bigint), lambda i: case when instr('0123', substr(repeat(md5(contig), 2), i::bigint, 1)) > 0 then 0 else 1 end)"
GAPPED = "substr(repeat(translate(md5(contig), '0123456789abcdef', 'ACGT-CGTACGTACGT'), 4), 1, cast((e - s) * 3 as int))"


def aligned(hsps: DataFrame) -> DataFrame:
    """hsps with ident, hit_seq and query_len as IDENT and GAPPED give them."""
    digest = F.repeat(F.md5(F.col("contig").cast("binary")), 2)
    flags = lambda text: F.transform(F.sequence(F.lit(1), (F.col("e") - F.col("s")).cast("int")), lambda i: F.when(F.instr(F.lit("0123"), F.substr(text, i, F.lit(1))) > 0, 0).otherwise(1))
    bases = F.expr(GAPPED.replace("md5(contig)", "md5(cast(contig as binary))"))
    return hsps.withColumns({"ident": let(digest, flags), "hit_seq": bases, "query_len": F.lit(40.0)})


#: Tables that the views read.
BASE = ("part", "lineitem", "orders", "customer", "supplier")


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named views as DataFrames."""
    return [spark.sql(SQL[n].replace(" from part", " from {part}").replace(" from lineitem", " from {lineitem}").replace("from orders join customer", "from {orders} join {customer}").replace(" from supplier", " from {supplier}"), **_used(spark, sf_dir, SQL[n])) for n in names]


def _used(spark: SparkSession, sf_dir: str, sql: str) -> dict[str, DataFrame]:
    return {t: table(spark, sf_dir, t) for t in BASE if f"from {t}" in sql or f"join {t}" in sql}


def oracle(body: str, *names: str) -> str:
    """body with the named views in front."""
    return "with " + ", ".join(f"{n} as ({SQL[n]})" for n in names) + " " + body
