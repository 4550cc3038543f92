"""The named queries over the shared tables: each applies an operator, and has SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baitline.functions import ranges, sequences
from baitline.functions.sequences import CODONS
from baitline.operators import chimera, distribute, hits, introns, mapping, paralogs, reports, targets
from baitline.plans import pipelines
from baitline.plans.views import GAPPED, IDENT, aligned, oracle, views
from baitline.session import shared_dir
from baitline.sources import binary, sinks, text

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None, *names: str):
    """Registers a function of views under its own name, with its SQL over the same views, where SQL can express it."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(*views(spark, sf_dir, *names))
        if sql is not None:
            _SQL[f.__name__] = oracle(sql, *names)
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- reads, hits and targets ---

_BEST = """select gene, taxon, total from (select gene, taxon, sum(cast(score as bigint))::bigint as total,
    row_number() over (partition by gene order by sum(cast(score as bigint)) desc, taxon) as rn from hits{where} group by gene, taxon) where rn = 1"""


@query(_BEST.format(where=""), "hits")
def best_target(h):
    return distribute.best_targets(h)


@query(f"select taxon, count(*) as genes from ({_BEST.format(where='')}) group by taxon", "hits")
def target_tally(h):
    return distribute.tally(distribute.best_targets(h))


@query(_BEST.format(where=" where not contains(taxon, 'tax-1')"), "hits")
def exclude_taxon(h):
    return distribute.best_targets(distribute.without_taxon(h, "tax-1"))


@query("select read_id, array_to_string(list_sort(list(distinct gene)), ',') as genes from hits group by read_id", "hits")
def distinct_gene_hits(h):
    return distribute.genes_per_read(h)


@query("select read_id, sample, gene from (select distinct contig as read_id, sample from seqs) join (select distinct read_id, gene from hits) using (read_id)", "seqs", "hits")
def reads_to_genes(s, h):
    return distribute.reads_to_genes(s.select(F.col("contig").alias("read_id"), "sample").distinct(), h)


@query(
    """, g as (select distinct read_id, gene from hits), p as (select contig * 2 as id1, contig as id2 from seqs)
    select id1, id2, gene from p join g on id1 = read_id
    union all select id1, id2, gene from p join g on id2 = read_id where id1 not in (select read_id from g)""",
    "hits",
    "seqs",
)
def paired_fallback_join(h, s):
    return distribute.pairs_to_genes(s.select((F.col("contig") * 2).alias("id1"), F.col("contig").alias("id2")), h)


@query("select gene, count(*) as reads from (select distinct read_id, gene from hits) group by gene", "hits")
def gene_read_counts(h):
    return distribute.gene_counts(distribute.read_genes(h))


@query("select count(distinct read_id) as mapped from hits", "hits")
def mapped_read_count(h):
    return distribute.mapped_reads(h)


@query(
    "select taxon, total, mapped, round_even(100.0::double * mapped / total, 1) as pct_on_target from (select taxon, count(*) as total, count(*) filter (where score > 30) as mapped from hits group by taxon)",
    "hits",
)
def pct_on_target(h):
    return reports.enrichment(h.groupBy("taxon").agg(F.count("*").alias("total"), F.count_if(F.col("score") > 30).alias("mapped")))


@query("select distinct gene from targets where gene not in (select gene from hits)", "targets", "hits")
def genes_without_any_hit(t, h):
    return distribute.genes_without_hits(t, h)


@query(
    f"select b.gene, coalesce(w.taxon, b.taxon) as taxon from ({_BEST.format(where='')}) b left join (select gene, min(taxon) as taxon from targets where length(seq) > 88 group by gene) w on b.gene = w.gene",
    "hits",
    "targets",
)
def preferred_target(h, t):
    return distribute.preferred(distribute.best_targets(h), t.where("length(seq) > 88").groupBy("gene").agg(F.min("taxon").alias("taxon")))


@query("select name, regexp_extract(name, '([^-]*)$', 1) as gene, regexp_extract(name, '^(.*)-[^-]*$', 1) as taxon from targets", "targets")
def gene_taxon_split(t):
    return t.select("name", sequences.gene_of(F.col("name")).alias("gene"), sequences.taxon_of(F.col("name")).alias("taxon"))


@query("select regexp_replace(split_part(concat('r.', cast(read_id as string), '1/', cast(1 + ln % 2 as string), ' x y'), ' ', 1), '/[12]$', '') as id, count(*) as n from hits group by 1", "hits")
def read_id_normalise(h):
    raw = F.concat(F.lit("r."), F.col("read_id").cast("string"), F.lit("1/"), (1 + F.col("ln") % 2).cast("string"), F.lit(" x y"))
    return h.groupBy(sequences.read_id(raw).alias("id")).agg(F.count("*").alias("n"))


@query(
    """select read_id, target, votes from (select read_id, target, votes, row_number() over (partition by read_id order by votes desc, target) as rn from (
        select r.read_id, t.target, count(*) as votes from (select distinct seq_no as read_id, substr(seq, i + 1, 21) as kmer from targets, unnest(range(0, length(seq) - 20)) as u(i)) r
        join (select distinct name as target, substr(seq, i + 1, 21) as kmer from targets, unnest(range(0, length(seq) - 20)) as u(i)) t using (kmer) group by all) where votes >= 3) where rn <= 10""",
    "targets",
)
def kmer_mapping(t):
    return mapping.map_reads(t.select(F.col("seq_no").alias("read_id"), "seq"), t.select(F.col("name").alias("target"), "seq"), k=21, least=3, most=10)


# --- target sets ---

_BROKEN = "select case when seq_no % 7 = 0 then replace(name, '-', '_') when seq_no % 11 = 0 then concat(name, '''') else name end as name, seq_no from targets"


@query(f"select name, seq_no from ({_BROKEN}) where not (regexp_matches(name, '^.+-[^-]+$') and not contains(name, '''') and not contains(name, '\"'))", "targets")
def bad_headers(t):
    name = F.when(F.col("seq_no") % 7 == 0, F.replace("name", F.lit("-"), F.lit("_"))).when(F.col("seq_no") % 11 == 0, F.concat("name", F.lit("'"))).otherwise(F.col("name"))
    return targets.bad_headers(t.select(name.alias("name"), "seq_no"))


@query("select name, count(*) as n from targets group by name having count(*) > 1", "targets")
def duplicate_names(t):
    return targets.duplicate_names(t)


def _protein(seq: str) -> str:
    """DuckDB's translation of whole codons."""
    at = " + ".join(f"(instr('TCAGN', substr({seq}, (k * 3 + {i})::bigint, 1)) - 1) * {5 ** (3 - i)}" for i in (1, 2, 3))
    return f"array_to_string(list_transform(range(0, length({seq}) // 3), lambda k: substr('{CODONS}', ({at} + 1)::bigint, 1)), '')"


_PADDED = "concat(seq, repeat('N', (3 - length(seq) % 3) % 3))"
_STOPS = "cast(length(regexp_replace({p}, '[^*]', '', 'g')) as bigint)"


@query(f"select seq_no, {_protein('p')} as protein from (select seq_no, {_PADDED} as p from targets)", "targets")
def translate(t):
    return t.select("seq_no", sequences.translate(sequences.pad_codons(F.col("seq"))).alias("protein"))


@query(f"select seq_no, {_PADDED} as padded from targets", "targets")
def pad_codons(t):
    return t.select("seq_no", sequences.pad_codons(F.col("seq")).alias("padded"))


@query("select seq_no, translate(reverse(seq), 'ACGTN', 'TGCAN') as rc from targets", "targets")
def reverse_complement(t):
    return t.select("seq_no", sequences.reverse_complement(F.col("seq")).alias("rc"))


_FRAMES = f"""select seq_no, frame, protein, {_STOPS.format(p='protein')} - case when ends_with(protein, '*') then 1 else 0 end as inside from (
    select seq_no, frame, {_protein('p')} as protein from (select seq_no, f as frame, substr(seq, f + 1) as p from targets, unnest(range(0, 3)) as u(f)))"""


@query(f"select seq_no, frame, protein, inside, inside = 0 as open from ({_FRAMES})", "targets")
def frames_open(t):
    return targets.frames(t).select("seq_no", "frame", "protein", "inside", "open")


@query(f"select seq_no, {_STOPS.format(p='protein')} as stops, ends_with(protein, '*') as terminal from (select seq_no, {_protein('p')} as protein from (select seq_no, {_PADDED} as p from targets))", "targets")
def stop_codons(t):
    p = sequences.translate(sequences.pad_codons(F.col("seq")))
    return t.select("seq_no", sequences.stops(p).alias("stops"), p.endswith("*").alias("terminal"))


_ENTROPY = "(select -sum(n / {w}::double * log2(n / {w}::double)) from (select count(*) as n from unnest(string_split({s}, '')) as u(c) where c <> '' group by c))"


@query(
    "select seq_no, round(-sum(p * log2(p)), 6) as entropy from (select seq_no, c, count(*) / max(length(seq))::double as p from (select seq_no, seq, unnest(string_split(seq, '')) as c from targets) group by seq_no, c) group by seq_no",
    "targets",
)
def entropy(t):
    return t.select("seq_no", F.round(sequences.entropy(F.col("seq")), 6).alias("entropy"))


@query(
    """, w as (select seq_no, i, substr(seq, i + 1, 20) as s from targets, unnest(range(0, greatest(length(seq) - 20, 0) + 1)) as u(i)),
    e as (select seq_no, i, -sum(p * log2(p)) as h from (select seq_no, i, c, count(*) / max(length(s))::double as p from (select seq_no, i, s, unnest(string_split(s, '')) as c from w) group by seq_no, i, c) group by seq_no, i)
    select distinct seq_no from e where h <= 1.45""",
    "targets",
)
def low_complexity(t):
    return targets.low_complexity(t, 20, 1.45).select("seq_no")


@query("select name, seq_no from (select *, count(*) over (partition by gene) as n, max(length(seq)) over (partition by gene) as m from targets) where n = 1 or length(seq) > m * 0.9", "targets")
def relative_length(t):
    return targets.relative_length(t, 0.9).select("name", "seq_no")


@query(f", p as (select gene, seq, {_protein('p')} as protein from (select gene, seq, {_PADDED} as p from targets)) select distinct gene from targets where gene not in (select gene from p where length(seq) > 87 and {_STOPS.format(p='protein')} = 0)", "targets")
def lost_genes(t):
    """Genes without a sequence that is long and holds no stop."""
    return targets.lost_genes(t, t.where((F.length("seq") > 87) & (sequences.stops(sequences.translate(sequences.pad_codons(F.col("seq")))) == 0)))


@query(
    f""", b as (select x.name, seq from ({_BROKEN}) x join targets t on x.seq_no = t.seq_no), p as (select name, seq, {_protein('p')} as protein from (select name, seq, {_PADDED} as p from b)),
    h as (select seq_no, -sum(p * log2(p)) as h from (select seq_no, c, count(*) / max(length(seq))::double as p from (select seq_no, seq, unnest(string_split(seq, '')) as c from targets) group by seq_no, c) group by seq_no),
    x as (select 'header' as section, name from b where not (regexp_matches(name, '^.+-[^-]+$') and not contains(name, '''') and not contains(name, '"'))
    union all select 'duplicate', name from b group by name having count(*) > 1
    union all select 'low_complexity', x.name from ({_BROKEN}) x join h on x.seq_no = h.seq_no where h <= 1.9
    union all select 'not_codons', name from b where length(seq) % 3 <> 0
    union all select 'stops', name from p where {_STOPS.format(p='protein')} - case when ends_with(protein, '*') then 1 else 0 end > 0
    union all select 'terminal_stop', name from p where {_STOPS.format(p='protein')} = 1 and ends_with(protein, '*'))
    select section, name, count(*) as n from x group by all""",
    "targets",
)
def target_check(t):
    name = F.when(F.col("seq_no") % 7 == 0, F.replace("name", F.lit("-"), F.lit("_"))).when(F.col("seq_no") % 11 == 0, F.concat("name", F.lit("'"))).otherwise(F.col("name"))
    return targets.check(t.withColumn("name", name), threshold=1.9).groupBy("section", "name").agg(F.count("*").alias("n"))


@query(None, "targets")
def fix_targets(t):
    """Frames by distance need an aligner, which SQL hasn't; held against a plain version in the tests."""
    return targets.fix(t.withColumn("name", F.concat_ws("-", "name", F.col("seq_no").cast("string"))), 0.8).select("name", "gene", "frame", "seq", "reason")


# --- alignments ---

#: Identity flags and a gapped hit sequence for a contig, from a digest of its name.
_IDENT = "list_transform(range(1, 33), lambda i: case when instr('0123', substr(md5(contig), i::bigint, 1)) > 0 then 0 else 1 end)"
_GAPPED = "substr(repeat(translate(md5(contig), '0123456789abcdef', 'ACGT-CGTACGTACGT'), 4), 1, cast((e - s) * 3 as int))"


def _with_ident(h):
    flags = lambda digest: F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.when(F.instr(F.lit("0123"), F.substr(digest, i, F.lit(1))) > 0, 0).otherwise(1))
    return h.withColumn("ident", ranges.let(F.md5(F.col("contig").cast("binary")), flags))


def _with_gapped(h):
    return h.withColumn("hit_seq", F.expr(_GAPPED.replace("md5(contig)", "md5(cast(contig as binary))")))


@query("select gene, contig, sim from hsps where sim > 75", "hsps")
def identity_filter(h):
    return hits.above_identity(h, 75).select("gene", "contig", "sim")


_TRIM = "case when {ok}[1] then 0 when coalesce(list_position({ok}, true), 0) > 0 then list_position({ok}, true) - 1 + list_position(list_slice({i}, list_position({ok}, true), list_position({ok}, true) + 4), 1) - 1 end"
_OK = "list_transform(range(1, 29), lambda k: list_sum(list_slice({i}, k, k + 4)) * 100.0 / 5 > 75)"


@query(
    f"""select gene, contig, cast({_TRIM.format(ok='a', i='i')} as bigint) as five, cast({_TRIM.format(ok='b', i='r')} as bigint) as three
    from (select gene, contig, i, r, {_OK.format(i='i')} as a, {_OK.format(i='r')} as b from (select gene, contig, i, list_reverse(i) as r from (select gene, contig, {_IDENT} as i from hsps)))""",
    "hsps",
)
def terminal_trim(h):
    return _with_ident(h).withColumn("t", ranges.terminal_trim(F.col("ident"))).select("gene", "contig", F.col("t.five").alias("five"), F.col("t.three").alias("three"))


@query("select gene, contig from hsps where not ((s % 23 < 15 and (s % 23) % 3 <> 0) or (e % 31 < 15 and (e % 31) % 3 <> 0))", "hsps")
def frameshift_filter(h):
    return hits.without_frameshifts(h.withColumn("intron_spans", F.array(F.col("s") % 23, F.col("e") % 31))).select("gene", "contig")


@query(
    f"select gene, contig from (select gene, contig, {_protein('p')} as protein from (select gene, contig, concat(q, repeat('N', (3 - length(q) % 3) % 3)) as p from (select gene, contig, replace({_GAPPED}, '-', '') as q from hsps))) where {_STOPS.format(p='protein')} - case when ends_with(protein, '*') then 1 else 0 end = 0",
    "hsps",
)
def internal_stop_filter(h):
    return hits.without_internal_stops(_with_gapped(h)).select("gene", "contig")


_ONCE = "select * from (select *, row_number() over (partition by gene, s, e order by sim desc, depth desc, contig) as n1 from hsps) where n1 = 1"
_TILED = f"select * from (select *, max(e) over (partition by gene order by s, e desc rows between unbounded preceding and 1 preceding) as reach from ({_ONCE})) where coalesce(reach < e, true)"


@query(f"select gene, contig, s, e from ({_TILED})", "hsps")
def containment(h):
    return hits.uncontained(h).select("gene", "contig", "s", "e")


_PIECES = f"""select gene, contig, rk, case when nx is null then replace(h, '-', '') when nx < e then replace(substr(h, 1, greatest(length(h) + (nx - e) * 3, 0)::bigint), '-', '')
    else concat(replace(h, '-', ''), repeat('N', ((nx - e) * 3)::bigint)) end as piece
    from (select *, {_GAPPED} as h, lead(s) over (partition by gene order by s, e, contig) as nx, row_number() over (partition by gene order by s, e, contig) as rk from ({_TILED}))"""


@query(f"select gene, contig, piece from ({_PIECES})", "hsps")
def overlap_trim(h):
    return hits.overlap_trimmed(_with_gapped(hits.uncontained(h))).select("gene", "contig", "piece")


@query(f"select gene, count(*) as hits, string_agg(piece, '' order by rk) as seq from ({_PIECES}) group by gene", "hsps")
def stitch(h):
    return hits.stitched(hits.overlap_trimmed(_with_gapped(hits.uncontained(h))))


@query(f"select gene, contig, h as seq from (select gene, contig, {_GAPPED} as h, row_number() over (partition by gene order by length({_GAPPED}) desc, contig) as rn from hsps) where rn = 1", "hsps")
def longest_hit(h):
    return hits.longest(_with_gapped(h))


@query(
    f"select gene, 'identity' as stage, count(*) as hits from hsps where sim > 75 group by gene union all select gene, 'tiled', count(*) from ({_TILED}) group by gene",
    "hsps",
)
def hit_stage_report(h):
    return hits.stage_report({"identity": hits.above_identity(h, 75), "tiled": hits.uncontained(h)})


# --- paralogs ---


@query(
    """select gene, coalesce(sum(case when depth > 1 then width end), 0)::bigint as deep from (
    select gene, sum(d) over (partition by gene order by p rows unbounded preceding) as depth, lead(p) over (partition by gene order by p) - p as width from (
    select gene, p, sum(d) as d from (select gene, s as p, 1 as d from hsps union all select gene, e, -1 from hsps) group by gene, p)) group by gene""",
    "hsps",
)
def coverage_depth(h):
    return paralogs.covered_twice(h)


@query("select gene, contig from hsps where (e - s) / 40.0::double > 0.75", "hsps")
def long_hits(h):
    frags = F.array(F.struct(F.col("s"), (F.col("s") + 1).alias("e")), F.struct((F.col("s") + 1).alias("s"), F.col("e")))
    return paralogs.long_hits(h.withColumn("q_frags", frags).withColumn("query_len", F.lit(40.0))).select("gene", "contig")


_MAIN = """select *, case when max(case when bd = 1 and coalesce(second, 0) * 1.5 <= depth then 1 else 0 end) over (partition by gene) = 1 then bd = 1 else bs = 1 end as main from (
    select *, row_number() over (partition by gene order by depth desc, contig) as bd, row_number() over (partition by gene order by sim desc, depth desc, contig) as bs,
    lead(depth) over (partition by gene order by depth desc, contig) as second from hsps)"""


@query(f"select gene, contig from ({_MAIN}) where main", "hsps")
def paralog_main(h):
    return paralogs.with_main(h, multiplier=1.5).where("main").select("gene", "contig")


@query(f"select gene, contig, case when main then 'main' else cast(row_number() over (partition by gene, main order by s, e, contig) - 1 as string) end as suffix from ({_MAIN})", "hsps")
def paralog_names(h):
    return paralogs.named(paralogs.with_main(h, multiplier=1.5)).select("gene", "contig", "suffix")


# --- coordinates, chimeras, introns ---

_RANKED = "select gene, contig, e - s as len, row_number() over (partition by gene order by s, e, contig) as rank from hsps"
_PLACED = f"select *, coalesce(sum(len) over (partition by gene order by rank rows between unbounded preceding and 1 preceding), 0)::bigint as lo from ({_RANKED})"


def _ranked(h):
    return h.select("gene", "contig", (F.col("e") - F.col("s")).alias("len"), F.row_number().over(Window.partitionBy("gene").orderBy("s", "e", "contig")).alias("rank"))


@query(f"select gene, contig, lo, lo + len as hi from ({_PLACED})", "hsps")
def offsets(h):
    return chimera.offsets(_ranked(h)).select("gene", "contig", "lo", "hi")


@query(f"select p.gene, contig, read_id, start, p.end from (select gene, contig as read_id, s * 7 as start, s * 7 + 10 as end from hsps) p join (select gene, contig, lo, lo + len as hi from ({_PLACED})) l on p.gene = l.gene and start >= lo and p.end <= hi", "hsps")
def range_join(h):
    points = h.select("gene", F.col("contig").alias("read_id"), (F.col("s") * 7).alias("start"), (F.col("s") * 7 + 10).alias("end"))
    return chimera.in_ranges(points, chimera.offsets(_ranked(h))).select("gene", "contig", "read_id", "start", "end")


@query("select gene, contig, cast(e2 - s2 as bigint) as second, cast(e3 - s3 as bigint) as third from (select gene, contig, 5 as s2, 5 + e - s as e2, 5 + e - s as s3, 5 + e - s + s as e3 from hsps)", "hsps")
def exon_coords(h):
    frags = F.array(F.struct(F.lit(0).cast("long").alias("s"), F.lit(5).cast("long").alias("e")), F.struct((F.col("s") + 10).alias("s"), (F.col("e") + 10).alias("e")), F.struct((F.col("e") + 50).alias("s"), (F.col("e") + 50 + F.col("s")).alias("e")))
    x = h.withColumn("x", ranges.exons(frags))
    return x.select("gene", "contig", (F.col("x")[1]["e"] - F.col("x")[1]["s"]).alias("second"), (F.col("x")[2]["e"] - F.col("x")[1]["e"]).alias("third"))


@query("select gene, contig, 200 - e as s, 200 - s as e from hsps", "hsps")
def revcomp_coords(h):
    x = h.withColumn("x", ranges.reversed_ranges(F.array(F.struct("s", "e")), F.lit(200).cast("long")))
    return x.select("gene", "contig", F.col("x")[0]["s"].alias("s"), F.col("x")[0]["e"].alias("e"))


@query("select gene, count(*) as pairs from pairs where ((nm1 = 0 and nm2 >= 5) or (nm2 = 0 and nm1 >= 5)) and contig1 <> contig2 group by gene having count(*) > 5", "pairs")
def discordant_pairs(p):
    return chimera.chimeric_genes(p)


@query(
    """select gene, contig, count(*) as hits, count(distinct strand) = 1 as one_strand, sum(brk) = 1 as consecutive from (
    select *, case when lag(contig) over (partition by gene order by s, e, contig, ln) is not distinct from contig then 0 else 1 end as brk from (select gene, concat('c', cast(ln % 4 as string)) as contig, ln, s, e, strand from hsps))
    group by gene, contig having count(*) >= 2""",
    "hsps",
)
def consecutive_contigs(h):
    return introns.repeated_contigs(h.withColumn("contig", F.concat(F.lit("c"), (F.col("ln") % 4).cast("string"))))


@query("select gene, string_agg(seq, 'NNNNNNNNNN' order by seq_no) as supercontig from targets group by gene", "targets")
def supercontig_join(t):
    return introns.supercontig(t.withColumn("rank", F.col("seq_no")))


@query("select seq_no, substr(seq, 11, 10) as first, substr(seq, 31, 15) as second from targets", "targets")
def intron_slices(t):
    frag = lambda a, b: F.struct(F.lit(a).alias("s"), F.lit(b).alias("e"))
    x = introns.intron_texts(t.withColumn("h_frags", F.array(frag(0, 10), frag(20, 30), frag(45, 60))))
    return x.select("seq_no", F.col("introns")[0].alias("first"), F.col("introns")[1].alias("second"))


# --- reports ---


@query("select gene, cast(round_even(avg(length(seq)), 0) as bigint) as mean_len from targets group by gene", "targets")
def mean_length(t):
    return reports.mean_lengths(t)


@query("select seq_no, cast(length(replace(replace(seq, 'GG', 'NN'), 'N', '')) as bigint) as bases from targets", "targets")
def bases_recovered(t):
    return t.select("seq_no", reports.length_without_n(F.replace("seq", F.lit("GG"), F.lit("NN"))).alias("bases"))


@query(
    "select sample, count(*) filter (where len > mean_len * 0.25) as above_25, count(*) filter (where len > mean_len * 0.5) as above_50, count(*) filter (where len > mean_len * 0.75) as above_75, count(*) filter (where len > mean_len * 1.5) as above_150 from lengths join means using (gene) group by sample",
    "lengths",
    "means",
)
def length_thresholds(n, m):
    return reports.thresholds(n, m)


@query(
    "select s.sample" + "".join(f", max(len) filter (where gene = {g}) as g{g}" for g in range(40)) + " from lengths s group by s.sample",
    "lengths",
)
def seq_length_matrix(n):
    out = reports.wide(n, "len", list(range(40)))
    return out.select("sample", *(F.col(str(g)).alias(f"g{g}") for g in range(40)))


@query("select sample, gene, least(len / mean_len::double, 1.0) as recovered from lengths join means using (gene)", "lengths", "means")
def recovery_ratio(n, m):
    return reports.recovery(n, m)


@query("select sample, genes, bases from (select sample, count(*) as genes, sum(len)::bigint as bases from lengths group by sample) where genes > 30 and bases < 30000", "lengths")
def sample_filter(n):
    stats = n.groupBy("sample").agg(F.count("*").alias("genes"), F.sum("len").alias("bases"))
    return reports.passing(stats, [("genes", "greater", 0.75), ("bases", "smaller", 30000)], genes=40)


@query("select sample, gene, len from lengths where not exists (select 1 from flags c where c.chimera and c.sample = lengths.sample and c.gene = lengths.gene)", "lengths", "flags")
def skip_chimeric(n, f):
    return reports.without_chimeras(n, f.where("chimera").select("sample", "gene").distinct())


_PARALOGS = "select sample, gene, contig from seqs where kind = 0"
_FALLBACK = f"{_PARALOGS} union all select sample, gene, min(contig) as contig from seqs s where not exists (select 1 from seqs p where p.kind = 0 and p.sample = s.sample and p.gene = s.gene) group by sample, gene"


def _fallback(s):
    return reports.paralogs_or_gene(s.where("kind = 0").select("sample", "gene", "contig"), s.groupBy("sample", "gene").agg(F.min("contig").alias("contig")))


@query(_FALLBACK, "seqs")
def paralog_fallback(s):
    return _fallback(s)


@query(f"select sample, gene, coalesce(copies, 0) as copies from (select distinct sample from seqs) cross join (select distinct gene from seqs) left join (select sample, gene, count(*) as copies from ({_FALLBACK}) group by all) using (sample, gene)", "seqs")
def paralog_matrix(s):
    return reports.grid(s, s, reports.paralog_counts(_fallback(s)), "copies")


@query(f"select gene, count(*) as samples from (select sample, gene, count(*) as copies from ({_FALLBACK}) group by all) where copies > 1 group by gene having count(*) / 25.0::double >= 0.6", "seqs")
def genes_over_threshold(s):
    return reports.genes_over(reports.paralog_counts(_fallback(s)), 25, 0.6)


@query(f"select sample, count(*) as genes from (select sample, gene, count(*) as copies from ({_FALLBACK}) group by all) where copies > 1 group by sample having count(*) / 40.0::double >= 0.5", "seqs")
def samples_over_threshold(s):
    return reports.samples_over(reports.paralog_counts(_fallback(s)), 40, 0.5)


_DENIED = "select sample, gene from lengths join means using (gene) where len > 0 and (len < 300 or len < mean_len * 2.0)"


@query(f"select gene, array_to_string(list_sort(list(cast(sample as string))), ',') as samples from ({_DENIED}) group by gene", "lengths", "means")
def deny_list(n, m):
    return reports.deny_list(reports.denied(n, m, 300, 2.0).withColumn("sample", F.col("sample").cast("string")))


@query(f"select sample, gene, len from lengths where (sample, gene) not in ({_DENIED})", "lengths", "means")
def deny_filter(n, m):
    return reports.without_denied(n, reports.denied(n, m, 300, 2.0))


@query("select sample from (select unnest(range(0, 40)) as sample) where sample not in (select sample from lengths)", "lengths")
def missing_samples(n):
    return reports.missing_samples(n.sparkSession.range(0, 40).withColumnRenamed("id", "sample"), n.select("sample").distinct())


@query("select sample, gene, coalesce(len, 0) as len from (select distinct sample from lengths) cross join (select distinct gene from means) left join lengths using (sample, gene)", "lengths", "means")
def grid_fill(n, m):
    return reports.grid(n, m, n, "len")


_FILES = "select gene as file, concat('s', cast(seq_no % 60 as string)) as name, rpad(min(seq), 90, '-') as seq from targets group by all"


def _files(t):
    return t.groupBy(F.col("gene").alias("file"), F.concat(F.lit("s"), (F.col("seq_no") % 60).cast("string")).alias("name")).agg(F.rpad(F.min("seq"), 90, "-").alias("seq"))


@query(
    f", f as ({_FILES}) select name, string_agg(coalesce(seq, repeat('-', size)), '' order by file) as seq from (select distinct name from f) cross join (select file, max(length(seq)) as size from f group by file) left join f using (file, name) group by name",
    "targets",
)
def concat_alignments(t):
    return reports.concatenated(_files(t))


@query(
    f", z as (select file, size, sum(size) over (order by file) as stop from (select file, max(length(seq)) as size from ({_FILES}) group by file)) select file, part, (stop - size + 1 + shift)::bigint as from_pos, stop::bigint as to_pos, 3::bigint as stride from z, (values ('codon1', 0), ('codon2', 1), ('codon3', 2)) v(part, shift)",
    "targets",
)
def partition_bounds(t):
    return reports.partitions(_files(t), codons=True)


@query(
    """select sample, count(*) filter (where stitched = 'single') as without_stitched, count(*) filter (where stitched = 'stitched') as with_stitched, count(*) filter (where stitched = 'skipped') as skipped,
    count(*) filter (where chimera) as chimeras, count(*) filter (where paralog_long) as paralogs_long, count(*) filter (where paralog_depth) as paralogs_depth from flags group by sample""",
    "flags",
)
def status_counts(f):
    return reports.status_counts(f)


# --- commands ---

_OK5 = "list_transform(range(1, greatest(len({i}) - 3, 1)::bigint), lambda k: list_sum(list_slice({i}, k, k + 4)) * 100.0 / 5 > 75)"
_TRIM5 = "case when len({i}) < 5 then 0 when {ok}[1] then 0 when coalesce(list_position({ok}, true), 0) > 0 then list_position({ok}, true) - 1 + list_position(list_slice({i}, list_position({ok}, true), list_position({ok}, true) + 4), 1) - 1 end"
#: Hits above 55 percent identity with their ends trimmed.
_KEPT = f""", i0 as (select *, {IDENT} as i, {GAPPED} as h from hsps where sim > 55), i1 as (select *, list_reverse(i) as r from i0), i2 as (select *, {_OK5.format(i='i')} as a, {_OK5.format(i='r')} as b from i1),
    i3 as (select *, cast({_TRIM5.format(ok='a', i='i')} as bigint) as five, cast({_TRIM5.format(ok='b', i='r')} as bigint) as three from i2),
    kept as (select gene, contig, strand, depth, s as s0, e as e0, s + five as s, e - three as e, round_even(100.0::double * list_sum(list_slice(i, five + 1, len(i) - three)) / (len(i) - five - three), 2) as sim,
        substr(h, five * 3 + 1, (len(i) - five - three) * 3) as h from i3 where five is not null and three is not null and len(i) - five - three > 0)"""
_KEPT_TILED = """, once as (select * from (select *, row_number() over (partition by gene, s, e order by sim desc, depth desc, contig) as n1 from kept) where n1 = 1),
    tiled as (select * from (select *, max(e) over (partition by gene order by s, e desc rows between unbounded preceding and 1 preceding) as reach from once) where coalesce(reach < e, true)),
    pieces as (select *, case when nx is null then replace(h, '-', '') when nx < e then replace(substr(h, 1, greatest(length(h) + (nx - e) * 3, 0)::bigint), '-', '') else concat(replace(h, '-', ''), repeat('N', ((nx - e) * 3)::bigint)) end as piece
        from (select *, lead(s) over (partition by gene order by s, e, contig) as nx, row_number() over (partition by gene order by s, e, contig) as rk from tiled))"""


@query(f"{_KEPT}{_KEPT_TILED}, g as (select gene, count(*) as hits, string_agg(piece, '' order by rk) as seq from pieces group by gene), p as (select *, {_PADDED} as p from g) select gene, hits, seq, {_protein('p')} as protein from p", "hsps")
def extract_contigs(h):
    return pipelines.extract_contigs(aligned(h))["genes"].select("gene", "hits", "seq", "protein")


@query(
    f"""{_KEPT}{_KEPT_TILED}, c as (select * from pieces where not exists (select 1 from (select gene, contig, count(*) as n, count(distinct strand) as k from pieces group by gene, contig) x where x.gene = pieces.gene and n > 1 and k > 1))
    select gene, contig, s0, e0, s, e, sim, case when nx < e then length(replace(h, '-', '')) - length(piece) end as cut_bases from pieces""",
    "hsps",
)
def trimmed_hits(h):
    out = pipelines.extract_contigs(aligned(h))["pieces"]
    return out.select("gene", "contig", F.col("s_untrimmed").alias("s0"), F.col("e_untrimmed").alias("e0"), "s", "e", "sim", "cut_bases")


@query(
    f"""{_KEPT}, l as (select *, count(*) over (partition by gene) as n from kept where (e0 - s0) / 40.0::double > 0.3), m as (select *, row_number() over (partition by gene order by depth desc, contig) as bd, row_number() over (partition by gene order by sim desc, depth desc, contig) as bs,
        lead(depth) over (partition by gene order by depth desc, contig) as second from l where n > 1),
    x as (select *, case when max(case when bd = 1 and coalesce(second, 0) * 10 <= depth then 1 else 0 end) over (partition by gene) = 1 then bd = 1 else bs = 1 end as main from m)
    select gene, contig, case when main then 'main' else cast(row_number() over (partition by gene, main order by s, e, contig) - 1 as string) end as suffix, replace(h, '-', '') as seq from x""",
    "hsps",
)
def paralog_sequences(h):
    return pipelines.extract_contigs(aligned(h), options=pipelines.Options(paralog_min_length_percentage=0.3))["paralogs"].select("gene", "contig", "suffix", "seq")


_PIECE_LOTS = """, k as (select gene, contig, ln, e - s as len, row_number() over (partition by gene order by s, e, contig) as rank from hsps),
    lots as (select *, coalesce(sum(len) over (partition by gene order by rank rows between unbounded preceding and 1 preceding), 0)::bigint as lo from k),
    m as (select gene, contig as pair, s % 13 as start1, s % 13 + 4 as end1, ln % 3 as nm1, e % 57 as start2, e % 57 + 5 as end2, s % 9 as nm2 from hsps),
    d as (select * from m where (nm1 = 0 and nm2 >= 5) or (nm2 = 0 and nm1 >= 5))"""


@query(
    f"""{_PIECE_LOTS} select gene, count(*) as pairs from (select d.gene, pair from d join lots a on a.gene = d.gene and start1 >= a.lo and end1 <= a.lo + a.len join lots b on b.gene = d.gene and start2 >= b.lo and end2 <= b.lo + b.len
    where a.contig <> b.contig and (a.ln % 2 = 0 or a.len <= 8 or end1 <= a.lo + 8 or start1 >= a.lo + 8) and (b.ln % 2 = 0 or b.len <= 8 or end2 <= b.lo + 8 or start2 >= b.lo + 8)) group by gene having count(*) > 0""",
    "hsps",
)
def chimera_check(h):
    n = F.col("e") - F.col("s")
    frag = lambda a, b: F.struct(a.cast("long").alias("s"), b.cast("long").alias("e"))
    two = (F.col("ln") % 2 == 1) & (n > 8)  # hits with an intron after their first eight bases
    frags = F.when(two, F.array(frag(F.lit(0), F.lit(8)), frag(F.lit(20), n + 12))).otherwise(F.array(frag(F.lit(0), n)))
    order = Window.partitionBy("gene").orderBy("s", "e", "contig")
    pieces = h.select("gene", "contig", F.row_number().over(order).alias("rank"), F.repeat(F.lit("A"), n.cast("int")).alias("piece"), frags.alias("h_frags"))
    mates = h.select("gene", F.col("contig").alias("pair"), (F.col("s") % 13).alias("start1"), (F.col("s") % 13 + 4).alias("end1"), (F.col("ln") % 3).alias("nm1"), (F.col("e") % 57).alias("start2"), (F.col("e") % 57 + 5).alias("end2"), (F.col("s") % 9).alias("nm2"))
    return pipelines.chimeras(pieces, mates, pipelines.Options(chimera_pair_cutoff=0))["genes"]


@query(
    """, r as (select gene, concat('c', cast(ln % 4 as string)) as contig, strand, row_number() over (partition by gene order by s, e, contig, ln) as rank from hsps),
    x as (select gene, contig, count(*) as n, count(distinct strand) as k, bool_or(adjacent) as adjacent from (select *, coalesce(lead(contig) over (partition by gene order by rank) = contig, false) as adjacent from r) group by gene, contig)
    select gene from x group by gene having bool_and(n < 2 or (k = 1 and adjacent))""",
    "hsps",
)
def coherent_genes(h):
    order = Window.partitionBy("gene").orderBy("s", "e", "contig", "ln")
    ranked = h.select("gene", F.concat(F.lit("c"), (F.col("ln") % 4).cast("string")).alias("contig"), "strand", F.row_number().over(order).alias("rank"))
    return introns.coherent(ranked)


@query(
    "select gene, contig, case when e - s < 10 then 20 + (e - s) when e - s < 22 then 50 + (e - s) - 10 end as stop from hsps",
    "hsps",
)
def supercontig_slices(h):
    """A hit of e - s bases over fragments of 10 and 12 bases that begin at 20 and 50."""
    frag = lambda a, b: F.struct(F.lit(a).cast("long").alias("s"), F.lit(b).cast("long").alias("e"))
    return h.select("gene", "contig", introns.slice_end(F.array(frag(20, 30), frag(50, 62)), F.col("e") - F.col("s")).alias("stop"))


@query("select gene, count(*) as reads from (select contig as read_id, sample from seqs) join (select distinct read_id, gene from hits) using (read_id) group by gene", "seqs", "hits")
def distribute_reads(s, h):
    return pipelines.distribute_reads(s.select(F.col("contig").alias("read_id"), "sample"), h)["counts"]


@query("select count(*) * 2 + (select count(*) from seqs where kind = 0) as reads from seqs", "seqs", "hits")
def total_reads(s, h):
    pairs = s.select((F.col("contig") * 2).alias("id1"), F.col("contig").alias("id2"))
    return pipelines.distribute_reads(pairs, h, paired=True, unpaired=s.where("kind = 0").select(F.col("contig").alias("read_id")))["total"]


@query(f"select name, t.gene, t.taxon, seq from targets t join ({_BEST.format(where='')}) b on t.gene = b.gene and t.taxon = b.taxon", "targets", "hits")
def select_targets(t, h):
    return pipelines.select_targets(t, h)["targets"].select("name", "gene", "taxon", "seq")


_STATUS = """count(*) filter (where stitched = 'single') as a, count(*) filter (where stitched = 'stitched') as b, count(*) filter (where stitched = 'skipped') as c, count(*) filter (where chimera) as d, count(*) filter (where paralog_long) as e, count(*) filter (where paralog_depth) as f"""


@query(
    f""", x as (select sample, count(*) as total, count(*) filter (where kind > 0) as mapped, count(distinct case when kind > 0 then gene end) as genes, count(distinct case when kind > 1 then gene end) as contigs from seqs group by sample),
    y as (select sample, count(*) as n, sum(len)::bigint as bases from lengths where len > 0 group by sample),
    z as (select sample, count(*) filter (where len > mean_len * 0.25) as a25, count(*) filter (where len > mean_len * 0.5) as a50, count(*) filter (where len > mean_len * 0.75) as a75, count(*) filter (where len > mean_len * 1.5) as a150 from lengths join means using (gene) group by sample),
    w as (select sample, {_STATUS} from flags group by sample)
    select sample as "Name", total as "NumReads", mapped as "ReadsMapped", round_even(100.0::double * mapped / total, 1) as "PctOnTarget", genes as "GenesMapped", contigs as "GenesWithContigs", coalesce(n, 0) as "GenesWithSeqs", coalesce(a25, 0) as "GenesAt25pct", coalesce(a50, 0) as "GenesAt50pct",
        coalesce(a75, 0) as "GenesAt75pct", coalesce(a150, 0) as "GenesAt150pct", coalesce(e, 0) as "ParalogWarningsLong", coalesce(f, 0) as "ParalogWarningsDepth", coalesce(a, 0) as "GenesWithoutStitchedContigs", coalesce(b, 0) as "GenesWithStitchedContigs", coalesce(c, 0) as "GenesWithStitchedContigsSkipped",
        coalesce(d, 0) as "GenesWithChimeraWarning", coalesce(bases, 0) as "TotalBasesRecovered" from x left join y using (sample) left join z using (sample) left join w using (sample)""",
    "seqs",
    "lengths",
    "means",
    "flags",
)
def stats_report(s, n, m, f):
    reads = s.groupBy("sample").agg(F.count("*").alias("total"), F.count_if(F.col("kind") > 0).alias("mapped"))
    return reports.stats(reads, reads, n, m, f, s.where("kind > 0"), s.where("kind > 1"))


@query(f"select sample, gene, contig from ({_FALLBACK}) x where exists (select 1 from lengths l where l.sample = x.sample and l.len > 300) and not exists (select 1 from flags c where c.chimera and c.sample = x.sample and c.gene = x.gene)", "seqs", "lengths", "flags")
def retrieve_sequences(s, n, f):
    genes = _fallback(s).withColumn("kind", F.lit("dna"))
    passing = n.where("len > 300").select("sample").distinct()
    return pipelines.retrieve_sequences(genes, "dna", passing=passing, chimeras=f.where("chimera")).select("sample", "gene", "contig")


_COPIES = f"select sample, gene, count(*) as copies from ({_FALLBACK}) group by all"


@query(
    f""", c as ({_COPIES}), n as (select count(distinct sample) as samples, count(distinct gene) as genes from seqs), g as (select cast(gene as string) as name from c, n where copies > 1 group by gene, n.samples having count(*) / n.samples::double >= 0.4),
    p as (select cast(sample as string) as name from c, n where copies > 1 group by sample, n.genes having count(*) / n.genes::double >= 0.4)
    select value, count(*) as n from (select concat('There are ', count(*)::string, ' samples with paralogs in >= 0.4% of genes. The sample names are:') as value from p union all select name from p union all select ''
    union all select concat('There are ', count(*)::string, ' genes with paralogs in >= 0.4% of samples. The gene names are:') from g union all select name from g) group by value""",
    "seqs",
)
def paralog_report(s):
    found = s.where("kind = 0").select("sample", "gene", "contig")
    genes = s.groupBy("sample", "gene").agg(F.min("contig").alias("contig"))
    return pipelines.paralog_retriever(s, found, genes, share=0.4)["report"].groupBy("value").agg(F.count("*").alias("n"))


# --- files: written to the shared folder and read again ---


def _place(frame: DataFrame, name: str) -> str:
    return f"{shared_dir(frame.sparkSession).rstrip('/')}/{name}-{uuid4().hex}"


@query("select name, taxon, gene, seq from targets", "targets")
def fasta_files(t):
    path = _place(t, "fasta")
    sinks.fasta(t.select(F.col("name").alias("seq_id"), "seq", F.col("gene").alias("folder")), path, by=("folder",))
    return text.targets(t.sparkSession, path)


@query("select cast(seq_no as string) as id, seq, repeat('I', length(seq)::bigint) as qual from targets", "targets")
def fastq_files(t):
    path = _place(t, "fastq")
    sinks.fastq(t.select(F.col("seq_no").cast("string").alias("id"), "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"), F.col("seq_no").alias("ord")), path)
    return binary.fastq(t.sparkSession, path).select("id", "seq", "qual")


@query("select gene, concat(cast(seq_no as string), m) as seq_id, case when m = '/1' then seq else reverse(seq) end as seq from targets, (values ('/1'), ('/2')) as v(m)", "targets")
def interleaved_files(t):
    path = _place(t, "pairs")
    number = F.col("seq_no").cast("string")
    pairs = t.select("gene", F.col("seq_no").alias("ord"), F.concat(number, F.lit("/1")).alias("id1"), F.col("seq").alias("seq1"), F.concat(number, F.lit("/2")).alias("id2"), F.reverse("seq").alias("seq2"))
    sinks.fasta(sinks.interleaved(pairs), path, by=("gene",), order=("ord",))
    found = text.fasta(t.sparkSession, path)
    return found.select(F.regexp_extract("file", "gene=([^/]*)", 1).alias("gene"), F.col("seq_name").alias("seq_id"), "seq")


@query("select cast(read_id as string) as read_id, target, cast(score as bigint) as score from hits where ln % 7 <> 0", "hits")
def sam_files(h):
    """Lines of every hit; those flagged as unmapped aren't read."""
    path = _place(h, "sam")
    sinks.sam(h.select("read_id", F.when(F.col("ln") % 7 == 0, 4).otherwise(0).alias("flag"), "target", F.lit(1).alias("pos"), F.col("score").cast("int").alias("mapq"), F.lit("ACGT").alias("seq"), F.lit(0).alias("nm")), path)
    return text.sam(h.sparkSession, path).select("read_id", "target", F.col("score").cast("long").alias("score"))


@query("select gene, taxon, sum(cast(score as bigint))::bigint as total from hits group by all", "hits")
def tabular_files(h):
    path = _place(h, "hits")
    zero = [F.lit(0).alias(c) for c in ("pct", "length", "mismatches", "gaps", "q_start", "q_end", "t_start", "t_end", "evalue")]
    sinks.table(h.select("read_id", "target", *zero, "score"), path, header=False)
    return distribute.target_scores(distribute.named_hits(text.tabular(h.sparkSession, path)))


@query("select cast(sample as string) as sample, cast(gene as string) as gene, len, mean_len::double as mean_len from lengths join means using (gene)", "lengths", "means")
def length_files(n, m):
    path = _place(n, "lengths")
    rows = n.select(F.col("sample").cast("string").alias("sample"), "gene", "len").unionByName(m.select(F.lit("MeanLength").alias("sample"), "gene", F.col("mean_len").alias("len")))
    sinks.matrix(rows, path, "len", list(range(40)))
    found, means = text.length_matrix(n.sparkSession, path)
    return found.where("len is not null").join(means, "gene").select("sample", "gene", "len", "mean_len")


@query("select cast(gene as string) as gene, cast(sample as string) as sample from (select distinct gene, sample from lengths where len < 300)", "lengths")
def deny_files(n):
    path = _place(n, "deny")
    short = n.where("len < 300").select(F.col("gene").cast("string").alias("gene"), F.col("sample").cast("string").alias("sample")).distinct()
    sinks.table(reports.deny_list(short), path, header=False)
    return text.denied(n.sparkSession, path)


@query("select distinct cast(sample as string) as sample from lengths", "lengths")
def name_files(n):
    path = _place(n, "names")
    sinks.table(n.select("sample").distinct(), path, header=False)
    return text.names(n.sparkSession, path)


@query("select gene, max(taxon) as taxon from targets group by gene", "targets")
def preference_files(t):
    path = _place(t, "preferred")
    sinks.table(t.groupBy("gene").agg(F.max("taxon").alias("taxon")), path, header=False)
    return text.preferred(t.sparkSession, path)


@query("select sum(score)::bigint as mapped from (select cast(score as bigint) as score from hits)", "hits")
def flagstat_files(h):
    path = _place(h, "flagstat")
    counts = h.groupBy("taxon").agg(F.sum(F.col("score").cast("long")).alias("n"))
    lines = F.explode(F.array(F.concat_ws("\t", F.col("n").cast("string"), F.lit("0"), F.lit("primary mapped")), F.concat_ws("\t", F.lit("7"), F.lit("0"), F.lit("mapped"))))
    counts.select(lines.alias("value")).write.text(path)
    return text.primary_mapped(h.sparkSession, path).agg(F.sum("mapped").alias("mapped"))


@query(
    """, h as (select name, -sum(p * log2(p)) as h from (select seq_no, name, c, count(*) / max(length(seq))::double as p from (select seq_no, name, seq, unnest(string_split(seq, '')) as c from targets) group by all) group by seq_no, name)
    select 'SLIDING_WINDOW_SIZE' as key, '100' as vals union all select 'ALLOW_GENE_REMOVAL', 'False' union all select 'LOW_COMPLEXITY_SEQUENCES', coalesce(string_agg(name, ',' order by name), 'None') from (select distinct name from h where h <= 1.9)""",
    "targets",
)
def control_files(t):
    path = _place(t, "control")
    sinks.control(targets.control_rows(targets.check(t, threshold=1.9), {"SLIDING_WINDOW_SIZE": 100, "ALLOW_GENE_REMOVAL": False}), path)
    return text.control(t.sparkSession, path).select("key", F.array_join("values", ",").alias("vals"))


@query(f"select cast(sample as string) as \"Name\", count(*) as \"GenesWithSeqs\", sum(len)::bigint as \"TotalBasesRecovered\" from lengths where len > 0 and sample in (select sample from seqs) group by sample", "seqs", "lengths", "means", "flags")
def stats_files(s, n, m, f):
    path = _place(n, "stats")
    reads = s.groupBy("sample").agg(F.count("*").alias("total"), F.count_if(F.col("kind") > 0).alias("mapped"))
    sinks.table(reports.stats(reads, reads, n, m, f), path)
    return text.stats(n.sparkSession, path).where("GenesWithSeqs > 0").select("Name", "GenesWithSeqs", "TotalBasesRecovered")


@query("select gene, sample, concat(cast(sample as string), '-', cast(gene as string)) as name, repeat('A', len) as seq from lengths where len < 200", "lengths")
def sample_files(n):
    """Sequences of several genes in one file, named by sample and gene."""
    path = _place(n, "samples")
    sinks.samples_fasta(n.where("len < 200").select("sample", "gene", F.repeat(F.lit("A"), F.col("len").cast("int")).alias("seq")), path, (), gene_in_name=True)
    found = text.fasta(n.sparkSession, path).select(F.col("seq_name").alias("name"), "seq")
    return found.select(sequences.gene_of(F.col("name")).cast("int").alias("gene"), sequences.taxon_of(F.col("name")).cast("int").alias("sample"), "name", "seq")


@query("select seq_no, concat(cast(seq_no as string), '/1') as id1, reverse(seq) as seq2 from targets", "targets")
def mate_files(t):
    """Mates in two files, joined by their places."""
    paths = []
    for n, seq in ((1, F.col("seq")), (2, F.reverse("seq"))):
        paths.append(_place(t, f"mates{n}"))
        rows = t.select(F.concat(F.col("seq_no").cast("string"), F.lit(f"/{n}")).alias("id"), seq.alias("seq"), F.repeat(F.lit("I"), F.length("seq")).alias("qual"), F.col("seq_no").alias("ord"))
        sinks.fastq(rows.coalesce(1), paths[-1])
    pairs = binary.fastq_pairs(t.sparkSession, *paths)
    return pairs.select(F.regexp_extract("id2", "^([0-9]+)/2$", 1).cast("long").alias("seq_no"), "id1", "seq2")


@query("select contig, s + 1 as s, e, case when strand = -1 then 1 else 7 end as h_s, list_sum(list_transform(range(0, (e - s)::bigint), lambda i: case when i % 3 = 0 then 0 else 1 end))::bigint as same from hsps where ln = 7", "hsps")
def xml_files(h):
    """Hits written as XML, with a mismatch at every third place of the midline."""
    path = _place(h, "xml")
    field = lambda name, value: F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))
    n = (F.col("e") - F.col("s")).cast("int")
    middle = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i % 3 == 0, " ").otherwise("|")), "")
    back = F.col("strand") == -1
    ends = F.when(back, F.struct((n + 1).alias("a"), F.lit(2).alias("b"))).otherwise(F.struct(F.lit(8).alias("a"), (n + 7).alias("b")))
    hsp = F.concat(F.lit("<Hit_hsps><Hsp>"), field("Hsp_query-from", F.col("s") + 2), field("Hsp_query-to", F.col("e") + 1), field("Hsp_hit-from", ends["a"]), field("Hsp_hit-to", ends["b"]), field("Hsp_midline", middle), F.lit("</Hsp></Hit_hsps>"))
    line = F.concat(F.lit("<Hit>"), field("Hit_def", F.col("contig")), field("Hit_len", n + 9), hsp, F.lit("</Hit>"))
    ends_ = h.sparkSession.createDataFrame([(0, "<Out>"), (2, "</Out>")], "rank int, value string")
    sinks.lines(h.where("ln = 7").select(F.lit(1).alias("rank"), line.alias("value")).unionByName(ends_), path)
    found = text.blast_xml(h.sparkSession, path)
    return found.select("contig", "s", (F.col("e") - 1).alias("e"), F.col("h_s").cast("int").alias("h_s"), F.aggregate("ident", F.lit(0).cast("long"), lambda a, x: a + x).alias("same"))


@query("select distinct concat('s', cast(sample as string)) as sample, concat('g', cast(gene as string)) as stem, (sample + gene * 0.5)::double as depth from lengths", "lengths")
def names_of_files(n):
    """Samples and stems of file names, and depths of contig names."""
    read = F.concat(F.lit("/data/s"), F.col("sample").cast("string"), F.lit("_R1.fastq.gz"))
    file = F.concat(F.lit("out/g"), F.col("gene").cast("string"), F.lit("_supercontig.fasta"))
    contig = F.concat(F.lit("NODE_1_length_9_cov_"), (F.col("sample") + F.col("gene") * 0.5).cast("string"))
    return n.select(sequences.sample_of_file(read).alias("sample"), sequences.stem(file).alias("stem"), sequences.contig_depth(contig).alias("depth")).distinct()


@query("select gene, contig, concat_ws(',', contig, cast(gene as string), cast(s as string), cast(e as string), concat(cast(sim as string), '.00'), concat('(', cast(strand as string), ')')) as name from hsps", "hsps")
def hit_names(h):
    return h.select("gene", "contig", hits.hit_name(h).alias("name"))


@query("select gene, max(length(seq)) as longest from targets group by gene", "targets")
def longest_reference(t):
    return t.groupBy("gene").agg(F.max_by("seq", F.length("seq")).alias("seq")).select("gene", F.length("seq").cast("long").alias("longest"))


@query(
    """, g as (select distinct read_id, gene from hits), p as (select contig * 2 as id1, contig as id2 from seqs where kind > 0), u as (select contig as id1 from seqs where kind = 0)
    select id1, id2, gene from p join g on id1 = read_id union all select id1, id2, gene from p join g on id2 = read_id where id1 not in (select read_id from g)
    union all select id1, null, gene from u join g on id1 = read_id""",
    "hits",
    "seqs",
)
def pairs_and_single_reads(h, s):
    pairs = s.where("kind > 0").select((F.col("contig") * 2).alias("id1"), F.col("contig").alias("id2"))
    return distribute.pairs_to_genes(pairs, h, s.where("kind = 0").select(F.col("contig").alias("read_id")))


@query(
    f"""{_KEPT} select 'identity' as stage, gene, contig as hit_id, concat('(', cast(s0 as string), ', ', cast(e0 as string), ')') as original, concat('(', cast(s as string), ', ', cast(e as string), ')') as trimmed, cast(strand as string) as strand from kept""",
    "hsps",
)
def stage_rows(h):
    out = pipelines.extract_contigs(aligned(h))["stage_rows"].where("stage = 'identity'")
    return out.select("stage", "gene", "hit_id", F.col("query_HSP_range_limits_original").alias("original"), F.col("query_HSP_range_limits_trimmed").alias("trimmed"), F.col("hit_strand").alias("strand"))
