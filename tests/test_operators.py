"""Operators against plain loops, and the decisions on odd behaviour."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from baitline.functions import ranges, sequences
from baitline.operators import assembly, chimera, distribute, hits, introns, mapping, paralogs, reports, targets
from baitline.streaming import hits as streaming

HSP = "gene string, contig string, s long, e long, sim double, depth double"


def random_hsps(seed, genes=30, each=12):
    rng = random.Random(seed)
    rows = []
    for g in range(genes):
        for c in range(rng.randrange(1, each)):
            s = rng.randrange(40)
            rows.append((f"g{g}", f"c{c}", s, s + rng.randrange(1, 25), float(rng.randrange(60, 100)), float(rng.randrange(5))))
    return rows


def test_containment_against_pairs(spark):
    rows = random_hsps(1)
    got = {(r.gene, r.contig) for r in hits.uncontained(spark.createDataFrame(rows, HSP)).collect()}
    genes = defaultdict(list)
    for r in rows:
        genes[r[0]].append(r)
    want = set()
    for g, own in genes.items():
        best = {}
        for r in own:
            old = best.get((r[2], r[3]))
            if old is None or (-r[4], -r[5], r[1]) < (-old[4], -old[5], old[1]):
                best[r[2], r[3]] = r
        want |= {(g, r[1]) for (s, e), r in best.items() if not any((a, b) != (s, e) and a <= s and b >= e for a, b in best)}
    assert got == want


def test_coverage_against_positions(spark):
    rows = random_hsps(2)
    got = {r.gene: r.deep for r in paralogs.covered_twice(spark.createDataFrame(rows, HSP)).collect()}
    depth = defaultdict(lambda: defaultdict(int))
    for g, _, s, e, *_ in rows:
        for p in range(s, e):
            depth[g][p] += 1
    assert got == {g: sum(n > 1 for n in d.values()) for g, d in depth.items()}


def plain_trim(ident, window, threshold):
    n = len(ident) - window + 1
    good = [sum(ident[i : i + window]) * 100 / window > threshold for i in range(max(n, 0))]
    if not good or good[0]:
        return 0
    if True not in good:
        return None
    k = good.index(True)
    return k + ident[k : k + window].index(1)


def test_terminal_trim_against_loop(spark):
    rng = random.Random(3)
    rows = [(i, [int(rng.random() < rng.choice([0.3, 0.8, 0.95])) for _ in range(rng.randrange(1, 30))]) for i in range(400)]
    got = spark.createDataFrame(rows, "i long, ident array<int>").select("i", ranges.terminal_trim(F.col("ident")).alias("t")).collect()
    for r in got:
        ident = rows[r.i][1]
        assert (r.t.five, r.t.three) == (plain_trim(ident, 5, 75), plain_trim(ident[::-1], 5, 75))


def test_a_hit_without_a_good_window_is_dropped_alone(spark):
    rows = [("g", "bad", 0, 6, [0] * 6, "ACGACGACGACGACGACG", 60.0, 1.0), ("g", "good", 0, 6, [1] * 6, "ATGATGATGATGATGATG", 90.0, 1.0)]
    frame = spark.createDataFrame(rows, "gene string, contig string, s long, e long, ident array<int>, hit_seq string, sim double, depth double")
    (r,) = hits.extract(frame).collect()
    assert (r.hits, r.seq, r.protein, r.internal_stop) == (1, "ATG" * 6, "M" * 6, False)


def test_extract_trims_overlaps_and_pads_gaps(spark):
    rows = [("g", "a", 0, 6, [1] * 6, "AAAAAAAAAAAAAAA---", 90.0, 1.0), ("g", "b", 5, 10, [1] * 5, "CCCCCCCCCCCCCCC", 90.0, 1.0), ("g", "c", 12, 17, [1] * 5, "GGGGGGGGGGGGGGG", 90.0, 1.0)]
    frame = spark.createDataFrame(rows, "gene string, contig string, s long, e long, ident array<int>, hit_seq string, sim double, depth double")
    # the overlap counts gapped characters, gaps go afterwards
    assert hits.extract(frame).first().seq == "A" * 15 + "C" * 15 + "N" * 6 + "G" * 15
    assert hits.extract(frame, pad=False).first().seq == "A" * 15 + "C" * 15 + "G" * 15
    assert hits.extract(frame, threshold=95.0).count() == 0


def test_similarity_is_compared_as_a_number(spark):
    frame = spark.createDataFrame([("g", "a", 0, 5, 100.0, 1.0), ("g", "b", 0, 5, 99.0, 9.0)], HSP)
    assert hits.uncontained(frame).first().contig == "a"


def test_sequences(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(sequences.translate(F.lit("GGNATGTAANNNTCNTANCTNACN"))) == "GM*XSXLT"
    assert one(sequences.translate(F.lit("ATG---AT"))) == "M-" and one(sequences.translate(F.lit("AT"))) == ""
    assert one(sequences.pad_codons(F.lit("ATGA"))) == "ATGANN" and one(sequences.pad_codons(F.lit("ATG"))) == "ATG"
    assert one(sequences.reverse_complement(F.lit("AACGN"))) == "NCGTT"
    assert one(sequences.entropy(F.lit("ACGT"))) == 2.0 and one(sequences.entropy(F.lit(""))) == 0.0 and one(sequences.entropy(F.lit("AAAA"))) == 0.0
    assert one(sequences.frame(F.lit("ATGATGA"), 2)) == "GAT"
    assert one(sequences.internal_stops(F.lit("M*M*"))) == 1 and one(sequences.internal_stops(F.lit("M*M*"), False)) == 2
    assert one(sequences.contig_depth(F.lit("NODE_1_length_9_cov_12.5"))) == 12.5
    assert one(sequences.sample_of_file(F.lit("/x/s1_R1.fastq"))) == "s1"
    assert one(sequences.stem(F.lit("/x/g1.2_supercontig.fasta"))) == "g1.2"
    assert one(sequences.gene_of(F.lit("Tax-on-g1.a"))) == "g1.a" and one(sequences.taxon_of(F.lit("Tax-on-g1.a"))) == "Tax-on"


def test_read_ids_lose_their_mate_suffix_only(spark):
    ids = ["ERR.11/1 x", "r/2", "r1", "r11/1", "a/3"]
    got = [r.x for r in spark.createDataFrame([(i,) for i in ids], "i string").select(sequences.read_id(F.col("i")).alias("x")).collect()]
    assert got == ["ERR.11", "r", "r1", "r11", "a/3"]


def test_exclusion_works_on_any_hits(spark):
    frame = distribute.named_hits(spark.createDataFrame([("r1/1", "a-g", 5.0), ("r2", "b-g", 3.0)], "read_id string, target string, score double"))
    assert tuple(distribute.best_targets(frame).first()) == ("g", "a", 5)
    assert tuple(distribute.best_targets(distribute.without_taxon(frame, "a")).first()) == ("g", "b", 3)
    assert {r.read_id for r in frame.collect()} == {"r1", "r2"}


def test_paralogs_without_depth(spark):
    frame = spark.createDataFrame([("g", "a", 0, 5, 80.0, 100.0), ("g", "b", 1, 6, 90.0, 1.0), ("g", "c", 2, 7, 85.0, 1.0)], HSP)
    main = lambda m: paralogs.with_main(frame, multiplier=m).where("main").first().contig
    assert main(10.0) == "a" and main(0) == "b" and main(200.0) == "b"
    names = {r.contig: r.suffix for r in paralogs.named(paralogs.with_main(frame)).collect()}
    assert names == {"a": "main", "b": "0", "c": "1"}


def test_ranges(spark):
    frags = "array(named_struct('s', 0L, 'e', 4L), named_struct('s', 10L, 'e', 13L), named_struct('s', 20L, 'e', 21L))"
    f = F.expr(frags)
    r = spark.range(1).select(ranges.span(f).alias("n"), ranges.exons(f).alias("x"), ranges.introns(f).alias("i"), ranges.reversed_ranges(f, F.lit(30)).alias("v"), ranges.introns(F.expr("array(named_struct('s', 0L, 'e', 4L))")).alias("none")).first()
    assert r.n == 8 and [tuple(x) for x in r.x] == [(0, 4), (4, 7), (7, 8)] and [tuple(x) for x in r.i] == [(4, 10), (13, 20)]
    assert [tuple(x) for x in r.v] == [(26, 30), (17, 20), (9, 10)] and r.none == []


def test_stops_in_long_sequences(spark):
    """One pass over a sequence, whatever its length: codon by codon from the whole gapped text, this took minutes."""
    rows = [(1, "AC-G" * 60_000 + "TAA"), (2, "AC-G" * 60_000 + "TAAT"), (3, "TAA" + "ACG" * 60_000), (4, "ATAACG" * 60_000), (5, "T-A-A"), (6, "TAATA"), (7, ""), (8, None)]
    frame = spark.createDataFrame(rows, "contig int, hit_seq string").repartition(1)
    began = time.monotonic()
    assert sorted(r.contig for r in hits.without_internal_stops(frame).select("contig").collect()) == [1, 4, 5, 7, 8]
    assert time.monotonic() - began < 30
    assert sorted(r.contig for r in hits.without_internal_stops(frame, terminal_is_fine=False).select("contig").collect()) == [4, 7, 8]
    seq = F.regexp_replace("hit_seq", "-", "")
    protein = sequences.translate(seq)
    same = (sequences.stop_codons(seq) == sequences.stops(protein)) & (sequences.ends_in_stop(seq) == (F.coalesce(sequences.translate(sequences.pad_codons(seq)), F.lit("")).endswith("*")))
    assert frame.where(~same).count() == 0


def test_target_checks_and_repairs(spark):
    rows = [("a-g1", "a", "g1", "CTAACTGACCCC"), ("b-g1", "b", "g1", "CCTAACTGACCCC"), ("c-g1", "c", "g1", "TAATAATAATTAATTAATTAA"), ("c-g1", "c", "g1", "ATGTAA"), ("d_g2", "d", "g2", "ATGATGA")]
    frame = spark.createDataFrame(rows, "name string, taxon string, gene string, seq string")
    found = {(r.section, r.name) for r in targets.check(frame).collect()}
    assert {("header", "d_g2"), ("duplicate", "c-g1"), ("not_codons", "b-g1"), ("terminal_stop", "c-g1"), ("not_codons", "d_g2")} <= found
    fixed = {r.name: (r.frame, r.seq, r.reason) for r in targets.fix(frame.where("name in ('a-g1', 'b-g1')")).collect()}
    assert fixed["a-g1"][2] is None and fixed["a-g1"][0] == 0 and fixed["b-g1"] == (1, "CTAACTGACCCC", None)
    dropped = targets.fix(frame.where("name in ('a-g1', 'b-g1')"), low_complexity_names=frame.where("name = 'a-g1'"))
    assert {r.name: r.reason for r in dropped.collect()} == {"a-g1": "low complexity", "b-g1": None}
    # the terminal-stop section is for one stop, at the end; a threshold of 0 is a threshold
    assert targets.low_complexity(frame, window=3, threshold=0.0).count() == 2


def test_least_entropy_of_batches(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ACGTN") for _ in range(rng.randrange(0, 40))) for _ in range(300)] + ["", None, "A", "日本ACG", "A" * 30]
    frame = spark.createDataFrame([*enumerate(texts)], "i int, seq string")
    of = lambda w: -sum(n / len(w) * math.log2(n / len(w)) for n in Counter(w).values()) if w else 0.0
    for r in frame.select("seq", targets.least_entropy(20)(F.col("seq")).alias("h")).collect():
        assert r.h is None if r.seq is None else r.h == pytest.approx(min(of(r.seq[k : k + 20]) for k in range(max(len(r.seq) - 20, 0) + 1)), abs=1e-9)


def test_check_of_many_targets(spark):
    """Sequences are scanned for stops once, not translated from the whole text codon by codon."""
    part = spark.range(0, 300_000, numPartitions=4).selectExpr("id", "concat('t-g', id) as name", "substr(translate(concat(md5(cast(id as string)), md5('a')), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 60) as seq")
    began = time.monotonic()
    found = {r.section: r.n for r in targets.check(part, threshold=1.9).groupBy("section").agg(F.count("*").alias("n")).collect()}
    assert time.monotonic() - began < 25 and found["stops"] > 100_000


def test_control_rows_work_out_one_section(spark):
    rows = spark.createDataFrame([("a-g1", "g1", "A" * 120), ("b_g1", "g1", "ACGTTGCA" * 15)], "name string, gene string, seq string")
    found = targets.control_rows(targets.check(rows), {"SLIDING_WINDOW_SIZE": 100})
    assert {r.key: r["values"] for r in found.collect()} == {"SLIDING_WINDOW_SIZE": ["100"], "LOW_COMPLEXITY_SEQUENCES": ["a-g1"]}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "least" in plan and "RLIKE" not in plan and "regexp" not in plan
    none = targets.control_rows(targets.check(rows.where("false")), {})
    assert [r["values"] for r in none.collect()] == [["None"]]


def test_distances_of_batches():
    rng = random.Random(8)
    word = lambda most: "".join(rng.choice("ACDEFG*XB-") for _ in range(rng.randrange(0, most)))
    a, b = [word(40) for _ in range(400)], [word(30) for _ in range(400)]
    b[:200] = [x[rng.randrange(0, 3) :] + word(4) for x in a[:200]]
    scores = {(x, y): float(6 if x == y else (ord(x) * ord(y)) % 5 - 3) for x in "ACDEFG" for y in "ACDEFG"}
    for table in (None, scores):
        assert assembly.protein_distances(a, b, table).tolist() == pytest.approx([assembly.protein_distance(x, y, table) for x, y in zip(a, b)], abs=1e-12)
    assert assembly.protein_distances([], []).tolist() == []
    many = ["".join(rng.choice("ACDEFGHIKL") for _ in range(30)) for _ in range(40_000)]
    began = time.monotonic()
    assembly.protein_distances(many, many[::-1])
    assert time.monotonic() - began < 10


def test_kmers_are_never_broadcast(spark, tmp_path):
    """A small file holds many k-mers; the plan guesses their size from the file's, so it must not choose a broadcast."""
    spark.range(1000).selectExpr("id as read_id", "concat('t', id % 7) as target", "repeat(substr(translate(md5(cast(id as string)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 30), 2) as seq").write.parquet(f"{tmp_path}/seqs")
    rows = spark.read.parquet(f"{tmp_path}/seqs")
    for classes in (True, False):
        found = mapping.map_reads(rows.select("read_id", "seq"), rows.select("target", "seq"), classes=classes)
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() >= 1000


def test_reports(spark):
    stats = spark.createDataFrame([("s1", 10, 5), ("s2", 3, 50)], "sample string, genes long, bases long")
    assert [r.sample for r in reports.passing(stats, [("genes", "greater", 0.45)], genes=10).collect()] == ["s1"]  # round half even: 4
    assert [r.sample for r in reports.passing(stats, [("genes", "greater", 2), ("bases", "greater", 10)], genes=10).collect()] == ["s2"]
    lengths = spark.createDataFrame([("s1", "g1", 10), ("s2", "g1", 0), ("s2", "g2", 40)], "sample string, gene string, len long")
    means = spark.createDataFrame([("g1", 20), ("g2", 20)], "gene string, mean_len long")
    denied = reports.denied(lengths, means, 0, 0.6)
    assert [tuple(r) for r in denied.collect()] == [("s1", "g1")]
    assert {tuple(r) for r in reports.without_denied(lengths, denied.where("false")).collect()} == {tuple(r) for r in lengths.collect()}  # a gene without denials
    reads = spark.createDataFrame([("s1", 1, 3), ("s2", 0, 0)], "sample string, mapped long, total long")
    flags = spark.createDataFrame([("s1", "g1", "single", False, True, False)], "sample string, gene string, stitched string, chimera boolean, paralog_long boolean, paralog_depth boolean")
    report = reports.stats(stats.select("sample"), reads, lengths, means, flags, lengths.where("sample = 's2'"))
    assert report.columns == reports.STATS_COLUMNS and len(report.columns) == 18
    out = {r.Name: r for r in report.collect()}
    assert out["s1"].PctOnTarget == 33.3 and out["s2"].PctOnTarget == 0.0 and out["s2"].GenesAt150pct == 1 and out["s1"].ParalogWarningsLong == 1 and out["s2"].GenesWithoutStitchedContigs == 0
    assert (out["s1"].GenesMapped, out["s2"].GenesMapped, out["s2"].GenesWithSeqs, out["s2"].TotalBasesRecovered) == (0, 2, 1, 40)
    files = spark.createDataFrame([("f1", "a", "ACG"), ("f1", "b", "TTT"), ("f2", "b", "GG")], "file string, name string, seq string")
    assert dict(reports.concatenated(files).collect()) == {"a": "ACG--", "b": "TTTGG"}
    assert [tuple(r) for r in reports.partitions(files).orderBy("file").collect()] == [("f1", "all", 1, 3, 1), ("f2", "all", 4, 5, 1)]


def test_chimeras_and_introns(spark):
    pairs = spark.createDataFrame([("g", "c1", "c2", 0, 5)] * 6 + [("h", "c1", "c2", 0, 5)] * 5 + [("k", "c1", "c1", 0, 9)] * 9, "gene string, contig1 string, contig2 string, nm1 long, nm2 long")
    assert [tuple(r) for r in chimera.chimeric_genes(pairs).collect()] == [("g", 6)]
    pieces = spark.createDataFrame([("g", 1, "ACG", 3), ("g", 2, "TT", 2)], "gene string, rank int, seq string, len int")
    assert introns.supercontig(pieces).first().supercontig == "ACG" + "N" * 10 + "TT"
    assert [(r.lo, r.hi) for r in chimera.offsets(pieces).orderBy("rank").collect()] == [(0, 3), (3, 5)]
    reads = spark.createDataFrame([(1, 4, 6), (2, 4, 9)], "i int, start long, end long").withColumn("exons", F.expr("array(named_struct('s', 3L, 'e', 7L))"))
    assert [r.i for r in chimera.in_exons(reads).collect()] == [1]


def test_native_mapping_assembly_and_alignment(spark):
    rng = random.Random(5)
    ref = "".join(rng.choice("ACGT") for _ in range(300))
    reads = [("s", "g", ref[i : i + 80]) for i in range(0, 221, 5)]
    (contig,) = assembly.assemble(spark.createDataFrame(reads, "sample string, gene string, seq string")).collect()
    turned = contig.seq.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert contig.contig.startswith("NODE_1_length_") and (contig.seq in ref or turned in ref) and contig.length > 250
    frame = spark.createDataFrame([(1, ref[:80]), (2, "A" * 80)], "read_id long, seq string")
    target = spark.createDataFrame([("t", ref), ("u", "C" * 200)], "target string, seq string")
    assert [tuple(r) for r in mapping.map_reads(frame, target).collect()] == [(1, "t", 60)]
    protein = spark.createDataFrame([("p", assembly.residues(ref[1:]))], "target string, seq string")
    assert [r.read_id for r in mapping.map_reads(frame, protein, k=5, translated=True).collect()] == [1]
    pairs = spark.createDataFrame([("g", "c", assembly.residues(ref[:150]), ref[::-1].translate(str.maketrans("ACGT", "TGCA")))], "gene string, contig string, target_seq string, contig_seq string")
    (a,) = assembly.align(pairs, protein=True).collect()
    assert (a.s, a.e, a.strand, a.sim, a.hit_seq) == (0, 50, -1, 100.0, ref[:150])
    (n,) = assembly.align(pairs.withColumn("target_seq", F.lit(ref[50:100] + ref[101:150]))).collect()
    assert n.e - n.s == 99 and len(n.ident) == 99
    mates = spark.createDataFrame([(ref[:80], ref[50:130][::-1].translate(str.maketrans("ACGT", "TGCA"))), (ref[:50], "G" * 50)], "seq1 string, seq2 string")
    assert [r.merged for r in assembly.merge_pairs(mates).collect()] == [ref[:130], None]
    placed = assembly.ungapped(spark.createDataFrame([("g", 1, ref[20:60]), ("g", 2, "A" * 40)], "gene string, read_id long, seq string"), spark.createDataFrame([("g", ref)], "gene string, ref string")).collect()
    assert [(r.read_id, r.start, r.end, r.nm) for r in placed] == [(1, 20, 60, 0)]
    scores = {(x, y): 4 if x == y else -1 for x in "AC" for y in "AC"}
    assert assembly.blosum_distance("ACX", "ACA", scores) == 0 and assembly.blosum_distance("AA", "CC", scores) == pytest.approx(1.25)


def test_stream_of_hits(spark, tmp_path):
    folder = tmp_path / "hits"
    folder.mkdir()
    line = "{}\ttax-{}-g1\t90\t30\t0\t0\t1\t9\t1\t9\t0\t{}\n"
    (folder / "1.tsv").write_text(line.format("r1", "a", 10) + line.format("r2", "b", 15))
    (folder / "2.tsv").write_text(line.format("r3", "a", 10))
    seen = []
    query = streaming.best_so_far(streaming.watch(spark, str(folder), 1), lambda best, n: seen.append([tuple(r) for r in best.collect()]), str(tmp_path / "state"), once=True)
    query.awaitTermination(120)
    assert seen[-1] == [("g1", "tax-a", 20)]


def test_assemble_from_reads_to_genes(spark):
    from baitline.plans import pipelines

    rng = random.Random(12)
    refs = {g: "".join(rng.choice("ACGT") for _ in range(240)) for g in ("g1", "g2")}
    reads = [(f"{g}_{i}", r[i : i + 80]) for g, r in refs.items() for i in range(0, 161, 4)]
    rows = [(f"tax-{g}", "tax", g, r) for g, r in refs.items()] + [("other-g1", "other", "g1", "".join(rng.choice("ACGT") for _ in range(200)))]
    target_set = spark.createDataFrame(rows, "name string, taxon string, gene string, seq string")
    out = pipelines.assemble(spark.createDataFrame(reads, "read_id string, seq string"), target_set)
    got = {r.gene: r.seq for r in out["genes"].collect()}
    assert set(got) == set(refs) and all(got[g] in refs[g] and len(got[g]) > 200 for g in refs)
    assert {r.gene: r.reads for r in out["counts"].collect()} == {"g1": 41, "g2": 41}


def test_commands(spark):
    from baitline.plans import pipelines

    genes = spark.createDataFrame([("s1", "g1", "FNA", "ACG"), ("s2", "g1", "FNA", "AC"), ("s1", "g1", "FAA", "T")], "sample string, gene string, kind string, seq string")
    chimeras = spark.createDataFrame([("s2", "g1")], "sample string, gene string")
    assert [r["sample"] for r in pipelines.retrieve_sequences(genes, "FNA", chimeras=chimeras).collect()] == ["s1"]
    assert pipelines.retrieve_sequences(genes, "FNA", wanted=chimeras.select("sample")).first().seq == "AC"
    found = spark.createDataFrame([("s1", "g1", "a"), ("s1", "g1", "b")], "sample string, gene string, seq string")
    own = spark.createDataFrame([("s1", "g1", "c"), ("s2", "g1", "d"), ("s2", "g2", "e")], "sample string, gene string, seq string")
    out = pipelines.paralog_retriever(chimeras.select("sample").union(spark.createDataFrame([("s1",)], "sample string")), found, own, chimeras, 0.5)
    assert sorted(r.seq for r in out["paralogs_all"].collect()) == ["a", "b", "d", "e"] and sorted(r.seq for r in out["paralogs_no_chimeras"].collect()) == ["a", "b", "e"]
    assert {(r["sample"], r.gene): r.copies for r in out["matrix"].collect()} == {("s1", "g1"): 2, ("s1", "g2"): 0, ("s2", "g1"): 1, ("s2", "g2"): 1}
    assert [tuple(r) for r in out["genes"].collect()] == [("g1", 1)] and [tuple(r) for r in out["samples"].collect()] == [("s1", 1)]
    hsps = spark.createDataFrame([("g", "a", 1, 6, 1, "ACGTACGT", None, [(0, 4), (8, 12)])], "gene string, contig string, rank int, e long, strand int, piece string, cut_bases long, h_frags array<struct<s:long,e:long>>")
    parts = pipelines.intronerate(hsps, spark.createDataFrame([("g", "a", "ACGTTTTTACGT")], "gene string, contig string, seq string"))
    assert parts["introns"].first().introns == ["TTTT"] and parts["supercontigs"].first().supercontig == "ACGTTTTTACGT"
    with pytest.raises(ValueError, match="not between"):
        pipelines.Options(thresh=101)
    long = spark.createDataFrame([("g", "a", 0, 9, [1] * 9, "A" * 27, 90.0, 50.0, 10), ("g", "b", 0, 8, [1] * 8, "C" * 24, 95.0, 2.0, 10), ("h", "c", 0, 9, [1] * 9, "G" * 27, 90.0, 1.0, 10)], "gene string, contig string, s long, e long, ident array<int>, hit_seq string, sim double, depth double, query_len int")
    got = pipelines.extract_contigs(long)
    assert {(r.gene, r.contig): r.suffix for r in got["paralogs"].collect()} == {("g", "a"): "main", ("g", "b"): "0"}
    assert {r.gene: r.paralog_depth for r in got["depth"].collect()} == {"g": True, "h": False}
    mates = spark.createDataFrame([("g", i, 0, 3, 0, 6, 9, 5) for i in range(6)], "gene string, read_id long, start1 long, end1 long, nm1 long, start2 long, end2 long, nm2 long")
    pieces = spark.createDataFrame([("g", "a", 1, "AAAAA"), ("g", "b", 2, "CCCCC")], "gene string, contig string, rank int, piece string")
    assert [tuple(r) for r in pipelines.chimeras(pieces, mates.withColumnRenamed("read_id", "pair"))["genes"].collect()] == [("g", 6)]


def test_genes_without_any_hit(spark):
    """Over all hits, whatever their ids, scores and lengths."""
    t = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "gene string")
    h = spark.createDataFrame([("a", 7, 1, 3), ("c", 50, 60, 6), ("z", 51, 0, 1)], "gene string, read_id long, score long, ln long")
    from baitline.plans import catalogue

    assert "genes_without_any_hit" in catalogue.queries()
    assert [r.gene for r in distribute.genes_without_hits(t, h).collect()] == ["b"]


def test_paralogs_come_from_trimmed_hits(spark):
    """Long by the range as aligned; a hit that trimming drops is none, and sequences are written as trimmed."""
    from baitline.plans import pipelines

    bad, good = [0, 0] + [1] * 18, [1] * 20
    none = [1, 0, 1, 0, 1, 1, 0, 1, 0, 1] * 2  # no window of five above three quarters
    rows = [("g", "a", 0, 20, bad, "T" * 6 + "A" * 54, 90.0, 1.0), ("g", "b", 0, 20, good, "C" * 60, 100.0, 2.0), ("g", "c", 0, 20, none, "G" * 60, 60.0, 99.0), ("h", "d", 0, 20, good, "C" * 60, 100.0, 2.0), ("h", "e", 0, 20, none, "G" * 60, 60.0, 99.0)]
    hsps = spark.createDataFrame([(*r, 1, 20) for r in rows], "gene string, contig string, s long, e long, ident array<int>, hit_seq string, sim double, depth double, strand int, query_len int")
    out = pipelines.extract_contigs(hsps)
    got = {(r.gene, r.contig): (r.suffix, r.seq, r.sim) for r in out["paralogs"].collect()}
    assert got == {("g", "a"): ("0", "A" * 54, 100.0), ("g", "b"): ("main", "C" * 60, 100.0)}
    assert {r.gene: r.paralog_depth for r in out["depth"].collect()} == {"g": True, "h": False}
    rows = out["stage_rows"].where("stage = 'identity' and hit_id = 'a'").collect()
    assert [(r.query_HSP_range_limits_original, r.query_HSP_range_limits_trimmed, r["3-prime_bases_trimmed"]) for r in rows] == [("(0, 20)", "(2, 20)", "N/A")]
    assert len(out["stage_rows"].columns) == 2 + 14


def test_contig_ranges_are_trimmed_too(spark):
    ident = [0, 0] + [1] * 10 + [0, 0]
    frags = [(100, 112), (200, 230)]
    hsps = spark.createDataFrame([("g", "a", 5, 19, ident, "A" * 42, frags)], "gene string, contig string, s long, e long, ident array<int>, hit_seq string, h_frags array<struct<s:long,e:long>>")
    r = hits.trimmed(hsps).first()
    assert (r.s, r.e, r.s_untrimmed, r.e_untrimmed) == (7, 17, 5, 19) and [tuple(f) for f in r.h_frags] == [(106, 112), (200, 224)] and [tuple(f) for f in r.h_frags_untrimmed] == frags


def test_chimera_check_from_reads(spark):
    """Pairs whose mates lie in different contigs, one without edits and one with many; those over an exon's end or a join don't count."""
    from baitline.plans import pipelines

    rng = random.Random(21)
    one, two = ("".join(rng.choice("ACGT") for _ in range(120)) for _ in range(2))
    frag = lambda *x: [list(p) for p in x]
    pieces = spark.createDataFrame([("g", "a", 1, one, frag((10, 130))), ("g", "b", 2, two, frag((0, 60), (90, 150)))], "gene string, contig string, rank int, piece string, h_frags array<struct<s:long,e:long>>")
    other = str.maketrans("ACGT", "CGTA")
    edited = lambda seq, n: "".join(c.translate(other) if i % 5 == 2 and i // 5 < n else c for i, c in enumerate(seq))
    turned = lambda seq: seq.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    rows = []
    for i in range(6):
        rows.append(("g", i, one[i : i + 40], turned(edited(two[5 + i : 45 + i], 6))))  # counts
    rows += [("g", 10, one[:40], two[5:45]), ("g", 11, one[:40], edited(one[50:90], 6)), ("g", 12, one[:40], edited(two[45:85], 6)), ("g", 13, one[100:] + two[:20], edited(two[5:45], 6)), ("g", 14, one[:40], "A" * 40)]
    out = pipelines.chimera_check(pieces, spark.createDataFrame(rows, "gene string, pair int, seq1 string, seq2 string"))
    assert sorted(r.pair for r in out["pairs"].collect()) == [*range(6)]
    assert [tuple(r) for r in out["genes"].collect()] == [("g", 6)]


def test_supercontigs_end_where_their_hits_end(spark):
    from baitline.plans import pipelines

    contig = "".join(random.Random(2).choice("ACGT") for _ in range(100))
    turned = contig.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    schema = "gene string, contig string, rank int, e long, strand int, piece string, cut_bases long, h_frags array<struct<s:long,e:long>>"
    rows = [
        ("whole", "c", 1, 9, 1, "A" * 30, 9, [(10, 49)]),  # nine bases are too few
        ("one", "c", 1, 9, 1, "A" * 28, 12, [(10, 50)]),
        ("back", "c", 1, 9, -1, "A" * 28, 12, [(10, 50)]),
        ("two", "c", 1, 9, 1, "A" * 25, 15, [(10, 30), (50, 70)]),
        ("odd", "c", 1, 9, 1, "A" * 20, None, [(10, 30)]), ("odd", "d", 2, 12, 1, "A" * 20, None, [(10, 30)]), ("odd", "c", 3, 15, 1, "A" * 20, None, [(40, 60)]),
        ("strands", "c", 1, 9, 1, "A" * 20, None, [(10, 30)]), ("strands", "c", 2, 12, -1, "A" * 20, None, [(40, 60)]),
        ("twice", "c", 1, 9, 1, "A" * 20, None, [(10, 30)]), ("twice", "c", 2, 12, 1, "A" * 20, None, [(40, 60)]), ("twice", "d", 3, 15, 1, "A" * 20, None, [(0, 20)]),
    ]
    contigs = spark.createDataFrame([(g, c, contig) for g in {r[0] for r in rows} for c in "cd"], "gene string, contig string, seq string")
    out = pipelines.intronerate(spark.createDataFrame(rows, schema), contigs)
    got = {r.gene: r.supercontig for r in out["supercontigs"].collect()}
    assert got == {"whole": contig, "one": contig[:38], "back": turned[:78], "two": contig[:55], "twice": contig + "N" * 10 + contig}
    assert {r.gene: r.introns for r in out["introns"].collect()} == {"two": [contig[30:50]]}


def plain_distance(a, b):
    """Share of unequal residues at the best alignment without gaps inside."""
    best = 1.0
    for shift in range(-len(b) + 1, len(a)):
        pairs = [(a[i], b[i - shift]) for i in range(max(0, shift), min(len(a), len(b) + shift))]
        same = sum(x == y for x, y in pairs)
        if 2 * same - (len(pairs) - same) > 0:
            best = min(best, 1 - same / len(pairs)) if len(pairs) > 10 else best
    return best


def test_frames_are_chosen_by_distance(spark):
    from baitline.plans import pipelines

    rng = random.Random(31)
    codons = [a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT" if a + b + c not in ("TAA", "TAG", "TGA")]
    gene = "".join(rng.choice(codons) for _ in range(60))
    protein = assembly.residues(gene)
    no_stop = "".join(rng.choice("GC") for _ in range(90))  # no stop in any frame
    rows = [("right-g1", "g1", gene), ("shifted-g1", "g1", "C" + gene), ("inserted-g1", "g1", gene[:60] + "GCAGCA" + gene[60:]), ("far-g1", "g1", no_stop), ("alone-g2", "g2", no_stop), ("stops-g3", "g3", "TAACTAACTAAC")]
    frame = spark.createDataFrame([(n, n.split("-")[0], g, q) for n, g, q in rows], "name string, taxon string, gene string, seq string")
    given = spark.createDataFrame([("g1", protein, 1), ("g1", "MMMM", 2)], "gene string, seq string, ord int")
    out = {r.name: r for r in targets.fix(frame, references=targets.first_references(given)).collect()}
    assert {n: r.reason for n, r in out.items()} == {"right-g1": None, "shifted-g1": None, "inserted-g1": None, "far-g1": "too far from its reference", "alone-g2": "frame undetermined", "stops-g3": "no open frame"}
    assert (out["right-g1"].frame, out["shifted-g1"].frame, out["shifted-g1"].seq) == (0, 1, gene) and out["inserted-g1"].distance < 0.1
    assert {r.name: r.reason for r in targets.fix(frame, references=targets.first_references(given), maximum_distance=0.0).collect()}["inserted-g1"] in (None, "too far from its reference")
    with pytest.raises(ValueError, match="g2, g3"):
        pipelines.fix_targetfile(frame, references=given)
    fixed = pipelines.fix_targetfile(frame, references=given, allow_gene_removal=True, low_complexity_names=frame.where("name = 'right-g1'"))
    assert {r.name for r in fixed["kept"].collect()} == {"shifted-g1", "inserted-g1"} and {r.gene for r in fixed["lost_genes"].collect()} == {"g2", "g3"}
    kept = pipelines.fix_targetfile(frame, references=given, allow_gene_removal=True, low_complexity_names=frame.where("name = 'right-g1'"), keep_low_complexity=True)
    assert {r.name: r.low_complexity for r in kept["kept"].collect()} == {"right-g1": True, "shifted-g1": False, "inserted-g1": False}
    # without a reference the gene's longest sequence with a single frame is the model
    model = spark.createDataFrame([("a-g1", "a", "g1", "TAAC" + gene), ("b-g1", "b", "g1", no_stop)], "name string, taxon string, gene string, seq string")
    found = {r.name: (r.frame, r.reason) for r in targets.fix(model).collect()}
    assert found["b-g1"][1] == "too far from its reference" or found["a-g1"][1] is None
    a, b = protein[:50], "W" + protein[3:40] + "KK" + protein[40:]
    assert assembly.protein_distance(a, a) == 0 and 0 < assembly.protein_distance(a, b) < 0.1
    x, y = assembly.global_alignment(a, b)
    assert len(x) == len(y) and x.replace("-", "") == a and y.replace("-", "") == b
    for _ in range(5):
        cut = rng.randrange(20)
        assert assembly.protein_distance(protein, protein[cut:]) == pytest.approx(plain_distance(protein, protein[cut:])) == 0


def test_all_query_sections_on_every_column(spark):
    """Frames that hold a sample are grouped by it too."""
    hsps = spark.createDataFrame([("s1", "g", "a", 0, 9, 90.0, 1.0), ("s2", "g", "b", 2, 5, 90.0, 1.0)], "sample string, gene string, contig string, s long, e long, sim double, depth double")
    assert hits.uncontained(hsps).count() == 2 and hits.uncontained(hsps.drop("sample")).count() == 1


def test_pairs_and_reads_without_a_mate(spark):
    pairs = spark.createDataFrame([("a", "b"), ("c", "d"), ("e", "f"), ("c", "a")], "id1 string, id2 string")
    read_hits = spark.createDataFrame([("a", "g1"), ("a", "g1"), ("a", "g2"), ("b", "g3"), ("d", "g4"), ("u", "g5")], "read_id string, gene string")
    got = sorted(map(tuple, distribute.pairs_to_genes(pairs, read_hits, spark.createDataFrame([("u",), ("v",)], "read_id string")).collect()), key=str)
    assert got == sorted([("a", "b", "g1"), ("a", "b", "g2"), ("c", "d", "g4"), ("c", "a", "g1"), ("c", "a", "g2"), ("u", None, "g5")], key=str)


def test_spliced_alignment(spark):
    from baitline.plans import pipelines

    rng = random.Random(41)
    codons = [a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT" if a + b + c not in ("TAA", "TAG", "TGA")]
    exons = ["".join(rng.choice(codons) for _ in range(n)) for n in (30, 25, 40)]
    bases = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    one, two = "GT" + bases(60) + "AG", "GT" + bases(100) + "AG"
    left, right = bases(20), bases(33)
    contig = left + exons[0] + one + exons[1] + two + exons[2] + right
    protein = assembly.residues("".join(exons))
    a = assembly.spliced_alignment(protein, contig)
    h = [20, 110, 174, 249, 353, 473]
    assert a["frags"] == [(0, 30, h[0], h[1]), (30, 55, h[2], h[3]), (55, 95, h[4], h[5])] and a["spans"] == [64, 104] and a["hit_seq"] == "".join(exons) and a["ident"] == [1] * 95
    shifted = exons[0][:45] + "A" + exons[0][45:]
    b = assembly.spliced_alignment(assembly.residues(exons[0]), left + shifted + right)
    assert b["spans"] == [1] and sum(b["ident"]) >= 28 and len(b["frags"]) == 2
    assert assembly.spliced_alignment("", contig) is None and assembly.spliced_alignment("MK", "A") is None
    turned = contig.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    pairs = spark.createDataFrame([("g", "NODE_1", protein, turned)], "gene string, contig string, target_seq string, contig_seq string")
    hsps = assembly.align_spliced(pairs)
    r = hsps.first()
    assert (r.s, r.e, r.strand, r.sim, r.intron_spans) == (0, 95, -1, 100.0, [64, 104])
    n = len(contig)
    assert [tuple(f) for f in r.h_frags] == [(n - y, n - x) for x, y in zip(h[::2], h[1::2])] and [tuple(f) for f in r.q_frags] == [(0, 30), (30, 55), (55, 95)]
    out = pipelines.extract_contigs(hsps.withColumn("depth", F.lit(3.0)))
    assert out["genes"].first().seq == "".join(exons) and out["genes"].first().protein == protein
    contigs = pairs.select("gene", "contig", F.col("contig_seq").alias("seq"))
    plain, anew = pipelines.intronerate(out["pieces"], contigs), pipelines.intronerate(out["pieces"], contigs, proteins=out["genes"])
    assert plain["supercontigs"].first().supercontig == contig and plain["introns"].first().introns == [one, two] == anew["introns"].first().introns
