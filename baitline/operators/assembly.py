"""Native substitutes for aligners and the assembler; a gene's reads are handled in one grouped call.

Results are not those of the external tools; their output can be read instead. Reads are counted into k-mers in Spark,
so a gene's group holds its distinct k-mers, however many reads it has.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.functions.sequences import CODONS, reverse_complement
from baitline.operators.mapping import kmers

_TURN = str.maketrans("ACGTN", "TGCAN")


def unitigs(counts: dict[str, int], least: int) -> list[tuple[str, float]]:
    """Maximal unbranched paths of the de Bruijn graph of k-mers seen at least ``least`` times: (sequence, mean depth)."""
    kept = {k: n for k, n in counts.items() if n >= least}
    after = lambda k: [x for c in "ACGT" if (x := k[1:] + c) in kept]
    before = lambda k: [x for c in "ACGT" if (x := c + k[:-1]) in kept]
    seen: set[str] = set()
    out = []
    for start in sorted(kept):
        if start in seen:
            continue
        path = [start]
        while len(n := after(path[-1])) == 1 and len(before(n[0])) == 1 and n[0] not in path[:1]:
            path.append(n[0])
        while len(p := before(path[0])) == 1 and len(after(p[0])) == 1 and p[0] != path[-1]:
            path.insert(0, p[0])
        seen.update(path)
        seen.update(k.translate(_TURN)[::-1] for k in path)
        out.append((path[0] + "".join(k[-1] for k in path[1:]), sum(kept[k] for k in path) / len(path)))
    return sorted(out, key=lambda x: (-len(x[0]), x[0]))


def assemble(reads: DataFrame, keys: tuple[str, ...] = ("sample", "gene"), k: int | tuple[int, ...] = 31, cutoff: int = 2, least_length: int = 60, least_depth: float = 0) -> DataFrame:
    """(keys, contig, seq, length, depth): unitigs of each gene's reads; where a k gives none, the next of several is tried.

    A single k stands for itself and one that is smaller by ten. cutoff is the least number of times a k-mer is seen,
    least_depth the least mean of these numbers over a contig.
    """
    sizes = [k, max(15, k - 10)] if isinstance(k, int) else [*k]
    strands = F.explode(F.array("seq", reverse_complement(F.col("seq"))))
    every = F.explode(F.array(*(F.struct(F.lit(n).alias("k"), kmers(F.col("s"), n).alias("list")) for n in sizes)))
    mers = reads.select(*keys, strands.alias("s")).select(*keys, every.alias("x")).select(*keys, "x.k", F.explode("x.list").alias("kmer"))
    counted = mers.where(~F.col("kmer").contains("N")).groupBy(*keys, "k", "kmer").agg(F.count("*").alias("n"))

    def contigs(frame: pd.DataFrame) -> pd.DataFrame:
        for size in sizes:
            part = frame[frame["k"] == size]
            found = [u for u in unitigs(dict(zip(part["kmer"], part["n"])), cutoff) if len(u[0]) >= least_length and u[1] >= least_depth]
            if found:
                break
        rows = [(*(frame[c].iloc[0] for c in keys), f"NODE_{i}_length_{len(s)}_cov_{d:.6f}", s, len(s), d) for i, (s, d) in enumerate(found, 1)]
        return pd.DataFrame(rows, columns=[*keys, "contig", "seq", "length", "depth"])

    kinds = dict(reads.dtypes)
    return counted.groupBy(*keys).applyInPandas(contigs, ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", contig string, seq string, length int, depth double")


def merge_pairs(pairs: DataFrame, least: int = 12, most_mismatch: float = 0.1) -> DataFrame:
    """pairs(seq1, seq2) with the merged sequence where the mates overlap, else null; longest good overlap wins."""
    turned = reverse_complement(F.col("seq2"))
    n = F.least(F.length("seq1"), F.length("seq2"))

    def agreeing(size):
        a, b = F.split(F.expr("seq1"), ""), F.split(F.col("_turned"), "")
        tail = F.slice(a, F.length("seq1") - size + 1, size)
        return F.aggregate(F.zip_with(tail, F.slice(b, F.lit(1), size), lambda x, y: F.when(x == y, 0).otherwise(1)), F.lit(0), lambda s, x: s + x) <= size * most_mismatch

    sizes = F.when(n >= least, F.sequence(n, F.lit(least), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    overlap = F.get(F.filter(F.col("_sizes"), agreeing), F.lit(0))
    return (
        pairs.withColumn("_turned", turned).withColumn("_sizes", sizes).withColumn("_overlap", overlap)
        .withColumn("merged", F.when(F.col("_overlap").isNotNull(), F.concat("seq1", F.substr(F.col("_turned"), F.col("_overlap") + 1, F.length("_turned")))))
        .drop("_turned", "_sizes", "_overlap")
    )


def local_alignment(query: str, hit: str, match: int = 5, mismatch: int = -4, gap: int = -8) -> tuple[int, int, int, int, int, str, str]:
    """Best local alignment: (score, query from, to, hit from, to, aligned query, aligned hit). Linear gap costs."""
    a, b = np.frombuffer(query.encode(), np.uint8), np.frombuffer(hit.encode(), np.uint8)
    score = np.zeros((len(a) + 1, len(b) + 1), np.int64)
    drop = gap * np.arange(len(b) + 1)
    for i in range(1, len(a) + 1):
        best = np.maximum(0, np.maximum(score[i - 1, :-1] + np.where(b == a[i - 1], match, mismatch), score[i - 1, 1:] + gap))
        row = np.concatenate(([0], best))
        score[i] = np.maximum.accumulate(row - drop) + drop  # gaps along the row, all at once
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    top, end_i, end_j, x, y = int(score[i, j]), int(i), int(j), [], []
    while i and j and score[i, j] > 0:
        if score[i, j] == score[i - 1, j - 1] + (match if a[i - 1] == b[j - 1] else mismatch):
            i, j = i - 1, j - 1
            x.append(query[i])
            y.append(hit[j])
        elif score[i, j] == score[i - 1, j] + gap:
            i -= 1
            x.append(query[i])
            y.append("-")
        else:
            j -= 1
            x.append("-")
            y.append(hit[j])
    return top, int(i), end_i, int(j), end_j, "".join(x[::-1]), "".join(y[::-1])


def residues(seq: str) -> str:
    out = []
    for i in range(0, len(seq) - 2, 3):
        at = ["TCAGN".find(c) for c in seq[i : i + 3]]
        out.append(CODONS[at[0] * 25 + at[1] * 5 + at[2]] if min(at) >= 0 else "X")
    return "".join(out)


#: Scores of spliced alignments: match, mismatch, a residue or codon too many, bases out of frame, an intron, and what
#: an intron's usual ends give back.
MATCH, MISMATCH, GAP, SHIFT, INTRON, SITE = 5, -4, -8, -12, -28, 6
LEAST_INTRON = 30
_STOP, _PAIR, _SKIP, _EXTRA, _ONE, _TWO, _JUMP = range(7)


def spliced_alignment(protein: str, seq: str) -> dict | None:
    """Best local alignment of a protein with bases that may hold introns (between codons) and bases out of frame.

    One row a residue; within a row, an extra codon, one or two bases out of frame, or a jump over LEAST_INTRON bases or
    more may follow. frags are (q_s, q_e, h_s, h_e); spans the bases between them; ident and codons run along the residues.
    Memory is nine bytes for each residue and base.
    """
    n, m = len(seq), len(protein)
    if n < 3 or not m:
        return None
    bases = np.frombuffer(seq.encode(), np.uint8)
    three = np.frombuffer("".join(residues(seq[i : i + 3]) for i in range(n - 2)).encode(), np.uint8)
    pair = lambda x, y: np.concatenate(((bases[:-1] == ord(x)) & (bases[1:] == ord(y)), [False]))
    donor = np.append(pair("G", "T"), False) * SITE  # an intron begins at a place
    acceptor = np.concatenate(([0, 0], pair("A", "G")[: n - 1] * SITE))  # or ends before it
    score, how, source = np.zeros((m + 1, n + 1), np.int32), np.zeros((m + 1, n + 1), np.int8), np.zeros((m + 1, n + 1), np.int32)
    every = np.arange(n + 1)
    for i in range(1, m + 1):
        row, op = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int8)
        moves = [(3, np.where(three == ord(protein[i - 1]), MATCH, MISMATCH), _PAIR, score[i - 1]), (0, GAP, _SKIP, score[i - 1])]
        for k, cost, name, before in moves:
            reached = before[: n + 1 - k] + cost
            better = reached > row[k:]
            row[k:][better], op[k:][better] = reached[better], name
        plain = row.copy()
        for k, cost, name in ((3, GAP, _EXTRA), (1, SHIFT, _ONE), (2, SHIFT, _TWO)):
            reached = plain[:-k] + cost
            better = reached > row[k:]
            row[k:][better], op[k:][better] = reached[better], name
        if n > LEAST_INTRON:
            leaving = plain + donor
            best = np.maximum.accumulate(leaving)
            at = np.maximum.accumulate(np.where(leaving >= best, every, 0))
            reached = best[:-LEAST_INTRON] + acceptor[LEAST_INTRON:] + INTRON
            better = reached > row[LEAST_INTRON:]
            row[LEAST_INTRON:][better], op[LEAST_INTRON:][better] = reached[better], _JUMP
            source[i, LEAST_INTRON:] = at[:-LEAST_INTRON]
        score[i], how[i] = row, op
    i, j = np.unravel_index(int(np.where(how == _PAIR, score, 0).argmax()), score.shape)
    top, q1 = int(score[i, j]), int(i)
    if top <= 0:
        return None
    ident, codons, frags, spans = [], [], [], []
    end = (int(i), int(j))
    while score[i, j] > 0:
        op = how[i, j]
        if op == _PAIR:
            i, j = i - 1, j - 3
            codons.append(seq[j : j + 3])
            ident.append(int(three[j] == ord(protein[i])))
        elif op == _SKIP:
            i -= 1
            codons.append("---")
            ident.append(0)
        elif op == _EXTRA:
            j -= 3
        else:
            frags.append((int(i), end[0], int(j), end[1]))
            to = j - 1 if op == _ONE else j - 2 if op == _TWO else int(source[i, j])
            spans.append(int(j - to))
            j = to
            end = (int(i), int(j))
    frags.append((int(i), end[0], int(j), end[1]))
    return {"score": top, "s": int(i), "e": q1, "frags": frags[::-1], "spans": spans[::-1], "ident": ident[::-1], "hit_seq": "".join(codons[::-1])}


def align_spliced(pairs: DataFrame) -> DataFrame:
    """align() of proteins with introns and bases out of frame: more columns are q_frags, h_frags and intron_spans.

    h_frags are on the contig as given, in the order of the target, so they descend on the minus strand.
    """

    def run(frames):
        for frame in frames:
            rows = []
            for gene, contig, target, seq in frame[["gene", "contig", "target_seq", "contig_seq"]].itertuples(index=False):
                found = [(a["score"], strand, a) for strand, text in ((1, seq), (-1, seq.translate(_TURN)[::-1])) if (a := spliced_alignment(target, text))]
                if found:
                    score, strand, a = max(found, key=lambda f: f[:2])
                    on = [(x, y) if strand == 1 else (len(seq) - y, len(seq) - x) for *_, x, y in a["frags"]]
                    ranges_ = [[{"s": x, "e": y} for x, y in side] for side in ([f[:2] for f in a["frags"]], on)]
                    rows.append((gene, contig, score, a["s"], a["e"], strand, a["ident"], a["hit_seq"], *ranges_, a["spans"]))
            yield pd.DataFrame(rows, columns=["gene", "contig", "score", "s", "e", "strand", "ident", "hit_seq", "q_frags", "h_frags", "intron_spans"])

    kinds = dict(pairs.dtypes)
    part = "array<struct<s:long,e:long>>"
    out = pairs.select("gene", "contig", "target_seq", "contig_seq").mapInPandas(run, f"gene {kinds['gene']}, contig string, score long, s long, e long, strand int, ident array<int>, hit_seq string, q_frags {part}, h_frags {part}, intron_spans array<long>")
    from baitline.functions.ranges import identity

    return out.withColumn("sim", identity(F.col("ident")))


def align(pairs: DataFrame, protein: bool = False) -> DataFrame:
    """pairs(gene, contig, target_seq, contig_seq) with the best alignment over strands (and frames, for proteins).

    s and e are on the target; ident has a flag for each aligned target position; hit_seq is the contig's aligned
    bases, three a residue on the protein path, with gaps as hyphens. align_spliced knows introns.
    """

    def best(target: str, contig: str):
        found = []
        for strand, seq in ((1, contig), (-1, contig.translate(_TURN)[::-1])):
            for offset in range(3) if protein else (0,):
                text = residues(seq[offset:]) if protein else seq
                if text and target:
                    found.append((local_alignment(target, text), strand, offset, seq))
        if not found:
            return None
        (score, q0, q1, h0, _, x, y), strand, offset, seq = max(found, key=lambda f: (f[0][0], f[1], -f[2]))
        ident, bases, h = [], [], h0
        for c, d in zip(x, y):
            unit = seq[offset + h * 3 : offset + h * 3 + 3] if protein else (seq[h] if d != "-" else "-")
            if c != "-":
                ident.append(int(c == d))
                bases.append(unit if d != "-" else "---" if protein else "-")
            h += d != "-"
        return score, q0, q1, strand, ident, "".join(bases)

    def run(frames):
        for frame in frames:
            rows = [(g, c, *r) for g, c, t, s in frame[["gene", "contig", "target_seq", "contig_seq"]].itertuples(index=False) if (r := best(t, s)) and r[0] > 0]
            yield pd.DataFrame(rows, columns=["gene", "contig", "score", "s", "e", "strand", "ident", "hit_seq"])

    kinds = dict(pairs.dtypes)
    out = pairs.select("gene", "contig", "target_seq", "contig_seq").mapInPandas(run, f"gene {kinds['gene']}, contig string, score long, s long, e long, strand int, ident array<int>, hit_seq string")
    from baitline.functions.ranges import identity

    return out.withColumn("sim", identity(F.col("ident")))


def ungapped(reads: DataFrame, stitched: DataFrame, most: int = 7) -> DataFrame:
    """reads(gene, read_id, seq) placed on their gene's stitched(gene, ref) without gaps: start, end and edits (nm)."""

    def place(seq: str, ref: str) -> tuple[int, int] | None:
        a, b = np.frombuffer(seq.encode(), np.uint8), np.frombuffer(ref.encode(), np.uint8)
        if not 0 < len(a) <= len(b):
            return None
        wrong = (np.lib.stride_tricks.sliding_window_view(b, len(a)) != a).sum(axis=1)
        at = int(wrong.argmin())
        return (at, int(wrong[at])) if wrong[at] <= most else None

    def run(frames):
        for frame in frames:
            rows = []
            for gene, read_id, seq, ref in frame[["gene", "read_id", "seq", "ref"]].itertuples(index=False):
                hits = [(h[1], h[0]) for s in (seq, seq.translate(_TURN)[::-1]) if (h := place(s, ref))]
                if hits:
                    nm, at = min(hits)
                    rows.append((gene, read_id, at, at + len(seq), nm))
            yield pd.DataFrame(rows, columns=["gene", "read_id", "start", "end", "nm"])

    kinds = dict(reads.dtypes)
    return reads.join(stitched.select("gene", "ref"), "gene").select("gene", "read_id", "seq", "ref").mapInPandas(run, f"gene {kinds['gene']}, read_id {kinds['read_id']}, start long, end long, nm long")


def global_alignment(a: str, b: str, gap: int = -2) -> tuple[str, str]:
    """Two sequences aligned over their whole lengths: a match gains 2, a mismatch costs 1; gaps at the ends are free."""
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    score = np.zeros((len(x) + 1, len(y) + 1), np.int64)
    drop = gap * np.arange(len(y) + 1)
    for i in range(1, len(x) + 1):
        best = np.maximum(score[i - 1, :-1] + np.where(y == x[i - 1], 2, -1), score[i - 1, 1:] + gap)
        score[i] = np.maximum.accumulate(np.concatenate(([0], best)) - drop) + drop
    i, j = max([(int(score[len(x), j]), len(x), j) for j in range(len(y) + 1)] + [(int(score[i, len(y)]), i, len(y)) for i in range(len(x) + 1)])[1:]
    left, right = [a[i:], "-" * (len(y) - j)], ["-" * (len(x) - i), b[j:]]
    while i and j:
        if score[i, j] == score[i - 1, j - 1] + (2 if x[i - 1] == y[j - 1] else -1):
            i, j = i - 1, j - 1
            left.append(a[i])
            right.append(b[j])
        elif score[i, j] == score[i - 1, j] + gap:
            i -= 1
            left.append(a[i])
            right.append("-")
        else:
            j -= 1
            left.append("-")
            right.append(b[j])
    left += [a[:i], "-" * j]
    right += ["-" * i, b[:j]]
    # one of the two end pieces is empty; the other side is written against gaps
    return "".join(reversed(left)), "".join(reversed(right))


#: Fixed value: the letters that a distance counts.
RESIDUES = frozenset("ARNDCQEGHILKMFPSTWYV")


def blosum_distance(a: str, b: str, scores: dict[tuple[str, str], float] | None = None) -> float:
    """1 - score(a, b) / max(score(a, a), score(b, b)) of aligned proteins; columns with another letter are skipped.

    scores is a substitution matrix by pairs of letters (sources.text.score_matrix reads one); without it a match
    counts 1 and a mismatch 0.
    """
    of = (lambda x, y: scores[x, y]) if scores else (lambda x, y: float(x == y))
    columns = [(x, y) for x, y in zip(a, b) if x in RESIDUES and y in RESIDUES]
    most = max(sum(of(x, x) for x, _ in columns), sum(of(y, y) for _, y in columns), 0)
    return 1 - sum(of(x, y) for x, y in columns) / most if most else 1.0


def protein_distance(a: str, b: str, scores: dict[tuple[str, str], float] | None = None) -> float:
    """The distance of two proteins after global alignment; a stop at the end is left out."""
    return blosum_distance(*global_alignment(a.upper().rstrip("*"), b.upper().rstrip("*")), scores)


#: Cells of one table of scores, over all the pairs that are aligned together.
ALIGNED_CELLS = 1 << 22


def protein_distances(a: list[str], b: list[str], scores: dict[tuple[str, str], float] | None = None) -> np.ndarray:
    """protein_distance of each pair; pairs of like lengths are aligned together, cell by cell as global_alignment does."""
    x, y = ([s.upper().rstrip("*").encode() for s in side] for side in (a, b))
    out = np.zeros(len(x))
    order = sorted(range(len(x)), key=lambda i: (len(x[i]), len(y[i])))
    at = 0
    while at < len(order):
        lot, n, m = [], 0, 0
        for i in order[at:]:
            wide, high = max(n, len(x[i])), max(m, len(y[i]))
            if lot and (len(lot) + 1) * (wide + 1) * (high + 1) > ALIGNED_CELLS:
                break
            lot.append(i)
            n, m = wide, high
        at += len(lot)
        out[lot] = _distances([x[i] for i in lot], [y[i] for i in lot], scores)
    return out


def _distances(x: list[bytes], y: list[bytes], scores: dict[tuple[str, str], float] | None, gap: int = -2) -> np.ndarray:
    every = np.arange(len(x))
    n, m = (np.array([*map(len, side)], np.int64) for side in (x, y))
    rows, columns = max(int(n.max()), 1), max(int(m.max()), 1)
    a, b = (np.frombuffer(b"".join(s.ljust(w, pad) for s in side), np.uint8).reshape(len(side), w) for side, w, pad in ((x, rows, b"\0"), (y, columns, b"\1")))
    score = np.zeros((len(x), rows + 1, columns + 1), np.int32)
    drop = gap * np.arange(columns + 1, dtype=np.int32)
    best = np.zeros((len(x), columns + 1), np.int32)
    for i in range(1, rows + 1):
        best[:, 1:] = np.maximum(score[:, i - 1, :-1] + np.where(b == a[:, i - 1 : i], 2, -1), score[:, i - 1, 1:] + gap)
        score[:, i] = np.maximum.accumulate(best - drop, axis=1) + drop
    # the end: the best cell of the last row or column; of equal ones the last row, and then the farthest
    low = np.iinfo(np.int32).min
    last = np.where(np.arange(columns + 1) <= m[:, None], score[every, n], low)
    side = np.where(np.arange(rows + 1) <= n[:, None], score[every, :, m], low)
    far = lambda cells: cells.shape[1] - 1 - cells[:, ::-1].argmax(axis=1)
    in_last = last.max(axis=1) >= side.max(axis=1)
    i, j = np.where(in_last, n, far(side)), np.where(in_last, far(last), m)
    steps = []
    while len(on := np.flatnonzero((i > 0) & (j > 0))):
        p, q = i[on], j[on]
        here = score[on, p, q]
        match = here == score[on, p - 1, q - 1] + np.where(a[on, p - 1] == b[on, q - 1], 2, -1)
        up = ~match & (here == score[on, p - 1, q] + gap)
        steps.append((on[match], a[on, p - 1][match], b[on, q - 1][match]))
        i[on], j[on] = p - (match | up), q - ~up
    pair, left, right = (np.concatenate([np.empty(0, np.int64), *(s[k] for s in steps)][::-1]) for k in range(3))
    residue = np.zeros(256, bool)
    residue[[*map(ord, RESIDUES)]] = True
    counts = residue[left.astype(np.int64)] & residue[right.astype(np.int64)]
    pair, left, right = pair[counts].astype(np.int64), left[counts].astype(np.int64), right[counts].astype(np.int64)
    if scores:
        table = np.zeros((256, 256))
        for c, d in {(c, d) for k in np.unique(left * 256 + right).tolist() for c, d in product(map(chr, divmod(k, 256)), repeat=2)}:
            table[ord(c), ord(d)] = scores[c, d]
    else:
        table = np.eye(256)
    total = lambda c, d: np.bincount(pair, table[c, d], len(x))
    most = np.maximum(np.maximum(total(left, left), total(right, right)), 0)
    return np.where(most != 0, 1 - total(left, right) / np.where(most != 0, most, 1), 1.0)
