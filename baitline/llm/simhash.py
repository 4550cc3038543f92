"""SimHash near-dedup: segment popcounts as an embedding, joined on a grid.

A fingerprint's 64 bits are cut into 32 segments of two bits; the segments' popcounts are a point in {0, 1, 2}^32. The
Manhattan distance of two points is a lower bound of the fingerprints' Hamming distance. The coordinates are dealt to
``groups``; a pair within ``distance`` is within floor(distance / groups) <= 2 in one of them. Two grid points within
2 of each other have a grid point within 1 of both, so each fingerprint is sent to the cells of the points within 1 of
its own, in each group (about 50 rows), and every pair that may link meets in a cell. There it is verified exactly.

Within a cell links are found by growing components from pivots: what a pivot reaches leaves the scan, so a dense
group of copies costs few passes, and only the links of a spanning forest come out, never all pairs of a group. Equal
fingerprints are one point. Components of the forest are those of all links.

The pipeline's stage (drop_near) asks for a Jaccard similarity of 0.8 instead. Its candidates are the components of the
same grid join, over fingerprints of sets and at a larger distance; pairs that even this doesn't reach share a band of
min-hashes. In both, the shingles themselves decide.

Defined cases: null and empty texts have fingerprint 0 and link like any other; a text with fewer words than a shingle
is one shingle; component_id is the smallest id reachable (null if all ids of the component are null); repeated rows
each get a row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from baitline.llm.common import OnBatches, checkpointed, fresh, joined_anew, long_batches, partitions_for, short_batches, text_or_empty
from baitline.llm.components import connected_components

DISTANCE = 4
SHINGLE = 4
SEED = 42
SEGMENTS = 32
#: Bits within which the grid joins the fingerprints of near copies; three groups.
NEAR_DISTANCE = 8
#: Near copies: the similarity as a fraction, bands of min-hashes, and bits of 128 beyond which none are.
SIMILARITY = (4, 5)
BANDS = 32
BAND_ROWS = 6
APART = 48
#: Cells with more points than this are scanned by pivots, smaller ones by offsets.
FEW = 16
#: Cells of more sets than this are split over tasks, which share this many pivots.
HOT_CELL = 4096
PIVOTS = 32


def shingles(text: str, k: int) -> list[bytes]:
    """Space-joined k-word shingles, repeats included, of the text with A-Z lowered; one shorter one if there are fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= k:
        return [joined]
    ends = np.cumsum([len(w) + 1 for w in words])
    stops = (ends[k - 1 :] - 1).tolist()
    return [joined[a:b] for a, b in zip([0, *ends[:-k].tolist()], stops)]


def fingerprint(text: str, k: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if it is set in over half the shingles' XXH64."""
    hashes = [xxh64_intdigest(s, seed) for s in shingles(text, k)]
    if not hashes:
        return 0
    return _print_of(np.array(hashes, np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t, k) for t in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors and summands of the min-hashes, and odd factors that make a band's key."""
    rng = np.random.default_rng(SEED)
    draw = lambda n: rng.integers(0, 1 << 64, n, np.uint64)
    return draw(BANDS * BAND_ROWS) | np.uint64(1), draw(BANDS * BAND_ROWS), draw(BAND_ROWS) | np.uint64(1)


def _print_of(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def sketch(text: str, k: int) -> tuple[int, int, int, bytes, np.ndarray]:
    """(node, fp, fp2, shingles, cells) of the set of shingles: its digest, two fingerprints, 32 bits of each hash, sorted, and a key a band."""
    hashes = np.unique(np.array([xxh64_intdigest(s, SEED) for s in set(shingles(text, k))], np.uint64))
    node = xxh64_intdigest(hashes.tobytes(), SEED)
    if not len(hashes):
        return node, 0, 0, b"", np.empty(0, np.uint64)
    factor, summand, odd = _permutations()
    least = np.full(len(factor), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        least = np.minimum(least, (hashes[at : at + 512] * factor[:, None] + summand[:, None]).min(axis=1))
    cells = (least.reshape(BANDS, BAND_ROWS) * odd).sum(axis=1, dtype=np.uint64) * odd[0] + np.arange(BANDS, dtype=np.uint64)
    other = (hashes ^ (hashes >> np.uint64(31))) * factor[0]
    other = (other ^ (other >> np.uint64(29))) * factor[1]
    return node, _print_of(hashes), _print_of(other ^ (other >> np.uint64(32))), np.unique((hashes >> np.uint64(32)).astype("<u4")).tobytes(), cells


SKETCH = "doc_id long, text_key long, node long, fp long, fp2 long, shingles binary, cells array<long>"


def _sketches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sketch(t, k) for t in batch.column(2).to_pylist()]
        numbers = [pa.array(np.array([f[i] for f in found], np.uint64).view(np.int64)) for i in range(3)]
        cells = pa.array([f[4].view(np.int64) for f in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers, pa.array([f[3] for f in found], pa.binary()), cells], names=[f.split()[0] for f in SKETCH.split(", ")])


class Alike:
    """Whether sets of shingles, by their numbers, have a Jaccard similarity of SIMILARITY or more.

    Sets whose sizes rule it out, or whose fingerprints differ in more than APART of 128 bits, are not compared.
    """

    def __init__(self, points: np.ndarray, sets: list[np.ndarray]):
        self.points, self.sets, self.sizes = points, sets, np.array([len(s) for s in sets], np.int64)

    def __call__(self, rows: np.ndarray, row: int) -> np.ndarray:
        part, whole = SIMILARITY
        least, most = np.minimum(self.sizes[rows], self.sizes[row]), np.maximum(self.sizes[rows], self.sizes[row])
        near = (least * whole >= most * part) & (np.bitwise_count(self.points[rows] ^ self.points[row]).sum(axis=1, dtype=np.int64) <= APART)
        ask = rows[near]
        if len(ask):
            own, flat = self.sets[row], np.concatenate([self.sets[i] for i in ask])
            same = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            both = np.add.reduceat(same.astype(np.int64), np.concatenate(([0], np.cumsum(self.sizes[ask])[:-1])))
            near[near] = both * (whole + part) >= part * (self.sizes[ask] + self.sizes[row])
        return near


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join the alike nodes of each cell, from batches of (cell, node, fp, fp2, shingles) sorted by cell."""

    def out(rows: pa.Table) -> pa.RecordBatch:
        cells, nodes, fp, fp2 = (rows.column(i).to_numpy() for i in range(4))
        points = np.column_stack((fp, fp2)).view(np.uint64)
        data = rows.column(4)
        starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        found = []
        for start, stop in zip(starts, [*starts[1:], len(cells)]):
            sets = [np.frombuffer(d, "<u4") for d in data.slice(start, stop - start).to_pylist()]
            links = forest(np.arange(stop - start), Alike(points[start:stop], sets))
            found.extend((nodes[start + a], nodes[start + b]) for a, b in links)
        pairs = np.unique(np.array(found, np.int64).reshape(-1, 2), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column(0).to_numpy()
        cut = int(np.searchsorted(cells, cells[-1]))
        if cut == 0 and (not parts or parts[-1].column(0)[-1].as_py() == cells[0]):
            parts.append(batch)  # one cell fills the batch
            continue
        yield out(pa.Table.from_batches([*parts, batch.slice(0, cut)]))
        parts = [batch.slice(cut)]
    if parts:
        yield out(pa.Table.from_batches(parts))


def group_bounds(groups: int) -> list[tuple[int, int]]:
    """Segments [from, to) of each group."""
    cuts = [round(SEGMENTS * i / groups) for i in range(groups + 1)]
    return [*zip(cuts, cuts[1:])]


def cells_of(points: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, number of the point) rows: for each group the cells of the grid points within 1."""
    counts = [np.bitwise_count((points >> np.uint64(2 * s)) & np.uint64(3)).astype(np.int64) for s in range(SEGMENTS)]
    every = np.arange(len(points))
    cells, owners = [], []
    for g, (low, high) in enumerate(group_bounds(groups)):
        home = np.full(len(points), g << 56, np.int64)
        for s in range(low, high):
            home += counts[s] * 3 ** (s - low)
        cells.append(home)
        owners.append(every)
        for s in range(low, high):
            for step, fits in ((-1, counts[s] > 0), (1, counts[s] < 2)):
                cells.append(home[fits] + step * 3 ** (s - low))
                owners.append(every[fits])
    return np.concatenate(cells), np.concatenate(owners)


def _cells(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Rows of (fp, more columns) become rows of (cell, fp, more columns)."""
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(points), 4096):
            cells, owners = cells_of(points[at : at + 4096], groups)
            rows = pa.array(owners + at)
            yield pa.RecordBatch.from_arrays([pa.array(cells), *(c.take(rows) for c in batch.columns)], names=["cell", *batch.schema.names])


class Near:
    """Whether points are linked: rows of (fp) or of (fp, fp2) as uint64."""

    def __init__(self, distance: int, total: int | None = None):
        self.distance, self.total = distance, total

    def __call__(self, rows: np.ndarray, row: np.ndarray) -> np.ndarray:
        first = np.bitwise_count(rows[:, 0] ^ row[..., 0])
        near = first <= self.distance
        if self.total is not None:
            near &= first.astype(np.int64) + np.bitwise_count(rows[:, 1] ^ row[..., 1]) <= self.total
        return near


def forest(points: np.ndarray, near: Near) -> list[tuple[int, int]]:
    """Numbers of linked rows that join each component of points (distinct rows), found from pivots."""
    links = []
    rest = np.arange(len(points))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            pivot = queue.pop()
            hit = near(points[rest], points[pivot])
            if hit.any():
                found = rest[hit]
                rest = rest[~hit]
                links.extend((int(pivot), int(x)) for x in found)
                queue.extend(found)
    return links


def links_of(cells: np.ndarray, points: np.ndarray, nodes: np.ndarray, near: Near) -> np.ndarray:
    """Forest links, as pairs of nodes, of rows sorted by cell, each cell whole."""
    if len(cells) < 2:
        return np.empty((0, 2), np.int64)
    starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(cells)])))
    number = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat(sizes <= FEW, sizes)
    linked = np.zeros(len(starts), bool)  # small cells that hold a link
    for d in range(1, min(FEW, len(cells))):
        at = np.flatnonzero((cells[d:] == cells[:-d]) & small[d:])
        if not len(at):
            break
        at = at[near(points[at], points[at + d])]
        linked[number[at]] = True
    found = []
    for i in np.flatnonzero(linked | (sizes > FEW)):
        own = slice(starts[i], starts[i] + sizes[i])
        found.extend((nodes[own][a], nodes[own][b]) for a, b in forest(points[own], near))
    return np.unique(np.array(found, np.int64), axis=0) if found else np.empty((0, 2), np.int64)


def _links(batches: Iterator[pa.RecordBatch], near: Near) -> Iterator[pa.RecordBatch]:
    """Batches of (cell, fp[, fp2, node]) sorted by cell; rows of the last cell wait for the next batch."""

    def out(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)]
        points = np.column_stack(columns[1:3]).view(np.uint64) if len(columns) > 2 else columns[1].view(np.uint64).reshape(-1, 1)
        links = links_of(columns[0], points, columns[-1], near)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"])

    parts: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        if cut == 0 and (not parts or parts[-1][0][-1] == columns[0][0]):
            parts.append(columns)  # one cell fills the batch
            continue
        parts.append([c[:cut] for c in columns])
        yield out(parts)
        parts = [[c[cut:] for c in columns]]
    if parts:
        yield out(parts)


def fingerprints(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row of docs; fp is the fingerprint as a signed long."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(OnBatches(_fingerprints, k), "doc_id long, fp long")


def linked(points: DataFrame, distance: int = DISTANCE, total: int | None = None) -> DataFrame:
    """(a, b): links between rows of points(fp) or points(fp, fp2, node) whose components are those of all links.

    Rows are linked within ``distance`` of fp and, with a second fingerprint, within ``total`` of both together; a and
    b are fingerprints or nodes.
    """
    spark = points.sparkSession
    groups = distance // 3 + 1  # the fewest with distance // groups <= 2
    long_batches(spark)
    more = points.columns[1:]
    cells = points.distinct().mapInArrow(OnBatches(_cells, groups), ", ".join(f"{c} long" for c in ("cell", "fp", *more)))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(points, mb=1, least=1))
    dealt = cells.repartition(n, "cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(OnBatches(_links, Near(distance, total)), "a long, b long")


def near_groups(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs."""
    prints = checkpointed(fingerprints(docs, k, id_col, text_col))
    roots = connected_components(linked(prints.select("fp"), distance))
    by_print = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    placed = by_print.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "_root")
    of_print = joined_anew(placed, least, "root", "_root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(of_print, F.col("fp") == F.col("_fp")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


MEMBER = ("node", "fp", "fp2", "shingles")
LINK = "a long, b long"


def _sets_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(nodes, both fingerprints, shingles) of rows that hold MEMBER columns."""
    nodes, fp, fp2 = (table.column(c).to_numpy() for c in MEMBER[:3])
    return nodes, np.column_stack((fp, fp2)).view(np.uint64), [np.frombuffer(d, "<u4") for d in table.column("shingles").to_pylist()]


def _link_table(pairs: list[tuple[int, int]]) -> pa.Table:
    found = np.unique(np.array(pairs, np.int64).reshape(-1, 2), axis=0)
    return pa.table([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["a", "b"])


def _to_pivots(members: pa.Table, pivots: pa.Table) -> pa.Table:
    """Links of a piece of a hot cell to the cell's pivots: each set to the first pivot that it is alike to, and to one
    more, drawn by its node, which joins pivots that have common neighbours."""
    links: list[tuple[int, int]] = []
    if members.num_rows and pivots.num_rows:
        nodes, points, sets = _sets_of(members)
        own, more, their = _sets_of(pivots)
        order = np.argsort(own)
        near = Alike(np.concatenate((points, more[order])), sets + [their[i] for i in order])
        rest = np.arange(len(nodes))
        for k, pivot in enumerate(own[order].tolist()):
            asked = np.union1d(rest, np.flatnonzero(nodes.view(np.uint64) % np.uint64(len(own)) == np.uint64(k)))
            hit = asked[near(asked, len(nodes) + k)]
            links.extend((int(n), pivot) for n in nodes[hit])
            rest = np.setdiff1d(rest, hit)
    return _link_table(links)


def _to_rest(members: pa.Table, rest: pa.Table) -> pa.Table:
    """Links between a piece of a hot cell and those of its sets that lie in another component than most."""
    links: list[tuple[int, int]] = []
    if members.num_rows and rest.num_rows:
        nodes, points, sets = _sets_of(members)
        own, more, their = _sets_of(rest)
        label, other = members.column("label").to_numpy(), rest.column("label").to_numpy()
        near = Alike(np.concatenate((points, more)), sets + their)
        for k, node in enumerate(own.tolist()):
            asked = np.flatnonzero(label != other[k])
            links.extend((int(n), node) for n in nodes[asked[near(asked, len(nodes) + k)]])
    return _link_table(links)


def grid_cells(prints: DataFrame, distance: int = NEAR_DISTANCE) -> DataFrame:
    """(node, cell) for the nodes of prints whose fingerprints the grid joins: the cell is their component's."""
    roots = connected_components(linked(prints.select("fp"), distance)).select(F.col("node").alias("_fp"), "component")
    known = prints.select("node", "fp").distinct()
    several = known.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select(F.col("fp").alias("_fp"), F.col("fp").alias("component"))
    cells = roots.unionByName(several).distinct()
    return known.join(cells, F.col("fp") == F.col("_fp")).select("node", F.xxhash64("component", F.lit(3)).alias("cell"))


def alike(prints: DataFrame, hot: int = HOT_CELL, distance: int = NEAR_DISTANCE) -> DataFrame:
    """(a, b): links between the nodes of prints (rows of SKETCH) whose components are those of all alike sets that share a cell.

    A cell is a component of the grid join or a band of min-hashes. Cells with the same nodes are looked at once. A cell of more than ``hot`` sets is no task's alone: see _hot_links.
    """
    n = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), partitions_for(prints))
    banded = prints.select("node", F.explode("cells").alias("cell"))
    placed = banded.unionByName(checkpointed(grid_cells(prints, distance))).repartition(n, "cell").distinct()
    shared = placed.groupBy("cell").agg(F.count("*").alias("n"), F.bit_xor("node").alias("nodes")).where("n > 1")
    once = checkpointed(shared.groupBy("n", "nodes").agg(F.min("cell").alias("cell")).select("cell", "n"))
    cells = once.where(F.col("n") <= hot).select("cell")
    members = placed.join(cells, "cell", "left_semi").join(_sets(prints), "node").select("cell", *MEMBER)
    links = members.repartition(n, "cell").sortWithinPartitions("cell", "node").mapInArrow(_alike, LINK)
    large = once.where(F.col("n") > hot)
    return links if large.isEmpty() else _hot_links(placed, prints, large, checkpointed(links), hot)


def _sets(prints: DataFrame) -> DataFrame:
    """A row (MEMBER) for each node of prints."""
    return prints.groupBy("node").agg(*(F.first(c).alias(c) for c in MEMBER[1:]))


def _hot_links(placed: DataFrame, prints: DataFrame, large: DataFrame, links: DataFrame, hot: int) -> DataFrame:
    """links, and those of cells(cell, n) of more than hot sets, cut into pieces of about that many.

    1. Every set is compared with pivots of its cell. Near copies of one text are one component by these links.
    2. What lies in another component than most sets of its cell is compared with all of the cell's sets that are not in
       its own component. Two sets of one component need no link, so no pair that matters is left out.
    """
    pieces = large.withColumn("pieces", F.ceil(F.col("n") / hot).cast("int"))
    placed = checkpointed(placed.join(pieces.select("cell", "pieces"), "cell"))
    sets = checkpointed(_sets(prints.join(placed.select("node").distinct(), "node", "left_semi")))  # of hot cells only
    dealt = placed.withColumn("piece", F.pmod(F.xxhash64("node", F.lit(1)), F.col("pieces")).cast("int"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("node"), "node"))
    chosen = placed.withColumn("nth", rank).where(F.col("nth") <= PIVOTS)
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    anew = lambda *names: [F.col(c).alias(c) for c in names]  # noqa: E731  columns apart from those of the same frame
    pivots = chosen.join(sets, "node").withColumn("piece", every("pieces")).select(*anew("cell", "piece", *MEMBER))
    members = dealt.join(sets, "node")
    first = members.select("cell", "piece", *MEMBER).groupBy("cell", "piece").cogroup(pivots.groupBy("cell", "piece")).applyInArrow(_to_pivots, LINK)
    links = checkpointed(links.unionByName(first))
    roots = connected_components(links).select(F.col("node").alias("_node"), "component")
    labelled = checkpointed(dealt.join(roots, F.col("node") == F.col("_node"), "left").select("cell", "pieces", "piece", "node", F.coalesce("component", "node").alias("label")))
    counts = labelled.groupBy("cell", "label").agg(F.count("*").alias("n"))
    most = counts.groupBy("cell").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("n")).select("cell", F.col("m.label").alias("most"), F.ceil((F.col("n") - F.col("m.n")) / hot).cast("int").alias("lots"))
    open_ = most.where("lots > 0")
    if open_.isEmpty():
        return links
    joined = labelled.join(open_, "cell").join(sets, "node")
    keys = ["cell", "piece", "lot"]
    lot = F.pmod(F.xxhash64("node", F.lit(2)), F.col("lots")).cast("int")
    rest = joined.where("label <> most").withColumn("lot", lot).withColumn("piece", every("pieces")).select(*anew(*keys, *MEMBER, "label"))
    whole = joined.withColumn("lot", every("lots")).select(*keys, *MEMBER, "label")
    return links.unionByName(whole.groupBy(*keys).cogroup(rest.groupBy(*keys)).applyInArrow(_to_rest, LINK))


def drop_near(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_CELL) -> DataFrame:
    """docs without near copies: of each component of links the row with the smallest id stays; docs' own columns.

    Documents are linked if their sets of k-word shingles have a Jaccard similarity of 0.8 or more. Fingerprints of
    such documents differ by about 10 of 64 bits; the grid joins those within NEAR_DISTANCE, and what it joins, step by
    step, is compared. Farther pairs are compared where they share one of BANDS groups of BAND_ROWS min-hashes (6 in
    100,000 pairs at 0.8 share none, fewer above). Two SimHash
    fingerprints of the sets rule out most others (APART is far beyond the 19 of 128 bits expected at 0.8), and the
    rest are compared shingle by shingle. Rows equal in id and text stay or go together, in the row that has the
    smallest id; null ids come last.
    """
    spark = docs.sparkSession
    short_batches(spark)
    key = F.xxhash64(text_or_empty(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("text_key"), text_or_empty(text_col).alias("text"))
    prints = checkpointed(rows.mapInArrow(OnBatches(_sketches, k), SKETCH))
    roots = connected_components(alike(prints, hot)).withColumnRenamed("node", "_node")
    placed = prints.join(roots, F.col("node") == F.col("_node"), "left").select("doc_id", "text_key", F.coalesce("component", "node").alias("root"))
    ranked = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = placed.groupBy("root").agg(F.min(ranked).alias("first"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("root", "_root")
    gone = joined_anew(placed, first, "root", "_root").where(~F.struct("doc_id", "text_key").eqNullSafe(F.struct("first.doc_id", "first.text_key")))
    row, other = fresh(docs, "_row", "_gone")
    gone = gone.select(F.struct("doc_id", "text_key").alias(other)).distinct()
    keyed = docs.withColumn(row, F.struct(F.col(id_col).cast("long").alias("doc_id"), key.alias("text_key")))
    return keyed.join(gone, F.col(row).eqNullSafe(F.col(other)), "left_anti").drop(row)
