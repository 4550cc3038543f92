"""Nearest neighbours by multiprobe p-stable hashing, with exact reranking.

Vectors are scaled to length 1, so the largest cosine is the smallest Euclidean distance. A table has functions
floor((a.x + b) / width) with Gaussian a; a bucket is the list of their values. A query visits its own bucket and the
buckets of PROBES perturbations by one step in some of the functions, in the order of their estimated chance of
success: the squared distances to the cell walls, sorted, have known expectations, so the best sets of walls (as ranks
in that order) are found once with a heap, and each query and table maps the ranks to its own walls.

The join goes by buckets. Rows are hashed once and dealt to parts by table and bucket; a query is sent once to each part
that holds a bucket it visits. There the candidates of all its buckets are merged and ranked by their exact cosine in
double precision, and the k best go on, to be merged over the parts. The number of functions of a table grows with the
logarithm of the rows, so the share of them that a query visits falls: each query goes to at most TABLES * PROBES parts,
however many there are. Buckets of more than BLOCK_ROWS rows are split by a digest of the ids, and their queries sent to
each piece; the list of such buckets is at most HOT_BUCKETS long, as the limit grows beyond.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
with null id; vectors of different lengths are not compared; a query for which the buckets hold fewer than k is compared with all
rows of its length, so it has fewer only where there are fewer; equal
cosines go to the smaller id; where an id is repeated, each of its rows is asked, none of its rows is a candidate for
it, and a candidate counts once with its best score; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baitline.llm.common import OnBatches, checkpointed, long_batches
from baitline.llm.repeats import M1, M2, M3, U, mix

TABLES = 3
WIDTH = 2.1
PROBES = 128
#: Functions a table: one for every BITS doublings of the rows, LEAST at least.
BITS, LEAST = 2.75, 4
BLOCK_ROWS = 8_192
HOT_BUCKETS = 1_000_000
QUERY_ROWS = 256  # queries looked up at a time
SEED = 20_240


@lru_cache(maxsize=4)
def probe_template(hashes: int, probes: int) -> np.ndarray:
    """(probes, 2 * hashes) 0/1: the sets of wall ranks in the order of their expected squared distances, the empty set first.

    Ranks j and 2 * hashes + 1 - j are the two walls of one function, so a set never holds both.
    """
    m = hashes
    j = np.arange(1, m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - (2 * m + 1 - np.arange(m + 1, 2 * m + 1)) / (m + 1) + (2 * m + 1 - np.arange(m + 1, 2 * m + 1)) * (2 * m + 2 - np.arange(m + 1, 2 * m + 1)) / (4 * (m + 1) * (m + 2))
    cost = np.concatenate((near, far))
    out = np.zeros((probes, 2 * m), np.int64)
    heap = [(cost[0], (0,))]
    row = 1
    while heap and row < probes:
        total, ranks = heapq.heappop(heap)
        if not any(2 * m - 1 - r in ranks for r in ranks):
            out[row, list(ranks)] = 1
            row += 1
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*ranks, last + 1)))
    return out[:row]


@lru_cache(maxsize=4)
def hash_functions(dim: int, tables: int, hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gaussian directions (tables, dim, hashes), offsets in widths, and odd multipliers that make a bucket's key."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((tables, dim, hashes))
    offsets = rng.random((tables, hashes))
    multipliers = rng.integers(-(2**62), 2**62, (tables, hashes), np.int64) | 1
    return directions, offsets, multipliers


def functions_for(rows: int) -> int:
    return max(LEAST, round(math.log2(max(rows, 2)) / BITS))


@dataclass
class Index:
    """The settings of the hash tables, the number of parts, and the buckets that are split (digests, sorted, and pieces)."""

    hashes: int
    parts: int
    tables: int = TABLES
    width: float = WIDTH
    probes: int = PROBES
    seed: int = SEED
    hot: np.ndarray = field(default_factory=lambda: np.empty(0, U))
    pieces: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def _digests(self, keys: np.ndarray, table: int, dim: int) -> np.ndarray:
        return mix(mix(keys.astype(np.int64).view(U) * M1 + U(table)) * M2 + U(dim))

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables): the digest of each row's bucket in each table."""
        directions, offsets, multipliers = hash_functions(unit.shape[1], self.tables, self.hashes, self.seed)
        keys = [np.floor(unit @ directions[t] / self.width + offsets[t]).astype(np.int64) @ multipliers[t] for t in range(self.tables)]
        return np.column_stack([self._digests(k, t, unit.shape[1]) for t, k in enumerate(keys)])

    def visited(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables * probes): the digests of the buckets that each query visits."""
        directions, offsets, multipliers = hash_functions(unit.shape[1], self.tables, self.hashes, self.seed)
        template = probe_template(self.hashes, self.probes)
        out = []
        for t in range(self.tables):
            place = unit @ directions[t] / self.width + offsets[t]
            cell = np.floor(place)
            walls = np.concatenate((place - cell, 1 - (place - cell)), axis=1)
            steps = np.concatenate((-multipliers[t], multipliers[t]))[np.argsort(walls, axis=1, kind="stable")]
            out.append(self._digests((cell.astype(np.int64) @ multipliers[t])[:, None] + steps @ template.T, t, unit.shape[1]))
        return np.concatenate(out, axis=1)

    def pieces_of(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.ones(buckets.shape, np.int64)
        at = np.minimum(np.searchsorted(self.hot, buckets), len(self.hot) - 1)
        return np.where(self.hot[at] == buckets, self.pieces[at], 1)

    def part(self, buckets: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return (mix(buckets * M3 + piece.astype(U)) % U(self.parts)).astype(np.int32)


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors in double precision) of each length in a column of lists."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum(column.value_lengths().to_numpy())
    size = np.diff(np.concatenate(([0], ends)))
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        yield rows, flat[(ends[rows] - dim)[:, None] + np.arange(dim)]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _bucket_rows(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """The buckets of (vec_id, vector), one row each."""
    for batch in batches:
        for _, vectors in _matrix(batch.column(1)):
            yield pa.RecordBatch.from_arrays([pa.array(index.buckets(unit_rows(vectors)).ravel().view(np.int64))], names=["bucket"])


def _dealt(batches: Iterator[pa.RecordBatch], index: Index, asks: bool) -> Iterator[pa.RecordBatch]:
    """(part, dim, asks, bucket, vec_id, vector): rows to their buckets' parts, or queries to all parts that they visit."""
    for batch in batches:
        ids, column = batch.column(0).to_numpy(), batch.column(1)
        for numbers, vectors in _matrix(column):
            for at in range(0, len(numbers), QUERY_ROWS):
                rows, unit = numbers[at : at + QUERY_ROWS], unit_rows(vectors[at : at + QUERY_ROWS])
                if asks:
                    buckets = index.visited(unit)
                    n = index.pieces_of(buckets)
                    owner, bucket = np.repeat(np.arange(len(rows)), n.sum(axis=1)), np.repeat(buckets.ravel(), n.ravel())
                    piece = np.arange(len(bucket)) - np.repeat(np.cumsum(n.ravel()) - n.ravel(), n.ravel())
                    owner, part = np.unique(np.column_stack((owner, index.part(bucket, piece))), axis=0).T
                    bucket = np.zeros(len(owner), np.int64)
                else:
                    bucket = index.buckets(unit)
                    digest = mix(ids[rows].astype(np.int64).view(U) * M2)[:, None]
                    part = index.part(bucket, (digest % index.pieces_of(bucket).astype(U)).astype(np.int64)).ravel()
                    owner, bucket = np.repeat(np.arange(len(rows)), index.tables), bucket.ravel().view(np.int64)
                take = rows[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), pa.array(np.full(len(take), vectors.shape[1], np.int32)), pa.array(np.full(len(take), asks)), pa.array(bucket), pa.array(ids[take]), column.take(pa.array(take))],
                    names=["part", "dim", "asks", "bucket", "vec_id", "vector"],
                )


def best_of(score: np.ndarray, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cosines) of the k best ids, ties to smaller ones, of rows whose cosine is about score (-inf: no candidate).

    The product that gave score may round equal rows apart; those that come near the k-th are scored row by row, which
    gives equal rows equal cosines.
    """
    some = 4 * k
    while True:
        some = min(some, len(score))
        near = np.argpartition(-score, some - 1)[:some]
        near = near[score[near] > -np.inf]
        distinct = ids[near[np.argsort(-score[near], kind="stable")]]
        _, first = np.unique(distinct, return_index=True)
        if len(first) >= k or some == len(score) or len(near) < some:
            break
        some *= 4
    if len(first) >= k:
        least = np.sort(score[near])[::-1][np.sort(first)[k - 1]]
        near = np.flatnonzero(score >= least - 1e-9)
    exact = (vectors[near] * query).sum(axis=1) / (norms[near] * np.sqrt((query * query).sum()))
    order = np.lexsort((ids[near], -exact))
    _, first = np.unique(ids[near][order], return_index=True)
    order = order[np.sort(first)[:k]]
    return ids[near][order], exact[order]


def _ranked(table: pa.Table, k: int, index: Index | None) -> pa.Table:
    """One part: the k best candidates of each query; without an index, every row is a candidate."""
    role = table.column("asks").to_numpy()
    ids = table.column("vec_id").to_numpy()
    out: list[tuple] = []
    rows, asks = np.flatnonzero(~role), np.flatnonzero(role)
    if len(rows) and len(asks):
        ((_, vectors),) = _matrix(table.column("vector").combine_chunks())
        if index is not None:
            bucket = table.column("bucket").to_numpy().view(U)
            rows = rows[np.argsort(bucket[rows], kind="stable")]
            bucket = bucket[rows]
        base, base_ids = vectors[rows], ids[rows]
        norms = np.sqrt((base * base).sum(axis=1))
        unit = base / norms[:, None]
        for at in range(0, len(asks), QUERY_ROWS):
            part = asks[at : at + QUERY_ROWS]
            unit_asks = unit_rows(vectors[part])
            score = unit_asks @ unit.T
            if index is not None:
                wanted = index.visited(unit_asks)
                low, high = np.searchsorted(bucket, wanted, "left"), np.searchsorted(bucket, wanted, "right")
                n = (high - low).ravel()
                hit = np.repeat(low.ravel() - (np.cumsum(n) - n), n) + np.arange(n.sum())
                seen = np.zeros(score.shape, bool)
                seen[np.repeat(np.arange(len(part)).repeat(wanted.shape[1]), n), hit] = True
                score[~seen] = -np.inf
            score[ids[part][:, None] == base_ids] = -np.inf
            for i, row in zip(part, score):
                found, exact = best_of(row, base_ids, base, norms, vectors[i], k)
                out.extend((ids[i], b, s) for b, s in zip(found.tolist(), exact.tolist()))
    columns = [*zip(*out)] or [[], [], []]
    return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])


def usable(vector: Column) -> Column:
    """Not null or zero, and all components finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(fine(x), F.lit(False))) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, hashes: int | None = None, **options) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which queries holds, against all other rows."""
    spark = vectors.sparkSession
    long_batches(spark, 4096)
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = checkpointed(own.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))))
    n = rows.count()
    plain, asked = rows.select("vec_id", "vector"), rows.where("asks").select("vec_id", "vector")
    index = Index(hashes or functions_for(n), 1, **options)
    index.parts = max(1, -(-n * index.tables // block_rows))
    limit = max(block_rows, -(-n * index.tables // HOT_BUCKETS))
    counts = plain.mapInArrow(OnBatches(_bucket_rows, index), "bucket long").groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    hot = sorted((r.bucket % (1 << 64), -(-r.n // limit)) for r in counts.collect())  # n * tables / limit rows at most
    index.hot, index.pieces = np.array([b for b, _ in hot], U), np.array([p for _, p in hot], np.int64)
    schema = f"part int, dim int, asks boolean, bucket long, vec_id long, vector {kind}"
    result = "query_id long, vec_id long, score double"
    dealt = plain.mapInArrow(OnBatches(_dealt, index, False), schema).unionByName(asked.mapInArrow(OnBatches(_dealt, index, True), schema))
    found = dealt.groupBy("part", "dim").applyInArrow(lambda group: _ranked(group, k, index), result)
    best = checkpointed(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    full = best.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"))
    short = checkpointed(asked.join(full, "vec_id", "left_anti"))
    if not short.isEmpty():
        best = best.unionByName(_against_all(plain, short, n, k, block_rows)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _against_all(rows: DataFrame, asked: DataFrame, n: int, k: int, block_rows: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each block of rows for the asked ones, which are the few that found too little."""
    blocks, ask_blocks = max(1, -(-n // block_rows)), max(1, -(-asked.count() // block_rows))
    deal = F.xxhash64("vec_id")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    base = rows.select("vec_id", "vector", F.lit(False).alias("asks"), F.pmod(deal, F.lit(blocks)).cast("int").alias("block"), every(ask_blocks).alias("ask_block"))
    asking = asked.select("vec_id", "vector", F.lit(True).alias("asks"), every(blocks).alias("block"), F.pmod(deal, F.lit(ask_blocks)).cast("int").alias("ask_block"))
    both = base.unionByName(asking).withColumn("dim", F.size("vector"))
    return both.groupBy("block", "ask_block", "dim").applyInArrow(lambda group: _ranked(group, k, None), "query_id long, vec_id long, score double")
