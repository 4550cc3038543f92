"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training progress t in [0, 1]: a multiplier, linear between knots, whose mean
is 1. The integral of target * multiplier is the source's cumulative token demand; inverting it (a quadratic a
segment) gives the progress at which a document's first word is due. A document taken in several passes has a position
for each, one source size of demand after the other. Documents are range-sorted by position.

Targets are found by water-filling: sources share all words by weight, but none beyond ``most`` times its size; what
is cut off is shared again by weight. With caps c_i and weights w_i in the order of c_i / w_i, the level is the
largest of (total - caps before i) / (weights from i on), so one window over the sources finds it.

Within a source, documents are taken in the order of a digest of their id: ``floor(target / size)`` whole passes, then
one pass that stops at the word where the target is met; so every source's taken words are its rounded target.
Prefix sums are two-level (buckets of about BUCKET_ROWS rows, then rows in a bucket), so a source that holds a third
of all rows is never in one task.

Defined cases: null and empty texts have size 0 and take 0; a source without words has target 0; sources are ordered
by code point with null last; rows equal in id, source and size are interchangeable; rows with null id are drawn by
their texts; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baitline.llm.common import WORD, checkpointed, fresh, partitions_for

BUCKET_ROWS = 2048
#: Default schedules by the source's weight 1, 2, 3: knots of (t, multiplier), mean 1. Light sources fade, heavy ones grow.
SCHEDULES = {1: [(0.0, 1.5), (1.0, 0.5)], 2: [(0.0, 1.0), (1.0, 1.0)], 3: [(0.0, 0.5), (1.0, 1.5)]}
#: Positions are counted in billionths of the training run.
STEPS = 1_000_000_000


def segments(knots: list[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """(start, length, multiplier at start, slope) of each piece, scaled to mean 1; with the demand before it below."""
    if len(knots) < 2 or knots[0][0] != 0 or knots[-1][0] != 1 or any(b[0] <= a[0] for a, b in zip(knots, knots[1:])) or any(m < 0 for _, m in knots):
        raise ValueError("knots must run from 0 to 1 in order, with multipliers of 0 or more")
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    if area <= 0:
        raise ValueError("a schedule must be above 0 somewhere")
    out = []
    for a, b in zip(knots, knots[1:]):
        out.append((a[0], b[0] - a[0], a[1] / area, (b[1] - a[1]) / area / (b[0] - a[0])))
    return out


def due(share: Column, knots: list[tuple[float, float]]) -> Column:
    """Progress at which ``share`` (0 to 1) of a source's demand has been met: the inverse of the schedule's integral."""
    pieces = segments(knots)
    before, found = 0.0, None
    for start, length, level, slope in pieces:
        rest = share - F.lit(before)
        if slope == 0:
            at = F.lit(start) + (rest / F.lit(level) if level else F.lit(0.0))
        else:
            at = F.lit(start) + (F.sqrt(F.greatest(F.lit(level) * F.lit(level) + F.lit(2.0) * F.lit(slope) * rest, F.lit(0.0))) - F.lit(level)) / F.lit(slope)
        found = at if found is None else F.when(share >= F.lit(before), at).otherwise(found)
        before += length * level + slope * length * length / 2
    return F.least(F.greatest(found, F.lit(0.0)), F.lit(1.0))


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, rows, source_size, weight, target) from (source, rows, source_size); one row a source."""
    one = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    weights = F.element_at(F.array(*map(F.lit, cycle)), (F.row_number().over(one) - 1) % len(cycle) + 1)
    ranked = sizes.withColumn("rank", F.row_number().over(one)).withColumn("weight", weights.cast("long")).withColumn("most", F.col("source_size") * most)
    full = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "rank")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max("level").over(whole))
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")))
        .select("source", "rows", "source_size", "weight", "target")
    )


def _draw(id_col: str, text_col: str) -> Column:
    """A digest of a row's id (of its text, where it has none), of 60 bits."""
    of = F.coalesce(F.col(id_col).cast("long").cast("string"), F.col(text_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(of.cast("binary")), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3, schedules: dict[int, list[tuple[float, float]]] = SCHEDULES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, draw, source, size, source_size, target, taken, position, positions for every row of docs, in training order.

    positions holds the place of each pass in 1 / STEPS of the run, and position the first of them; rows of which
    nothing is taken have none and come last. draw is the digest that orders a source.
    """
    digest = _draw(id_col, text_col)
    size = F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)).cast("long")
    rows = checkpointed(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.coalesce(size, F.lit(0)).alias("size"), digest.alias("draw"))
    )
    plan = targets(rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size")), cycle, most)
    plan = checkpointed(plan)
    span = F.lit(float(1 << 60))
    placed = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))).select(
        "r.*", "source_size", "weight", "target", F.floor(F.col("draw") / span * F.ceil(F.col("rows") / BUCKET_ROWS)).alias("bucket")
    )
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words")).select("source", "bucket", F.coalesce(F.sum("words").over(order), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = local.alias("l").join(buckets.alias("b"), F.col("l.source").eqNullSafe(F.col("b.source")) & (F.col("l.bucket") == F.col("b.bucket"))).select("l.*", (F.col("b.ahead") + F.col("l.local")).alias("before"))
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    extra = F.least(F.greatest(goal - passes * F.col("source_size") - F.col("before"), F.lit(0)), F.col("size"))
    mixed = joined.withColumn("taken", passes * F.col("size") + extra)

    def place(nth: Column) -> Column:
        share = (F.col("before") + nth * F.col("source_size")) / F.col("target")
        at = due(share, [(0.0, 1.0), (1.0, 1.0)])
        for weight, knots in schedules.items():
            at = F.when(F.col("weight") == weight, due(share, knots)).otherwise(at)
        return F.floor(at * STEPS).cast("long")

    times = F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("long")
    places = F.when(times > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(times - 1, F.lit(0))), place)).otherwise(F.array().cast("array<long>"))
    mixed = mixed.withColumn("positions", places).withColumn("position", F.get("positions", F.lit(0)))
    last = F.coalesce(F.col("position"), F.lit(STEPS) + F.floor(F.col("draw") / span * STEPS))
    n = partitions_for(rows, mb=8)
    return (
        mixed.withColumn("turn", last)
        .repartitionByRange(n, "turn", "doc_id")
        .sortWithinPartitions("turn", "doc_id")
        .select("doc_id", "draw", "source", "size", "source_size", "target", "taken", "position", "positions")
    )


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with docs' own columns, whole documents only, in training order.

    A document comes once for each of its positions: as often as its taken words need, ceil(taken / size) times, so at
    most one document a source is taken further than its target; one of which nothing is taken is left out. Its copies
    stand where their passes are due. Where an id is repeated (or a text, without an id), each of its rows comes where
    the one comes that is first.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    own, drawn, places, turn, key = fresh(docs, "_mix_id", "_mix_draw", "_places", "_turn", "_draw")
    one = mix(docs, **options).where("taken > 0").groupBy(F.col("doc_id").alias(own), F.col("draw").alias(drawn)).agg(F.min_by("positions", F.struct("position", "size")).alias(places))
    keyed = docs.withColumn(key, _draw(id_col, text_col))
    joined = keyed.join(one, (F.col(key) == F.col(drawn)) & F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own)))
    n = partitions_for(docs, mb=8)
    out = joined.withColumn(turn, F.explode(places)).repartitionByRange(n, turn, own).sortWithinPartitions(turn, own)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
