"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks.  Block i of a source with target weight w (from 1) may be placed
from slot floor((i - 1) / w) on and must be placed before slot ceil(i / w); among the blocks
that may be placed, the one with the earliest deadline takes the next slot.  With weights that
sum to one every deadline is met, so after any number of slots a source has less than one block
more or less than its share.

Weights are exact ratios of whole numbers, so this holds for the target weights themselves after
any number of slots.  A phase ends where a source runs out, and the weights of the others are
scaled up.  One task hands out the slots, one for each block, in constant memory and a few
microseconds a slot, and writes them as a table; blocks are joined to it.  The driver holds and
broadcasts a row for each of at most ``MOST_SOURCES`` sources, whatever the number of documents.

Rows are numbered within a source without gathering it: hash buckets of about ``BUCKET`` rows
are counted, the counts are summed up, and rows are numbered within their bucket.

No row is dropped or repeated.  Defined results: null sources are one source; sources without a
positive weight follow after the others, by size; ties and repeated rows are ordered by the
given columns (rows equal in these are interchangeable); an empty table gives no rows; the other
columns stay, a new column gets another name if its name is taken.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import count, islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh
from ledgerline.session import materialize, ship_functions

ship_functions(__name__)

PERIOD = 1024
MOST_SOURCES = 256
BLOCK = 16
BUCKET = 2048


def shares(weights: dict, period: int = PERIOD) -> dict:
    """Exact slots of a period for each source, at least one; to look at one period, the mix goes by the weights themselves."""
    left, spare, slots = {s: Fraction(w) for s, w in weights.items()}, Fraction(period), {}
    while True:
        total = sum(left.values())
        small = [s for s, w in left.items() if w * spare < total]
        if not small:
            return slots | {s: w * spare / total for s, w in left.items()}
        for s in small:
            slots[s] = Fraction(1)
            del left[s]
        spare -= len(small)


def earliest_deadline_first(weights: list[int]) -> Iterator[int]:
    """The source of each slot, without end: the earliest deadline among released blocks, for exact weights."""
    total = sum(weights)
    waiting = [(0, k, 1) for k in range(len(weights))]
    ready: list[tuple[int, int, int]] = []
    for t in count():
        while waiting and waiting[0][0] <= t:
            _, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-i * total // weights[k]), k, i))
        deadline, k, i = heapq.heappop(ready)
        assert t < deadline, "a deadline is missed"
        yield k
        heapq.heappush(waiting, (i * total // weights[k], k, i + 1))


def schedule(slots: dict, period: int = PERIOD) -> dict[object, list[int]]:
    """For each source the places of its blocks within a period."""
    names = sorted(slots, key=str)
    places: dict[object, list[int]] = {s: [] for s in names}
    for t, k in enumerate(islice(earliest_deadline_first(whole([slots[s] for s in names])), period)):
        places[names[k]].append(t)
    return places


def whole(weights: list[float | Fraction]) -> list[int]:
    """Whole numbers in exactly the ratios of the weights."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*[w.denominator for w in exact])
    return [int(w * scale) for w in exact]


def slots_of(blocks: list[int], weights: list[float]) -> Iterator[tuple[int, int]]:
    """Source and block of each slot, until every source has run out; sources have blocks and positive weights."""
    used, ratios = [0] * len(blocks), whole(weights)
    active = list(range(len(blocks)))
    while active:
        for k in earliest_deadline_first([ratios[s] for s in active]):
            s = active[k]
            yield s, used[s]
            used[s] += 1
            if used[s] == blocks[s]:
                active.remove(s)
                break


def _slots(spark: SparkSession, groups: list[list[tuple[int, int, float]]]) -> DataFrame:
    """Rows _code, _block, _slot: the slot of each block; groups of (code, blocks, weight) follow one after the other."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            start = 0
            for codes, blocks, weights in [tuple(zip(*g)) for g in groups if g]:
                slots = slots_of(blocks, weights)
                while part := list(islice(slots, 50_000)):
                    columns = [[codes[s] for s, _ in part], [b for _, b in part], range(start, start + len(part))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["_code", "_block", "_slot"])
                    start += len(part)

    return materialize(spark.range(0, 1, 1, 1).mapInArrow(run, "_code long, _block long, _slot long"), "slots")


def mix(docs: DataFrame, source_col: str = "source", order_cols: tuple[str, ...] = ("doc_id",), weights: dict | None = None,
        power: float = 0.5, block: int = BLOCK) -> tuple[DataFrame, tuple[str, str]]:
    """The frame with the block number within the source and the position in the mix (from 0, with gaps); and their names.

    Without weights, a source's weight is its number of rows to the given power.
    """
    spark = docs.sparkSession
    block_name, position = fresh(docs, "block", "position")
    counts = {r[0]: r[1] for r in docs.groupBy(F.col(source_col).cast("string")).count().limit(MOST_SOURCES + 1).collect()}
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    target = {s: (weights.get(s, 0) if weights is not None else n ** power) for s, n in counts.items()}
    codes = {s: k for k, s in enumerate(sorted(counts, key=str))}
    blocks = {s: -(-n // block) for s, n in counts.items()}
    slots = _slots(spark, [[(codes[s], blocks[s], target[s]) for s in codes if target[s] > 0],
                           [(codes[s], blocks[s], counts[s]) for s in codes if not target[s] > 0]])
    # Structs of the source, so that a null source equals itself.
    key = F.struct(F.col(source_col).cast("string").alias("s"))
    sizes = spark.createDataFrame([((s,), codes[s], max(1, -(-n // BUCKET))) for s, n in counts.items()],
                                  "_source struct<s:string>, _code long, _buckets long")
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_source"), F.xxhash64(*order_cols).alias("_hash"))
    bucketed = rows.join(F.broadcast(sizes), "_source").select(  # at most MOST_SOURCES rows
        "_row", "_code", "_hash", F.pmod("_hash", "_buckets").alias("_bucket"))
    sums = Window.partitionBy("_code").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = bucketed.groupBy("_code", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_code", "_bucket", "_n", F.coalesce(F.sum("_n").over(sums), F.lit(0)).alias("_before"))
    # The slots of a bucket's blocks, which follow one another.
    first = F.floor(F.col("_before") / block)
    spans = before.select("_code", "_bucket", "_before", F.explode(
        F.sequence(first, F.floor((F.col("_before") + F.col("_n") - 1) / block))).alias("_block"))
    placed = spans.join(slots, ["_code", "_block"]).groupBy("_code", "_bucket", "_before").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_slot"))).alias("_slots"))
    within = F.row_number().over(Window.partitionBy("_code", "_bucket").orderBy("_hash", *[F.col("_row")[c] for c in order_cols]))
    # Dealt before the window takes what it orders by out of the rows, so that texts are shuffled once, not twice.
    numbered = bucketed.repartition("_code", "_bucket").withColumn("_within", within).join(placed, ["_code", "_bucket"]).select(
        "_row", "_slots", first.alias("_first"), (F.col("_before") + F.col("_within") - 1).alias("_n"),
    ).withColumn("_block", F.floor(F.col("_n") / block))
    slot = F.get("_slots", (F.col("_block") - F.col("_first")).cast("int"))["_slot"]
    return numbered.select(
        "_row.*", F.col("_block").cast("long").alias(block_name), (slot * block + F.pmod("_n", F.lit(block))).cast("long").alias(position),
    ), (block_name, position)
