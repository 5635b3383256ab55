"""CSV files whose quoted fields span lines, read by many tasks.

Each task reads the lines of its blocks and works out, for a block that begins outside a quoted field and
for one that begins inside, how each line ends.  A line keeps the state, flips it or sets it, so all lines
before it come to one of these three as well, and so do whole blocks: a running composition over the blocks
of a file gives the state in which each begins, and with it where records start.  Records of one line are
parsed where they are; only lines of longer ones are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import materialize, ship_functions

ship_functions(__name__)

MOST_LINES = 1 << 20  # of a record: more mean that a quote is missing


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after a line that begins inside or outside one.

    A quote opens a field only at its start; after its closing quote all up to the comma is text.
    """
    at = 0
    if not inside:
        inside = line.startswith('"')
        at = 1
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
        at = line.find(',"', at if inside else 0)
        if at < 0:
            return False
        inside, at = True, at + 2


def _compose(block: np.ndarray, from_outside: np.ndarray, from_inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line, what the lines before it in its block do to the state: set it (0, 1; -1: not), else flip it or not."""
    flips = (from_outside & ~from_inside).astype(np.int64)
    sets = from_outside == from_inside
    n = len(block)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if n else np.empty(0, np.int64)
    begin = np.repeat(first, np.diff([*first, n]))
    before = np.concatenate([[0], np.cumsum(flips)])[:-1]
    place = np.maximum.accumulate(np.where(sets, np.arange(n), -1)) if n else np.empty(0, np.int64)
    last_set = np.concatenate([[-1], place])[:-1]
    known = last_set >= begin
    since = before - before[np.where(known, last_set, begin)]
    value = from_outside[np.where(known, last_set, 0)].astype(np.int64) if n else np.empty(0, np.int64)
    return np.where(known, (value + since) % 2, -1), since % 2


def _lines(spark: SparkSession, paths: list[str], path: Column) -> DataFrame:
    """Lines with their place, what the lines before them in the block do, and how they end themselves."""
    text = F.when((F.col("_metadata.file_block_start") == 0) & F.startswith("value", F.lit("\ufeff")), F.substring("value", F.lit(2), F.length("value"))).otherwise(F.col("value"))
    read = spark.read.option("lineSep", "\n").text(paths).select(
        path.alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_order"), text.alias("value"))

    def run(batches):
        import pyarrow as pa

        name, tail = None, (False, True)  # the block of the last line, and what it did so far: keep the state
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [f"{p}\n{b}" for p, b in zip(batch.column("_path").to_pylist(), batch.column("_block").to_pylist())]
            codes = np.cumsum([0] + [a != b for a, b in zip(names[1:], names)])
            texts = batch.column("value").to_pylist()
            out, inside = (np.array([ends_inside(t, s) if '"' in t else s for t in texts], bool) for s in (False, True))
            ends = [pa.array(out), pa.array(inside)]
            goes_on = names[0] == name
            if goes_on:  # the lines before, in earlier batches, count as one line
                codes, out, inside = np.concatenate([[0], codes]), np.concatenate([[tail[0]], out]), np.concatenate([[tail[1]], inside])
            fixed, flip = _compose(codes, out, inside)
            after = [bool(x) for x in (_after(fixed[-1], flip[-1], s, out[-1], inside[-1]) for s in (False, True))]
            name, tail = names[-1], tuple(after)
            skip = int(goes_on)
            yield pa.RecordBatch.from_arrays([*batch.columns, *ends, pa.array(fixed[skip:], pa.int32()), pa.array(flip[skip:], pa.int32())],
                                             names=[*batch.schema.names, "out", "in", "fixed", "flip"])

    schema = T.StructType([*read.schema.fields, *[T.StructField(c, T.BooleanType()) for c in ("out", "in")],
                           *[T.StructField(c, T.IntegerType()) for c in ("fixed", "flip")]])
    return materialize(read.mapInArrow(run, schema), "lines")


def _after(fixed: int, flip: int, begin: bool, out: bool, inside: bool) -> bool:
    state = bool(fixed) if fixed >= 0 else begin != bool(flip)
    return inside if state else out


def _state(fixed: Column, flip: Column, begin: Column) -> Column:
    return F.when(fixed >= 0, fixed == 1).otherwise(begin != (flip == 1))


def _block_states(lines: DataFrame) -> DataFrame:
    """Rows _path, _block, begin: whether each block of each file begins inside a quoted field."""
    last = lines.groupBy("_path", "_block").agg(F.max_by(F.struct("fixed", "flip", "out", "in"), "_order").alias("l"))
    ends = {}
    for begin in (False, True):
        state = _state(F.col("l.fixed"), F.col("l.flip"), F.lit(begin))
        ends[begin] = F.when(state, F.col("l.in")).otherwise(F.col("l.out"))
    ends_as = last.select("_path", "_block", ends[False].alias("a"), ends[True].alias("b"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.when(F.col("a") & ~F.col("b"), 1).otherwise(0)
    ran = ends_as.withColumn("flips", F.sum(flips).over(upto))
    held = F.last(F.when(F.col("a") == F.col("b"), F.struct(F.col("a").cast("int").alias("v"), F.col("flips").alias("f"))), ignorenulls=True).over(before)
    flipped = F.coalesce(F.max("flips").over(before), F.lit(0))
    ran = ran.withColumns({"held": held, "flipped": flipped})
    begin = (F.coalesce(F.col("held.v"), F.lit(0)) + F.col("flipped") - F.coalesce(F.col("held.f"), F.lit(0))) % 2 == 1
    return ran.select("_path", "_block", begin.alias("begin"))


def scan_records(spark: SparkSession, paths: list[str], header: Sequence[str], path: Column) -> DataFrame:
    """Text columns plus _path and source_row_number of files with quoted line breaks.

    Blanks stay ``""``; a row with more fields than the header raises an error.
    """
    lines = _lines(spark, paths, path)
    lines = lines.join(materialize(_block_states(lines), "block-states"), ["_path", "_block"])
    state = _state(F.col("fixed"), F.col("flip"), F.col("begin"))
    lines = lines.select("_path", "_block", "_order", "value", (~state).alias("starts"), F.when(state, F.col("in")).otherwise(F.col("out")).alias("open"))
    whole = lines.where("starts AND NOT open").select("_path", "_block", "_order", "value")
    # The record of a line begins at the last start before it, in its block or an earlier one.
    parts = materialize(lines.where("NOT starts OR open"), "parts")
    within = Window.partitionBy("_path", "_block").orderBy("_order")
    start = F.last(F.when(F.col("starts"), F.struct("_block", "_order")), ignorenulls=True)
    latest = parts.where("starts").groupBy("_path", "_block").agg(F.max(F.struct("_block", "_order")).alias("last"))
    blocks = parts.select("_path", "_block").distinct().join(latest, ["_path", "_block"], "left")
    carried = F.last("last", ignorenulls=True).over(Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = materialize(blocks.select("_path", "_block", carried.alias("carried")), "carried")
    placed = parts.withColumn("start", start.over(within)).join(blocks, ["_path", "_block"]).withColumn("start", F.coalesce("start", "carried"))
    too_many = F.raise_error(F.concat(F.lit(f"a record has more than {MOST_LINES} lines, a quote may be missing: "), F.col("_path")))
    sized = placed.groupBy("_path", "start").agg(F.count("*").alias("n")).where(F.col("n") > MOST_LINES)
    checked = placed.join(sized, ["_path", "start"], "left").withColumn("value", F.when(F.col("n").isNotNull(), too_many.cast("string")).otherwise(F.col("value")))
    joined = checked.groupBy("_path", "start").agg(F.array_sort(F.collect_list(F.struct("_block", "_order", "value"))).alias("lines"))
    several = joined.select("_path", "start._block", "start._order", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value"))
    records = whole.unionByName(several).withColumn("value", F.regexp_replace("value", r"\r\z", "")).where("value <> ''")
    surplus = "_surplus"
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, surplus]])
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "multiLine": "true"}  # line ends within quotes stay
    fields = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    numbered = records.withColumn("source_row_number", F.row_number().over(Window.partitionBy("_path", "_block").orderBy("_order")).cast("bigint"))
    numbered = materialize(numbered, "records")
    sizes = numbered.groupBy("_path", "_block").agg(F.max("source_row_number").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.col("source_row_number") + F.col("before") - 1  # the header is no row
    parsed = numbered.join(materialize(sizes.select("_path", "_block", before.alias("before")), "blocks"), ["_path", "_block"]).select(
        "_path", number.alias("source_row_number"), fields.alias("f")).where("source_row_number > 0")
    too_long = F.raise_error(F.concat(F.lit("a row has more fields than the header, "), F.col(f"f.{surplus}"), F.lit(" among them: "), F.col("_path")))
    checked = F.when(F.col(f"f.{surplus}").isNotNull(), too_long.cast("string"))
    return parsed.select(
        *[F.coalesce(*([checked] if i == 0 else []), F.col(f"f.{name}"), F.lit("")).alias(name) for i, name in enumerate(header)],
        "_path", "source_row_number")
