"""Islands of amounts: which amounts of open edges are linked, found without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

BLOCK = 65_536  # cells of a block


def _starts(borders: DataFrame, block: int) -> DataFrame:
    """Rows cell, start: for every cell whose lower border is crossed the first such cell of its run.

    Runs are found within blocks of cells; a block that is one run from its first cell on takes the
    start from the block before.  Only one row for each block is ordered as a whole.
    """
    within = Window.partitionBy("block").orderBy("cell")
    new = F.coalesce(F.lag("cell").over(within) != F.col("cell") - 1, F.lit(True))
    local = borders.withColumn("block", F.expr(f"(cell - pmod(cell, {block})) div {block}"))
    local = local.withColumn("new", F.when(new, F.col("cell")))
    local = materialize(local.withColumn("start", F.max("new").over(within)).drop("new"), "runs")
    ordered = Window.orderBy("block")
    blocks = local.groupBy("block").agg(F.min("cell").alias("first"), F.max("cell").alias("last"), F.max("start").alias("begun"))
    blocks = blocks.withColumn("goes_on", F.coalesce(F.lag("last").over(ordered) == F.col("first") - 1, F.lit(False)))
    known = F.when((F.col("begun") != F.col("first")) | ~F.col("goes_on"), F.col("begun"))
    blocks = blocks.withColumn("begun", F.last(known, ignorenulls=True).over(ordered))
    carried = F.when(F.col("goes_on"), F.lag("begun").over(ordered))
    blocks = blocks.select("block", "first", carried.alias("carried"))
    joined = local.join(blocks, "block")
    return joined.select("cell", F.when(F.col("start") == F.col("first"), F.coalesce("carried", "start")).otherwise(F.col("start")).alias("start"))


def with_islands(edges: DataFrame, tolerance: int, name: str, block: int = BLOCK) -> DataFrame:
    """Edges with one more column: a number for the island of linked amounts in which the edge lies.

    Amounts lie in cells wider than the tolerance, so an edge stays in its cell or crosses one border.
    Cells between which an edge crosses are one island; edges of different islands share no fact.
    """
    width = 2 * tolerance + 1
    cell = lambda c: F.expr(f"({c} - pmod({c}, {width})) div {width}")
    edges = edges.withColumns({"_t": cell("t_cents"), "_p": cell("p_cents")})
    borders = edges.where("_t <> _p").select(F.greatest("_t", "_p").alias("cell")).distinct()
    starts = materialize(_starts(borders, block), "islands")
    joined = edges.join(starts.withColumnRenamed("cell", "_t"), "_t", "left")
    return joined.withColumn(name, F.coalesce(F.col("start") - 1, F.col("_t"))).drop("_t", "_p", "start")
