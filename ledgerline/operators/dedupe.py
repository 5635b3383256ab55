"""One row per key, by source order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def keep_one(df: DataFrame, keys: Sequence[str] = ("batch_id", "row_hash"), last: bool = False) -> DataFrame:
    """First (or last) row per key in source order.

    ``row_number() = 1`` lets Spark put a WindowGroupLimit below the shuffle: each task sends
    at most one row per key, so a key whose copies are a third of all rows stays small.
    """
    order = [F.col("source_file"), F.col("source_row_number")]
    order = [c.desc() if last else c.asc() for c in order]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
