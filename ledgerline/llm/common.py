"""Column helpers shared by the text operators."""

from __future__ import annotations

import random
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as a pattern and as characters.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_array(text: Column) -> Column:
    """Words between white space; a text without words gives one empty string."""
    return F.split(F.trim(text, F.lit(SPACE_CHARS)), SPACE_PATTERN)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names that the frame doesn't have, so that extra columns never clash."""
    taken = {name.lower() for name in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_{random.Random(name).randrange(10**6)}"
        taken.add(name.lower())
        found.append(name)
    return found


def slices(batch: Any, column: str, most_bytes: int) -> Iterator[Any]:
    """Parts of an Arrow batch whose strings in the column have about so many bytes."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield batch.slice(start)
