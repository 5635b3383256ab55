"""Vendor dimension and fact tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import record_id, vendor_id
from ..functions.text import is_blank
from ..schemas import FACT_TAIL, FACT_TYPES, ID_COLUMN, ID_TAG
from .dedupe import keep_one


def date_fields(df: DataFrame) -> DataFrame:
    """Month, year and weekend flag of the ISO ``date``; blank or 0 without a date."""
    day = F.col("date").try_cast("date")
    iso = day.cast("string")
    return df.withColumns(
        {
            "month": F.coalesce(F.substring(iso, 1, 7), F.lit("")),
            "year": F.coalesce(F.substring(iso, 1, 4), F.lit("")),
            "is_weekend": F.coalesce(F.when(F.weekday(day) >= 5, 1), F.lit(0)),
        }
    )


def build_dim(norms: list[DataFrame], existing: DataFrame | None, created_at: str) -> DataFrame:
    """Vendors not yet in the dimension.

    Distinct before the shuffle; case variants share one id and keep the smallest spelling.
    """
    names = reduce(DataFrame.unionByName, [n.select("vendor_canonical") for n in norms])
    names = names.filter(~is_blank(F.col("vendor_canonical"))).distinct()
    new = (
        names.groupBy(vendor_id(F.col("vendor_canonical")).alias("vendor_id"))
        .agg(F.min("vendor_canonical").alias("vendor_canonical"))
    )
    if existing is not None:
        new = new.join(existing.select("vendor_id"), "vendor_id", "left_anti")
    return new.withColumn("created_at_utc", F.lit(created_at))


def empty_fact(spark: SparkSession, record_type: str) -> DataFrame:
    """The fact table of a side that a batch has no feed for."""
    columns = ", ".join(f"`{c}` {FACT_TYPES.get(c, 'string')}" for c in FACT_TAIL)
    return spark.createDataFrame([], f"{ID_COLUMN[record_type]} string, {columns}")


def build_fact(df: DataFrame, record_type: str, dedupe: bool = True) -> DataFrame:
    """Fact rows.  The vendor id is computed, not looked up: the dimension holds the same hash.

    An amount that did not parse is 0 and a blank currency is USD, as in the feeds' contract.
    """
    if dedupe and "row_hash" in df.columns:
        df = keep_one(df)
    defaults = {
        name: F.lit("")
        for name in FACT_TAIL
        if name not in df.columns and name not in ("month", "year", "is_weekend", "vendor_id")
    }
    defaults.update(
        {
            "currency": F.when(F.col("currency") == "", "USD").otherwise(F.col("currency"))
            if "currency" in df.columns
            else F.lit("USD"),
            "amount_cents": F.coalesce(F.col("amount_cents").try_cast("bigint"), F.lit(0))
            if "amount_cents" in df.columns
            else F.lit(0).cast("bigint"),
        }
    )
    if "vendor_canonical" not in df.columns:
        defaults["vendor_canonical"] = F.lit(None).cast("string")
    df = date_fields(df.withColumns(defaults))
    df = df.withColumns(
        {"vendor_id": vendor_id(F.col("vendor_canonical")), ID_COLUMN[record_type]: record_id(ID_TAG[record_type])}
    )
    return df.select(ID_COLUMN[record_type], *FACT_TAIL)
