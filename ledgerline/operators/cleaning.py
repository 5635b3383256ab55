"""Typed date and amount with parse statuses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.parse import parse_cents, parse_date, parse_status
from .dedupe import keep_one


def clean(df: DataFrame, dedupe: bool = True, run_year: int | None = None) -> DataFrame:
    """Parse ``date_raw`` and ``amount_raw``; identical source rows collapse to the first.

    Two-digit years are read from the run's year, so that a batch cleaned again gives the same dates.
    """
    if dedupe and "row_hash" in df.columns:
        df = keep_one(df)
    day = parse_date(F.col("date_raw"), run_year)
    df = df.withColumns(
        {"_day": day, "amount_cents": parse_cents(F.col("amount_raw"))}
    ).withColumns(
        {
            "date": F.coalesce(F.col("_day").cast("string"), F.lit("")),
            "date_parse_status": parse_status(F.col("date_raw"), F.col("_day")),
            "amount_parse_status": parse_status(F.col("amount_raw"), F.col("amount_cents")),
        }
    ).drop("_day")
    bad_date = F.col("date_parse_status") != "ok"
    bad_amount = F.col("amount_parse_status") != "ok"
    return df.withColumns(
        {
            "clean_status": F.when(bad_date | bad_amount, "error").otherwise("ok"),
            "clean_notes": F.concat_ws(
                "; ",
                F.when(bad_date, F.concat(F.lit("date:"), "date_parse_status")),
                F.when(bad_amount, F.concat(F.lit("amount:"), "amount_parse_status")),
            ),
        }
    )
