"""Canonical vendor, date and amount columns from whatever headers a feed has."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..config import ColumnMapping
from ..functions.text import sanitize_name

# Header names tried when nothing configured is present.
FALLBACK = ColumnMapping(
    vendor_raw=("vendor_raw", "merchant", "vendor", "payee", "supplier"),
    date_raw=("date_raw", "post_date", "entry_date", "date", "transaction_date"),
    amount_raw=("amount_raw", "amount", "amt", "payment_amount", "transaction_amount"),
)


def pick_column(existing: Iterable[str], candidates: Sequence[str]) -> str | None:
    """First candidate present, by sanitised name, then by the name as written."""
    present = set(existing)
    names = [sanitize_name(c) for c in candidates] + list(candidates)
    return next((n for n in names if n in present), None)


def map_source(df: DataFrame, mapping: ColumnMapping | None) -> DataFrame:
    """Add the three canonical columns, where they came from, and a status.

    Status and notes are constant per source, as they depend on the header only.
    """
    mapping = mapping or ColumnMapping()
    picked = {
        name: pick_column(df.columns, getattr(mapping, name))
        or pick_column(df.columns, getattr(FALLBACK, name))
        for name in ("vendor_raw", "date_raw", "amount_raw")
    }
    notes = [
        f"Missing {name.removesuffix('_raw')} column mapping"
        for name, source in picked.items()
        if source is None
    ]
    added = {
        name: F.col(f"`{source}`") if source else F.lit("") for name, source in picked.items()
    }
    for name, source in picked.items():
        added[f"map_{name.removesuffix('_raw')}_from"] = F.lit(source or "")
    added["mapping_status"] = F.lit("error" if notes else "ok")
    added["mapping_notes"] = F.lit("; ".join(notes))
    return df.withColumns(added)
