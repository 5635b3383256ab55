"""Review list of one batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import exception_id
from ..schemas import EXCEPTIONS, ID_COLUMN
from .assign import unmatched

_DETAILS = ["vendor_canonical", "vendor_id", "date", "amount_cents"]


def _rows(
    df: DataFrame, record_type: Column, record: Column, code: Column, severity: Column,
    message: Column, action: str, batch_id: str, created_at: str,
    related: Column | None = None, details: bool = True,
) -> DataFrame:
    types = {"amount_cents": "bigint"}
    shown = [
        (F.col(c) if details and c in df.columns else F.lit(None)).cast(types.get(c, "string")).alias(c)
        for c in _DETAILS
    ]
    related = F.lit("") if related is None else related
    batch = F.lit(batch_id)
    return df.select(
        batch.alias("batch_id"),
        exception_id(batch, record_type, record, code, related).alias("exception_id"),
        record_type.alias("record_type"),
        record.alias("record_id"),
        related.alias("related_record_id"),
        code.alias("exception_code"),
        severity.alias("severity"),
        message.alias("message"),
        F.lit(action).alias("recommended_action"),
        *shown,
        F.lit(created_at).alias("created_at_utc"),
    ).select(*EXCEPTIONS)


def from_flags(flags: DataFrame, batch_id: str, created_at: str) -> DataFrame:
    """One exception per flag; two flags of one code on a record stay two rows."""

    def text(name: str, default: str) -> Column:
        return F.when(F.coalesce(F.col(name), F.lit("")) == "", default).otherwise(F.col(name))

    return _rows(
        flags, text("record_type", ""), text("record_id", ""), text("flag_code", "QA_FLAG"),
        text("severity", "warning"), text("message", ""),
        "Review and correct source data or mapping/normalization rules.", batch_id, created_at,
    )


# Code, message and advice per unmatched record type.
UNMATCHED = {
    "transactions": (
        "UNMATCHED_TRANSACTION",
        "No matching vendor payment found.",
        "Investigate: missing payment, timing difference, amount mismatch, or vendor normalization gap.",
    ),
    "vendor_payments": (
        "UNMATCHED_VENDOR_PAYMENT",
        "No matching transaction found.",
        "Investigate: missing transaction feed, timing difference, amount mismatch, or vendor normalization gap.",
    ),
}


def from_unmatched(
    facts: DataFrame, matches: DataFrame, record_type: str, batch_id: str, created_at: str
) -> DataFrame:
    code, message, action = UNMATCHED[record_type]
    key = ID_COLUMN[record_type]
    return _rows(
        unmatched(facts, matches, key), F.lit(record_type), F.col(key), F.lit(code),
        F.lit("warning"), F.lit(message), action, batch_id, created_at,
    )


def from_low_confidence(
    matches: DataFrame, threshold: float, batch_id: str, created_at: str
) -> DataFrame:
    """Matches strictly below the threshold."""
    return _rows(
        matches.filter(F.col("match_score") < threshold), F.lit("transactions"), F.col("txn_id"),
        F.lit("LOW_CONFIDENCE_MATCH"), F.lit("warning"),
        F.format_string("Matched but low confidence (score=%.3f).", "match_score"),
        "Review candidate details; confirm or adjust matching thresholds/rules.",
        batch_id, created_at, related=F.col("pay_id"), details=False,
    )


def exceptions(
    flags: DataFrame | None, transactions: DataFrame, payments: DataFrame, matches: DataFrame,
    threshold: float, batch_id: str, created_at: str,
) -> DataFrame:
    """Flags, unmatched facts of both sides and weak matches, not de-duplicated."""
    parts = [from_flags(flags, batch_id, created_at)] if flags is not None else []
    parts += [
        from_unmatched(transactions, matches, "transactions", batch_id, created_at),
        from_unmatched(payments, matches, "vendor_payments", batch_id, created_at),
        from_low_confidence(matches, threshold, batch_id, created_at),
    ]
    return reduce(DataFrame.unionByName, parts)


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` exceptions by severity and code (ties by record)."""
    return (
        rows.orderBy("severity", "exception_code", "record_type", "record_id", "exception_id")
        .limit(n)
        .select("severity", "exception_code", "record_type", "message")
    )
