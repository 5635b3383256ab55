"""Report tables of one batch.  Cents are summed as integers and divided once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_matched(transactions: DataFrame, matches: DataFrame) -> DataFrame:
    """Transactions with ``is_matched``; a transaction has one match at most."""
    ids = matches.select("txn_id", F.lit(True).alias("_hit"))
    return transactions.join(ids, "txn_id", "left").withColumn(
        "is_matched", F.col("_hit").isNotNull()
    ).drop("_hit")


def _usd(cents: str) -> Column:
    """Sum of cents in dollars; the sum is wider than a long."""
    return F.sum(F.col(cents).cast("decimal(28,0)")).cast("double") / F.lit(100.0)


def _measures() -> list[Column]:
    return [
        F.count("txn_id").alias("txn_count"),
        F.count_if("is_matched").alias("matched_count"),
        _usd("amount_cents").alias("spend_usd"),
    ]


def spend_by_month_vendor(flagged: DataFrame) -> DataFrame:
    """Spend per month and vendor; transactions without vendor are a group too."""
    return flagged.groupBy("batch_id", "month", "vendor_canonical").agg(*_measures()).orderBy(
        "month", F.desc("spend_usd"), "vendor_canonical"
    )


def match_rate_by_month(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("batch_id", "month").agg(*_measures()).withColumn(
        "match_rate", F.bround(F.col("matched_count") / F.col("txn_count"), 4)
    )


def exceptions_by_code(exceptions: DataFrame) -> DataFrame:
    return (
        exceptions.filter("batch_id is not null and exception_code is not null and severity is not null")
        .groupBy("batch_id", "exception_code", "severity")
        .agg(F.count("*").alias("exception_count"))
        .orderBy(F.desc("exception_count"), "exception_code", "severity")
    )


def top_vendors(transactions: DataFrame, n: int) -> DataFrame:
    """The ``n`` vendors with the highest spend; transactions without vendor do not count."""
    return (
        transactions.filter("vendor_canonical is not null")
        .groupBy("batch_id", "vendor_canonical")
        .agg(
            _usd("amount_cents").alias("spend_usd"),
            F.count("txn_id").alias("txn_count"),
        )
        .orderBy(F.desc("spend_usd"), "vendor_canonical")
        .limit(n)
    )


def matches_by_score(matches: DataFrame) -> DataFrame:
    """Matches, best score first (ties by transaction)."""
    return matches.orderBy(F.desc("match_score"), "txn_id", "pay_id")


def flags_by_severity(flags: DataFrame) -> DataFrame:
    """Flags by severity and code (ties by record)."""
    return flags.orderBy("severity", "flag_code", "record_type", "record_id")


def dashboard_kpis(match_rate: DataFrame, exceptions: DataFrame) -> DataFrame:
    """One row: the latest month's counts and match rate, and all exceptions of the batch."""
    latest = match_rate.agg(
        F.max("month").alias("latest_month"),
        F.max_by("txn_count", "month").alias("transactions"),
        F.max_by("matched_count", "month").alias("matched"),
        F.max_by("match_rate", "month").alias("match_rate"),
    )
    count = exceptions.agg(F.count("*").alias("exceptions")).scalar()
    return latest.withColumn("exceptions", count)
