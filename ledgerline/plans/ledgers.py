"""Audit rows per stage and batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Matching


def _named(df: DataFrame, source: str, now_column: str, now: str, tables: tuple[str, str]) -> DataFrame:
    return df.withColumns({
        now_column: F.lit(now), "source_name": F.lit(source),
        "input_table": F.lit(tables[0]), "output_table": F.lit(tables[1]),
    })


def map_ledger(mapped: DataFrame, source: str, now: str) -> DataFrame:
    counts = mapped.groupBy("batch_id").agg(
        F.first("map_vendor_from").alias("vendor_col"), F.first("map_date_from").alias("date_col"),
        F.first("map_amount_from").alias("amount_col"), F.count("*").alias("row_count"),
        F.first("mapping_notes").alias("notes"),
    )
    return _named(counts, source, "mapped_at_utc", now, (f"stg_{source}_raw", f"stg_{source}_mapped"))


def clean_ledger(cleaned: DataFrame, source: str, now: str) -> DataFrame:
    counts = cleaned.groupBy("batch_id").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("clean_status") != "ok").alias("error_count")
    )
    return _named(counts, source, "cleaned_at_utc", now, (f"stg_{source}_mapped", f"clean_{source}"))


def normalize_ledger(norm: DataFrame, source: str, now: str, alias_file: str | None) -> DataFrame:
    hit = F.col("vendor_norm_method") == "alias_regex"
    counts = norm.groupBy("batch_id").agg(
        F.count("*").alias("row_count"), F.count_if(hit).alias("alias_match_count"),
        F.count_if(~hit).alias("no_match_count"),
    ).withColumn("alias_file", F.lit(alias_file).cast("string"))
    return _named(counts, source, "normalized_at_utc", now, (f"clean_{source}", f"norm_{source}"))


def model_ledger(fact: DataFrame, source: str, now: str) -> DataFrame:
    """A blank vendor id counts as one vendor."""
    counts = fact.groupBy("batch_id").agg(
        F.count("*").alias("row_count"), F.countDistinct("vendor_id").alias("distinct_vendor_count")
    )
    return _named(counts, source, "modeled_at_utc", now, (f"norm_{source}", f"fact_{source}"))


def match_ledger(
    tx: DataFrame, pay: DataFrame, matches: DataFrame, cfg: Matching, batch_id: str, now: str
) -> DataFrame:
    """Each fact has one match at most, so unmatched is facts minus matches."""
    total = F.count("*")
    return matches.agg(total.alias("match_count")).select(
        F.lit(batch_id).alias("batch_id"), F.lit(now).alias("matched_at_utc"),
        F.lit(cfg.date_window_days).alias("date_window_days"),
        F.lit(cfg.amount_tolerance_cents).alias("amount_tolerance_cents"),
        F.lit(cfg.min_score).alias("min_score"), "match_count",
        (tx.select(total).scalar() - F.col("match_count")).alias("unmatched_tx_count"),
        (pay.select(total).scalar() - F.col("match_count")).alias("unmatched_pay_count"),
    )


def qa_ledger(spark: SparkSession, batch_id: str, now: str, rules_path: str) -> DataFrame:
    return spark.createDataFrame([(batch_id, now, rules_path)], "batch_id string, qa_at_utc string, policy_rules_path string")


def exception_ledger(exceptions: DataFrame, batch_id: str, now: str) -> DataFrame:
    return exceptions.agg(F.count("*").alias("exception_count")).select(
        F.lit(now).alias("created_at_utc"), F.lit(batch_id).alias("batch_id"), "exception_count")


def report_ledger(spark: SparkSession, batch_id: str, now: str) -> DataFrame:
    return spark.createDataFrame([(now, batch_id)], "created_at_utc string, batch_id string")


def stage_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per stage table and batch."""
    return reduce(DataFrame.unionByName, [
        df.groupBy("batch_id").agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("stage"), "batch_id", "row_count")
        for name, df in tables.items()
    ])
