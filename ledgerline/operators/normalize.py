"""Canonical vendor names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_blank, title_case, vendor_clean
from ..sources.rules import AliasRule
from .aliases import with_alias
from .dedupe import keep_one

# Confidence by method.
ALIAS_CONFIDENCE, FALLBACK_CONFIDENCE, MISSING_CONFIDENCE = 0.95, 0.60, 0.0


def canonicalize(df: DataFrame, rules: Sequence[AliasRule]) -> DataFrame:
    """Add the cleaned and canonical vendor with method, confidence and notes."""
    raw = F.col("vendor_raw")
    df = df.withColumn("vendor_clean", vendor_clean(raw))
    df = with_alias(df, rules, "_alias")
    blank, hit, rest = is_blank(raw), F.col("_alias").isNotNull(), F.col("vendor_clean") != ""
    return df.withColumns(
        {
            "vendor_canonical": F.when(blank, None)
            .when(hit, F.col("_alias.canonical"))
            .when(rest, title_case(F.col("vendor_clean"))),
            "vendor_norm_method": F.when(blank, "missing")
            .when(hit, "alias_regex")
            .when(rest, "clean_fallback")
            .otherwise("missing"),
            "vendor_norm_confidence": F.when(blank, MISSING_CONFIDENCE)
            .when(hit, ALIAS_CONFIDENCE)
            .when(rest, FALLBACK_CONFIDENCE)
            .otherwise(MISSING_CONFIDENCE),
            "vendor_norm_notes": F.when(blank, "vendor_raw empty")
            .when(hit, F.concat(F.lit("matched pattern: "), "_alias.pattern"))
            .when(rest, "no alias match; used cleaned vendor")
            .otherwise("vendor_clean empty"),
        }
    ).drop("_alias")


def normalize(
    df: DataFrame, rules: Sequence[AliasRule], normalized_at: str, dedupe: bool = True
) -> DataFrame:
    if dedupe and "row_hash" in df.columns:
        df = keep_one(df, last=True)
    if "vendor_raw" not in df.columns:
        df = df.withColumn("vendor_raw", F.lit(""))
    return canonicalize(df, rules).withColumn("normalized_at_utc", F.lit(normalized_at))
