"""CSV exports for readers outside the cluster."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import list_files, scan_texts, survey
from .store import partition_value

# The published datasets.
DATASETS = (
    "qa_flags", "matches", "unmatched_transactions", "unmatched_vendor_payments", "exceptions",
    "rpt_spend_by_month_vendor", "rpt_match_rate_by_month", "rpt_exceptions_by_code",
    "rpt_top_vendors",
)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header, written in parallel."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def snapshot_name(now: str, batch_id: str) -> str:
    """``<time>__<batch>``: 2025-12-26T22:59:57+00:00 becomes 20251226T225957Z0000.

    A negative offset has an M in the place of the Z; a time without offset counts as UTC.
    """
    time = datetime.fromisoformat(now)
    minutes = int((time.utcoffset() or timedelta()).total_seconds()) // 60
    sign, (hours, rest) = "M" if minutes < 0 else "Z", divmod(abs(minutes), 60)
    return f"{time:%Y%m%dT%H%M%S}{sign}{hours:02d}{rest:02d}__{batch_id}"


def export_stages(frames: dict[str, DataFrame], root: str) -> list[str]:
    """Stage tables of one batch as CSV folders, one for each name."""
    for name, df in frames.items():
        write_csv(df, f"{root}/{name}")
    return [f"{root}/{name}" for name in frames]


def publish(frames: dict[str, DataFrame], root: str, batch_id: str, now: str, mode: str) -> list[str]:
    """Write one batch's datasets: ``latest`` under stable names, ``history`` as snapshots."""
    if mode not in ("latest", "history"):
        raise ValueError("mode must be 'latest' or 'history'")
    written = []
    for name in DATASETS:
        if name not in frames:
            continue
        path = f"{root}/latest/{name}"
        if mode == "history":
            path = f"{root}/history/{name}/{name}__{partition_value(snapshot_name(now, batch_id))}"
        df = frames[name]
        if "batch_id" in df.columns:
            df = df.filter(F.col("batch_id") == batch_id)
        write_csv(df, path)
        written.append(path)
    return written


def combine_folder(spark: SparkSession, folder: str) -> DataFrame | None:
    """All CSV files of all snapshots in a folder, appended by column name.

    Each file's own header counts, so snapshots with other columns line up.
    """
    files = [f for f in list_files(spark, f"{folder.rstrip('/')}/*/*") + list_files(spark, f"{folder.rstrip('/')}/*")
             if re.search(r"\.csv$", f.path, re.IGNORECASE)]
    parts = [
        rows.select(*[F.col(f"_c{i}").alias(name) for i, name in enumerate(header)])
        for header, rows in scan_texts(spark, survey(spark, files))
    ]
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
