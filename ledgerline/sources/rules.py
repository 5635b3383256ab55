"""Alias and policy rule files: small, hand-kept, read once on the driver."""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..functions.text import WHITESPACE


@dataclass(frozen=True)
class AliasRule:
    """Case-insensitive pattern (Java syntax) -> canonical vendor."""

    pattern: str
    canonical: str


@dataclass(frozen=True)
class PolicyRule:
    flag_code: str
    field: str
    op: str
    value: str
    severity: str = "warning"
    message: str = ""
    applies_to: str = "both"


MAX_RULE_BYTES = 16 << 20


def _rows(spark: SparkSession, path: str) -> list[dict[str, str]]:
    """Rows of a rule file in file order; no file, no rules."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    size = fs.getFileStatus(target).getLen()
    if size > MAX_RULE_BYTES:
        raise ValueError(f"{path} has {size} bytes; a rule file is a small hand-kept list")
    text = spark.read.text(path, wholetext=True).first()
    content = text.value.removeprefix("\ufeff") if text else ""
    rows = csv.DictReader(io.StringIO(content, newline=""))
    return [{k: (v or "").strip(WHITESPACE) for k, v in r.items() if k} for r in rows]


def _valid(spark: SparkSession, pattern: str) -> bool:
    """One bad pattern would fail the whole job inside ``rlike``."""
    try:
        spark._jvm.java.util.regex.Pattern.compile(f"(?iu){pattern}")
    except Exception:
        return False
    return True


def load_aliases(spark: SparkSession, path: str) -> list[AliasRule]:
    """Rules in file order, without blank or invalid ones."""
    rows = [(r.get("pattern", ""), r.get("canonical_vendor", "")) for r in _rows(spark, path)]
    return [AliasRule(p, c) for p, c in rows if p and c and _valid(spark, p)]


def load_policy_rules(spark: SparkSession, path: str) -> list[PolicyRule]:
    return [
        PolicyRule(
            flag_code=r["flag_code"],
            field=r.get("field", ""),
            op=r.get("op", ""),
            value=r.get("value", ""),
            severity=r.get("severity") or "warning",
            message=r.get("message", ""),
            applies_to=r.get("applies_to") or "both",
        )
        for r in _rows(spark, path)
        if r.get("flag_code")
    ]
