"""Hash keys."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .text import json_string, strip


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def row_hash(columns: Mapping[str, str]) -> Column:
    """Hash of one source row as JSON of original header -> value, keys sorted.

    ``columns`` maps the original header to the column that holds its value, so the hash
    does not depend on how headers were sanitised.  A missing value is JSON ``null``.
    """
    parts = []
    for header in sorted(columns):
        key = json.dumps(header, ensure_ascii=False)
        value = F.coalesce(json_string(F.col(f"`{columns[header]}`")), F.lit("null"))
        parts.append(F.concat(F.lit(f"{key}: "), value))
    return sha256(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")))


def vendor_id(canonical: Column) -> Column:
    """Id of a canonical vendor, ``""`` where there is none; case does not matter."""
    name = F.lower(strip(canonical))
    return F.when(
        canonical.isNotNull() & (name != ""), sha256(F.concat(F.lit("vendor|"), name))
    ).otherwise("")


def record_id(tag: str) -> Column:
    """Fact id from batch, kind of record, row hash and row number."""
    return sha256(
        F.concat_ws(
            "|", "batch_id", F.lit(tag),
            F.coalesce("row_hash", F.lit("")),
            F.coalesce(F.col("source_row_number").cast("string"), F.lit("")),
        )
    )


def exception_id(batch: Column, kind: Column, record: Column, code: Column, related: Column) -> Column:
    return sha256(F.concat_ws("|", batch, kind, record, code, related))
