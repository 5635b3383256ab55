"""Quality and policy flags on one batch of facts.

All flags take two scans of the facts.  The first groups them by vendor, date and amount: from these
counts come the duplicates, the percentile of amounts, the size of the batch and whether a text field
holds numbers.  The second works out all rules: each row carries an array of its flags, which ``inline``
unfolds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.parse import numeric
from ..functions.text import is_blank
from ..schemas import FLAGS, ID_COLUMN
from ..session import materialize
from ..sources.rules import PolicyRule

Rule = tuple[Column, str, str, Column]

# The outlier rule below its minimum row count.
SMALL_BATCH_ROWS, SMALL_BATCH_CENTS = 20, 200_000
_BIN_BITS = (42, 21)


def flag_rows(df: DataFrame, record_type: str, rules: Sequence[Rule], created_at: str) -> DataFrame:
    """One output row per rule (condition, code, severity, message) that a fact meets."""
    flags = F.array_compact(
        F.array(
            *[
                F.when(
                    cond,
                    F.struct(
                        F.lit(code).alias("flag_code"),
                        F.lit(severity).alias("severity"),
                        message.alias("message"),
                    ),
                )
                for cond, code, severity, message in rules
            ]
        )
    )
    kept = {c: F.col(c) if c in df.columns else F.lit(None).cast("string") for c in FLAGS[6:13]}
    kept["batch_id"] = F.col("batch_id") if "batch_id" in df.columns else F.lit("")
    # ``inline`` takes the expression: of a column it would infer a filter, which moves below all that the
    # rules read and works it out again for each use, parsers and all.
    found = df.select(
        F.col(ID_COLUMN[record_type]).alias("record_id"),
        *[c.alias(name) for name, c in kept.items()],
        F.inline(flags),
    )
    return found.withColumns(
        {"record_type": F.lit(record_type), "created_at_utc": F.lit(created_at)}
    ).select(*FLAGS)


# Codes, severities and messages of all rules in this module.
def missing_rules() -> list[Rule]:
    return [
        (is_blank(F.col("vendor_canonical")), "MISSING_VENDOR", "error",
         F.lit("Missing vendor after normalization.")),
        (is_blank(F.col("date")), "MISSING_DATE", "error", F.lit("Missing parsed date.")),
        (F.col("amount_cents").isNull(), "MISSING_AMOUNT", "error",
         F.lit("Missing parsed amount_cents.")),
    ]


def weekend_rules(df: DataFrame, record_type: str) -> list[Rule]:
    if record_type != "transactions" or "is_weekend" not in df.columns:
        return []
    return [
        (F.col("is_weekend").cast("string") == "1", "WEEKEND_TRANSACTION", "info",
         F.lit("Transaction date is on a weekend."))
    ]


def percentile_99(df: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: ``n`` and ``thr100``, a hundred times the exact 99th percentile.

    A row counts as often as ``weight`` says, once without one.

    The built-in exact percentile merges every distinct value in one task.  Here passes count
    rows per bin of 2**42 and then, within the bin that holds the wanted rank, of 2**21 cents; a
    last pass counts the values of that bin alone.  So every running sum sees at most 2**22 rows,
    whatever the amounts.  Linear interpolation at rank (n - 1) * 0.99 has two decimals, so it
    is done in integers.
    """
    times = F.col(weight) if weight else F.lit(1)
    cents = df.select(F.col("amount_cents").try_cast("bigint").alias("v"), times.cast("bigint").alias("w")).filter("v is not null and w > 0")
    picked, rows = None, cents
    for bits in _BIN_BITS:
        bins = rows.groupBy(F.shiftright("v", bits).alias("bin")).agg(F.sum("w").alias("c"), F.min("v").alias("low"))
        ranked = bins.selectExpr(
            "bin", "c", "sum(c) over () as n", "sum(c) over (order by bin) - c as before", "lead(low) over (order by bin) as next_low",
        )
        if picked is None:
            ranked = ranked.selectExpr("*", "((n - 1) * 99) div 100 as rank", "((n - 1) * 99) % 100 as rest")
        else:  # ranks and the next value count on from the wider bin
            ranked = ranked.withColumn("p", picked).selectExpr(
                "bin", "c", "p.n as n", "before + p.before as before", "coalesce(next_low, p.next_low) as next_low",
                "p.rank as rank", "p.rest as rest")
        chosen = ranked.filter("rank >= before and rank < before + c")
        picked = chosen.select(F.struct("bin", "before", "rank", "rest", "next_low", "n").alias("p")).scalar()
        rows = cents.filter(F.shiftright("v", bits) == picked.getField("bin"))
    values = (
        rows.groupBy("v").agg(F.sum("w").alias("c"))
        .selectExpr("v", "c", "sum(c) over (order by v) - c as upto", "lead(v) over (order by v) as next_v")
        .withColumn("p", picked)
        .selectExpr("*", "p.rank - p.before as r")
        .filter("r >= upto and r < upto + c")
    )
    # the next rank holds the same value, the next value of the bin, or the next bin's lowest
    upper = F.when(F.col("r") + 1 < F.col("upto") + F.col("c"), F.col("v")).otherwise(
        F.coalesce("next_v", "p.next_low", "v")
    )
    low, high = _wide(F.col("v")), _wide(upper)
    return values.select(
        F.col("p.n").alias("n"), _wide(low * 100 + (high - low) * _wide(F.col("p.rest"))).alias("thr100")
    )


def _wide(c: Column) -> Column:
    """Whole numbers that a hundred times the largest amount fits."""
    return c.cast("decimal(38,0)")


def outlier_rules(df: DataFrame, weight: str | None = None) -> list[Rule]:
    """Strictly above the 99th percentile of the frame's amounts, or above a fixed amount in a small batch."""
    thr100 = percentile_99(df, weight).select(
        F.when(F.col("n") < SMALL_BATCH_ROWS, _wide(F.lit(SMALL_BATCH_CENTS * 100))).otherwise(F.col("thr100")).alias("t")
    ).scalar()
    message = F.format_string(
        "Amount is unusually high (threshold: %d cents).",
        F.call_function("div", thr100, _wide(F.lit(100))),
    )
    return [
        (_wide(F.col("amount_cents").try_cast("bigint")) * 100 > thr100, "AMOUNT_OUTLIER", "warning", message)
    ]


def _wanted(value: str) -> float | None:
    """The number that a rule compares with; none if the value is text."""
    try:
        wanted = float(value)
    except ValueError:
        return None
    return wanted if wanted == wanted else None


def _may_be_text(df: DataFrame, field: str, value: str) -> bool:
    """Whether a rule needs to know if any entry of the field is numeric."""
    return _wanted(value) is not None and not isinstance(df.schema[field].dataType, T.NumericType)


def _has_numbers(field: str) -> Column:
    return F.coalesce(F.bool_or(numeric(F.col(f"`{field}`")).isNotNull()), F.lit(False))


def compare(df: DataFrame, field: str, op: str, value: str, any_number: Column | None = None) -> Column:
    """``field op value``: as numbers when the value and any entry are numeric, else as text.

    Text knows == and != only.  A missing entry is unequal to every number.  ``any_number`` says
    whether an entry is numeric where that is known already.
    """
    c = F.col(f"`{field}`")
    text = F.coalesce(c.cast("string"), F.lit("None"))
    as_text = {"==": text == value, "!=": text != value}.get(op, F.lit(False))
    wanted = _wanted(value)
    if wanted is None:
        return as_text
    typed = not _may_be_text(df, field, value)
    n = c.cast("double") if typed else numeric(c)
    as_number = {
        ">": n > wanted, ">=": n >= wanted, "<": n < wanted, "<=": n <= wanted,
        "==": n == wanted, "!=": F.coalesce(n != wanted, F.lit(True)),
    }.get(op)
    if as_number is None:
        return as_text
    if typed:
        return as_number
    if any_number is None:
        any_number = df.select(_has_numbers(field)).scalar()
    return F.when(any_number, as_number).otherwise(as_text)


def _applied(df: DataFrame, record_type: str, rules: Sequence[PolicyRule]) -> list[PolicyRule]:
    return [r for r in rules if r.applies_to in ("both", record_type) and r.field in df.columns and r.op]


def policy_rules(
    df: DataFrame, record_type: str, rules: Sequence[PolicyRule], numbers: dict[str, Column] | None = None
) -> list[Rule]:
    """Conditions of the rules that apply; ``numbers`` says of fields whether an entry is numeric."""
    return [
        (
            compare(df, r.field, r.op, r.value, (numbers or {}).get(r.field)), r.flag_code, r.severity,
            F.lit(r.message or f"Policy rule hit: {r.field} {r.op} {r.value}"),
        )
        for r in _applied(df, record_type, rules)
    ]


_DUPLICATE_KEYS = ("vendor_id", "date", "amount_cents")


def _groups(df: DataFrame, record_type: str, fields: Sequence[str] = ()) -> DataFrame:
    """Facts by vendor, date and amount: ids, rows, and whether text fields hold numbers.  One scan, written."""
    known = [_has_numbers(f).alias(f"numbers_{i}") for i, f in enumerate(fields)]
    return materialize(df.groupBy(*_DUPLICATE_KEYS).agg(
        F.count(ID_COLUMN[record_type]).alias("n"), F.count("*").alias("rows"), *known), "fact-groups")


def _mark_duplicates(df: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """Add whether a fact shares vendor, date and amount with another.

    A group is hot when it holds over a thousandth of the batch, so there are fewer than a thousand
    hot groups: a bounded table that is broadcast.  Facts of the other groups join by their key; the
    hot ones get a number that no group has, so they spread over all tasks.
    """
    keys = list(_DUPLICATE_KEYS)
    groups = groups.filter(" and ".join(f"{k} is not null" for k in keys))
    share = groups.select((F.sum("rows") / 1000).alias("s")).scalar()
    hot = groups.filter(F.col("n") > F.greatest(share, F.lit(1))).select(*keys, F.lit(True).alias("_hot"))
    others = groups.filter((F.col("n") > 1) & (F.col("n") <= share)).select(*keys, F.lit(0).alias("_spread"), F.lit(True).alias("_other"))
    spread = F.when(F.col("_hot"), -1 - F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("int")).otherwise(0)
    marked = df.join(F.broadcast(hot), keys, "left").withColumn("_spread", spread).join(others, [*keys, "_spread"], "left")
    return marked.withColumn(name, F.coalesce("_hot", "_other", F.lit(False))).drop("_hot", "_other", "_spread")


# Code, severity and message.
def duplicate_rules(marked: str) -> list[Rule]:
    return [(F.col(marked), "DUPLICATE_LIKELY", "warning", F.lit("Potential duplicate: same vendor, date, and amount."))]


def duplicate_flags(df: DataFrame, record_type: str, created_at: str) -> DataFrame:
    """Facts that share vendor, date and amount."""
    marked = _mark_duplicates(df, _groups(df, record_type), "_duplicate")
    return flag_rows(marked, record_type, duplicate_rules("_duplicate"), created_at)


def qa_flags(
    transactions: DataFrame | None,
    payments: DataFrame | None,
    rules: Sequence[PolicyRule],
    created_at: str,
) -> DataFrame:
    """All flags of both record types, not de-duplicated."""
    parts = []
    for record_type, df in (("transactions", transactions), ("vendor_payments", payments)):
        if df is None:
            continue
        fields = list(dict.fromkeys(r.field for r in _applied(df, record_type, rules) if _may_be_text(df, r.field, r.value)))
        groups = _groups(df, record_type, fields)
        numbers = {f: groups.select(F.coalesce(F.bool_or(f"numbers_{i}"), F.lit(False))).scalar() for i, f in enumerate(fields)}
        row_rules = [
            *missing_rules(), *weekend_rules(df, record_type), *outlier_rules(groups, "rows"),
            *policy_rules(df, record_type, rules, numbers), *duplicate_rules("_duplicate"),
        ]
        parts.append(flag_rows(_mark_duplicates(df, groups, "_duplicate"), record_type, row_rules, created_at))
    return reduce(DataFrame.unionByName, parts)
