"""Pairs of transactions and payments close in amount and date, with their scores."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Matching
from ..functions.similarity import vendor_similarity
from ..functions.text import strip
from ..schemas import CANDIDATES
from ..session import materialize

# A file's dictionary holds about 15,000 ids.  Blocks of a cell, and facts of a task where that makes no more tasks than its
# pairs are worth, stay well below; other tasks are bounded by the pairs and facts they can hold.
BLOCK, PART_FACTS, PART_PAIRS = 4096, 8192, 1 << 18
MOST_PAIRS, MOST_FACTS = 1 << 24, 1 << 19
RUN = 256  # payments


def side(df: DataFrame, id_column: str, prefix: str) -> DataFrame:
    """The columns matching needs, prefixed; rows without date or amount cannot match."""
    have = set(df.columns)
    vendor = strip(F.coalesce(F.col("vendor_canonical").cast("string"), F.lit("")))
    columns = {
        "id": F.col(id_column),
        "vendor": vendor,
        "day": F.unix_date(F.col("date").try_cast("date")),
        "cents": F.col("amount_cents").cast("bigint"),
        "file": F.coalesce("source_file", F.lit("")) if "source_file" in have else F.lit(""),
        "line": F.coalesce(F.col("source_row_number").cast("bigint"), F.lit(0))
        if "source_row_number" in have
        else F.lit(0).cast("bigint"),
    }
    out = df.select(*[c.alias(f"{prefix}_{name}") for name, c in columns.items()])
    return out.filter(F.col(f"{prefix}_day").isNotNull() & F.col(f"{prefix}_cents").isNotNull())


def _cell(value: Column, width: int) -> Column:
    """Lower bound of the cell of ``width`` that holds the value."""
    return value - F.pmod(value, F.lit(width))


def _cells(value: Column, reach: int) -> Column:
    """The one or two cells of width 2 * reach + 1 that [value - reach, value + reach] meets."""
    width = 2 * reach + 1
    return F.explode(F.array_distinct(F.array(_cell(value - reach, width), _cell(value + reach, width))))


def with_cells(tx: DataFrame, pay: DataFrame, cfg: Matching, same_day: bool = False) -> tuple[DataFrame, DataFrame]:
    """Add join cells: a band becomes an equi-join that meets every pair exactly once.

    Each payment lies in one cell; each transaction probes the one or two cells its band
    touches.  A popular amount thus spreads over the dates instead of being one hash key.
    Without a date window there is one date cell; without tolerance the amount is the cell.
    For pairs of the ``same_day`` the day is the cell.
    """
    window, tol = cfg.date_window_days, cfg.amount_tolerance_cents
    one = F.lit(0)
    tx = tx.withColumn("cents_cell", _cells(F.col("t_cents"), tol) if tol else F.col("t_cents"))
    tx = tx.withColumn("day_cell", F.col("t_day") if same_day else _cells(F.col("t_day"), window) if window > 0 else one)
    pay = pay.withColumns(
        {
            "cents_cell": _cell(F.col("p_cents"), 2 * tol + 1),
            "day_cell": F.col("p_day") if same_day else _cell(F.col("p_day"), 2 * window + 1) if window > 0 else one,
        }
    )
    return tx, pay


def in_band(cfg: Matching) -> Column:
    """Exact residual of the cell join."""
    ok = F.lit(True)
    if cfg.date_window_days > 0:
        ok = ok & (F.abs(F.col("p_day") - F.col("t_day")) <= cfg.date_window_days)
    if cfg.amount_tolerance_cents > 0:
        ok = ok & (F.abs(F.col("p_cents") - F.col("t_cents")) <= cfg.amount_tolerance_cents)
    return ok


def score(sim: Column, days: Column, cents: Column, cfg: Matching) -> Column:
    """Weighted closeness, six places.  Without window or tolerance only equality counts."""

    def closeness(diff: Column, reach: int) -> Column:
        if reach <= 0:
            return F.when(diff == 0, 1.0).otherwise(0.0)
        return F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(diff) / F.lit(float(reach)))

    return F.round(
        sim * cfg.vendor_weight
        + closeness(days, cfg.date_window_days) * cfg.date_weight
        + closeness(cents, cfg.amount_tolerance_cents) * cfg.amount_weight,
        6,
    )


def similarity_floor(cfg: Matching) -> float:
    """Least vendor similarity with which a pair can reach ``min_score``; 0 if any can."""
    if cfg.vendor_weight <= 0:
        return 0.0
    rest = cfg.date_weight + cfg.amount_weight
    return max(0.0, (cfg.min_score - rest - 1e-6) / cfg.vendor_weight)


def vendor_pairs(tx: DataFrame, pay: DataFrame, cfg: Matching, floor: float = 0.0, same_day: bool = False) -> DataFrame:
    """Similarity of each distinct vendor pair that shares a cell, if at least ``floor``.

    Both sides shrink to distinct vendors per cell before the join, so copies and repeated
    purchases cost nothing, and the text comparison runs once per pair of names.  The result
    is written to the shared folder: its size decides how later joins run.
    """
    tx, pay = with_cells(tx, pay, cfg, same_day)
    cells = ["cents_cell", "day_cell"]
    tx, pay = tx.select("t_vendor", *cells), pay.select("p_vendor", *cells)
    if floor > 0:
        tx, pay = tx.filter("t_vendor <> ''"), pay.filter("p_vendor <> ''")
    pairs = tx.distinct().join(pay.distinct(), cells).select("t_vendor", "p_vendor").distinct()
    pairs = pairs.withColumn("vendor_sim", vendor_similarity(F.col("t_vendor"), F.col("p_vendor")))
    # filtered after the write: below it the filter would move under ``distinct`` and compare
    # the names of every pair instead of every distinct pair
    return materialize(pairs, "vendor-pairs").filter(F.col("vendor_sim") >= floor)


def _listed(
    facts: DataFrame, prefix: str, order: tuple[str, ...], cells: list[str], busy: DataFrame | None, keys: list[str], parts: int
) -> DataFrame:
    """One row for each block of a cell, with its facts as a list in the order: ``BLOCK`` of them or so at most.

    A cell of more facts goes by blocks of either side, and each block of one side meets all of the other's.
    """
    if busy is not None:
        own, other = ("t_block", "p_block") if prefix == "t" else ("p_block", "t_block")
        n = {b: F.coalesce(F.col(f"{b}s"), F.lit(1)).cast("int") for b in (own, other)}
        facts = facts.join(busy, cells, "left").withColumns({
            own: F.pmod(F.xxhash64(f"{prefix}_id"), n[own]).cast("int"), other: F.explode(F.sequence(F.lit(0), n[other] - 1))})
    listed = F.sort_array(F.collect_list(F.struct(*[f"{prefix}_{c}" for c in order])))
    return facts.repartition(parts, *keys).groupBy(*keys).agg(listed.alias(f"{prefix}_facts"))


def _met(tx: DataFrame, pay: DataFrame, cells: list[str]) -> DataFrame:
    """Facts that share a cell, as written: block by block, and for each run of a block's payments all transactions, each with the whole run."""
    n = {p: f.groupBy(*cells).agg(F.count("*").alias(f"{p}_n")) for p, f in (("t", tx), ("p", pay))}
    counted = n["t"].hint("merge").join(n["p"], cells, "full").na.fill(0, ["t_n", "p_n"])
    sizes = materialize(counted.select(
        *cells, "t_n", "p_n", *[F.greatest(F.lit(1), F.ceil(F.col(f"{p}_n") / BLOCK)).alias(f"{p}_blocks") for p in n]), "cells")
    total = sizes.agg(
        F.sum(F.col("t_n").cast("double") * F.col("p_n")).alias("pairs"), F.max(F.greatest("t_blocks", "p_blocks")).alias("blocks"),
        F.greatest(F.sum(F.col("t_n") * F.col("p_blocks")), F.sum(F.col("p_n") * F.col("t_blocks"))).alias("facts")).first()
    pairs, facts = total.pairs or 0.0, total.facts or 0
    parts = max(1, ceil(max(pairs / MOST_PAIRS, facts / MOST_FACTS, min(facts / PART_FACTS, pairs / PART_PAIRS))))
    keys, busy = cells, None
    if (total.blocks or 1) > 1:
        busy = materialize(sizes.where("t_blocks > 1 OR p_blocks > 1").select(*cells, "t_blocks", "p_blocks"), "busy-cells")
        keys = [*cells, "t_block", "p_block"]
    listed = _listed(tx, "t", ("vendor", "day", "cents", "id"), cells, busy, keys, parts).hint("merge").join(
        _listed(pay, "p", ("day", "vendor", "cents", "id"), cells, busy, keys, parts), keys)
    places = F.sequence(F.lit(1), F.size("p_facts"), F.lit(RUN))
    runs = listed.select("t_facts", F.explode(F.transform(places, lambda i: F.slice("p_facts", i, F.lit(RUN)))).alias("run"))
    return runs.select("run", F.inline("t_facts")).select("t_vendor", "t_day", "t_cents", "t_id", F.inline("run"))


def candidates(
    transactions: DataFrame, payments: DataFrame, cfg: Matching, batch_id: str
) -> DataFrame:
    """Every pair within the bands, scored: the stored list of candidates.

    The list holds each pair by definition, so its size is the number of pairs.  Matching does
    not read it; it works on groups of equal facts (see ``assign``).

    So that it takes little room, a task has few facts in proportion to its pairs, and their ids fit a
    file's dictionary; transactions of a vendor follow each other, each with the payments in the same order, so
    that numbers repeat within the reach of a page's compression.
    """
    tx, pay = side(transactions, "txn_id", "t"), side(payments, "pay_id", "p")
    pairs = vendor_pairs(tx, pay, cfg)
    cells = ["cents_cell", "day_cell"] if cfg.date_window_days > 0 else ["cents_cell"]  # a constant can't deal facts out
    met = _met(*with_cells(tx.drop("t_file", "t_line"), pay.drop("p_file", "p_line"), cfg), cells)
    joined = met.filter(in_band(cfg)).join(pairs, ["t_vendor", "p_vendor"])
    days, cents = F.col("p_day") - F.col("t_day"), F.col("p_cents") - F.col("t_cents")
    return joined.select(
        F.lit(batch_id).alias("batch_id"),
        F.col("t_id").alias("txn_id"),
        F.col("p_id").alias("pay_id"),
        "vendor_sim",
        days.alias("date_diff_days"),
        cents.alias("amount_diff_cents"),
        score(F.col("vendor_sim"), days, cents, cfg).alias("score"),
    ).select(*CANDIDATES)


def match_type(sim: Column, days: Column, cents: Column) -> Column:
    same_vendor, same_amount = sim >= 0.999, cents == 0
    return (
        F.when(same_vendor & same_amount & (days == 0), "exact")
        .when(same_vendor & same_amount & (F.abs(days) <= 1), "date_window")
        .when((sim >= 0.90) & same_amount, "vendor_fuzzy")
        .otherwise("weak")
    )
