"""Flags, exceptions and reports on small facts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import qa
from ledgerline.operators.exceptions import exceptions, preview
from ledgerline.operators.reports import (
    dashboard_kpis, exceptions_by_code, match_rate_by_month, spend_by_month_vendor, top_vendors, with_matched,
)
from ledgerline.sources.rules import PolicyRule

FACT = (
    "txn_id string, batch_id string, vendor_canonical string, vendor_id string, date string, month string, "
    "amount_cents bigint, is_weekend int, source_file string, source_row_number int, row_hash string"
)


def facts(spark, rows):
    """(id, vendor, date, cents)"""
    return spark.createDataFrame(
        [(i, "b", v, v or "", d, (d or "")[:7], a, 0, "f", n, f"h{n}") for n, (i, v, d, a) in enumerate(rows)], FACT
    )


@pytest.mark.parametrize("values", [
    list(range(1, 38)), [5] * 30, [-7, 3_000_000, 9_000_000] * 9, [1] * 99 + [10**12], [1], [0] * 20, [2**62 - i for i in range(30)] + [-2**62] * 3,
])
def test_percentile(spark, values):
    row = qa.percentile_99(spark.createDataFrame([(v,) for v in values], "amount_cents bigint")).first()
    assert row.n == len(values)
    assert float(row.thr100) / 100 == pytest.approx(np.percentile(values, 99), rel=1e-9, abs=1e-3)


def test_percentile_random(spark):
    rng = random.Random(1)
    for size in (25, 101, 400):
        values = [rng.choice([rng.randint(-10**9, 10**9), rng.randint(0, 50)]) for _ in range(size)]
        row = qa.percentile_99(spark.createDataFrame([(v,) for v in values], "amount_cents bigint")).first()
        assert float(row.thr100) / 100 == pytest.approx(np.percentile(values, 99), rel=1e-12, abs=0.006)


def test_outliers(spark):
    small = facts(spark, [("a", "V", "2025-01-01", 200_001), ("b", "V", "2025-01-01", 200_000)])
    got = qa.flag_rows(small, "transactions", qa.outlier_rules(small), "now").collect()
    assert [(r.record_id, r.message) for r in got] == [("a", "Amount is unusually high (threshold: 200000 cents).")]
    many = facts(spark, [(f"t{i}", "V", "2025-01-01", i) for i in range(1, 38)])
    got = qa.flag_rows(many, "transactions", qa.outlier_rules(many), "now").collect()
    assert [(r.record_id, r.message) for r in got] == [("t37", "Amount is unusually high (threshold: 36 cents).")]


def test_what_rules_read_is_worked_out_once(spark):
    df = facts(spark, [("a", "x", "2025-01-01", 1), ("b", None, "", 1)])
    df = df.withColumn("vendor_canonical", F.regexp_replace("vendor_canonical", "x+", ""))
    got = qa.flag_rows(df, "transactions", qa.missing_rules(), "now")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1
    assert sorted((r.record_id, r.flag_code) for r in got.collect()) == [("a", "MISSING_VENDOR"), ("b", "MISSING_DATE"), ("b", "MISSING_VENDOR")]


def test_duplicates_with_a_hot_group(spark):
    rows = [(f"h{i}", "Hot", "2025-01-01", 5) for i in range(700)]
    rows += [(f"p{i}", f"V{i // 2}", "2025-01-01", 5) for i in range(1000)] + [(f"s{i}", f"S{i}", "", 0) for i in range(400)]
    rows += [("n1", "N", None, 1), ("n2", "N", None, 1)]
    got = {r.record_id for r in qa.duplicate_flags(facts(spark, rows), "transactions", "now").collect()}
    assert got == {i for i, *_ in rows if i[0] in "hp"}


def test_policy(spark):
    df = facts(spark, [("a", "Acme", "2025-01-01", 60_000), ("b", None, "12", None)])

    def hits(field, op, value, **kw):
        rules = qa.policy_rules(df, "transactions", [PolicyRule("C", field, op, value, **kw)])
        return sorted(r.record_id for r in qa.flag_rows(df, "transactions", rules, "now").collect()) if rules else []

    assert hits("amount_cents", ">", "50000") == ["a"]
    assert hits("amount_cents", "!=", "60000") == ["b"]
    assert hits("amount_cents", "==", "60000") == ["a"]
    assert hits("vendor_canonical", "==", "Acme") == ["a"]
    assert hits("vendor_canonical", "!=", "Acme") == ["b"]
    assert hits("vendor_canonical", ">", "5") == []
    assert hits("date", "<=", "12") == ["b"]
    assert hits("month", "==", "12") == ["b"]
    assert hits("amount_cents", "~", "1") == [] and hits("nothing", ">", "1") == [] and hits("date", "", "1") == []
    assert hits("amount_cents", ">", "1", applies_to="vendor_payments") == []


def test_flags_exceptions_and_reports(spark):
    tx = facts(spark, [
        ("t1", "Acme", "2025-01-02", 500), ("t2", None, "2025-01-02", 300), ("t3", "Beta", "", 200), ("t4", "Acme", "2025-02-01", 100),
    ])
    pay = tx.filter("txn_id in ('t1', 't4')").withColumnRenamed("txn_id", "pay_id").withColumn("pay_id", F.translate("pay_id", "t", "p"))
    flags = qa.qa_flags(tx, pay, [PolicyRule("R", "amount_cents", "<", "150")], "now")
    assert sorted((r.record_id, r.flag_code) for r in flags.collect()) == [
        ("p4", "R"), ("t2", "MISSING_VENDOR"), ("t3", "MISSING_DATE"), ("t4", "R")]
    m = spark.createDataFrame([("t1", "p1", 0.8888), ("t4", "p4", 0.9)], "txn_id string, pay_id string, match_score double")
    exc = exceptions(flags, tx, pay, m, 0.9, "b", "now")
    got = sorted((r.exception_code, r.record_id, r.related_record_id, r.message[:45]) for r in exc.collect())
    assert ("LOW_CONFIDENCE_MATCH", "t1", "p1", "Matched but low confidence (score=0.889).") in got
    assert [g[:2] for g in got if g[0].startswith("UNM")] == [("UNMATCHED_TRANSACTION", "t2"), ("UNMATCHED_TRANSACTION", "t3")]
    assert preview(exc, 2).first().severity == "error"
    flagged = with_matched(tx, m)
    spend = [(r.month, r.vendor_canonical, r.txn_count, r.matched_count, r.spend_usd) for r in spend_by_month_vendor(flagged).collect()]
    assert spend == [("", "Beta", 1, 0, 2.0), ("2025-01", "Acme", 1, 1, 5.0), ("2025-01", None, 1, 0, 3.0), ("2025-02", "Acme", 1, 1, 1.0)]
    rate = match_rate_by_month(flagged)
    assert {r.month: r.match_rate for r in rate.collect()} == {"": 0.0, "2025-01": 0.5, "2025-02": 1.0}
    assert [(r.vendor_canonical, r.spend_usd) for r in top_vendors(tx, 1).collect()] == [("Acme", 6.0)]
    assert [r.exception_count for r in exceptions_by_code(exc).collect()] == [2, 2, 1, 1, 1]
    assert tuple(dashboard_kpis(rate, exc).first()) == ("2025-02", 1, 1, 1.0, 7)
