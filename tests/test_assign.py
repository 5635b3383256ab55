"""Matching against a plain scan over all pairs, on small random feeds."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.config import Matching
from ledgerline.operators import assign as module
from ledgerline.operators import candidates as listing
from ledgerline.operators.assign import assign, unmatched
from ledgerline.operators.candidates import candidates, match_type
from ledgerline.operators.islands import with_islands

SCHEMA = "{} string, vendor_canonical string, date string, amount_cents bigint, source_file string, source_row_number bigint"
VENDORS = ["Red Widget", "Red Widget Group", "red widget", "Blue Gear", "Blue Gear Ltda", None]


def feeds(spark, seed, n, amounts, days, vendors=VENDORS):
    rng = random.Random(seed)

    def rows(prefix):
        out = [
            (f"{prefix}{i}", rng.choice(vendors), f"2025-01-{rng.randint(1, days):02d}",
             rng.choice(amounts), rng.choice(["a.csv", "b.csv"]), i)
            for i in range(n)
        ]
        rng.shuffle(out)
        return out

    return (
        spark.createDataFrame(rows("t"), SCHEMA.format("txn_id")),
        spark.createDataFrame(rows("p"), SCHEMA.format("pay_id")),
    )


def plain_scan(tx, pay, cfg):
    pairs = candidates(tx, pay, cfg, "b").collect()
    order_t = {r.txn_id: (r.source_file, r.source_row_number, r.txn_id) for r in tx.collect()}
    order_p = {r.pay_id: (r.source_file, r.source_row_number, r.pay_id) for r in pay.collect()}
    pairs.sort(key=lambda r: (-r.score, -r.vendor_sim, order_t[r.txn_id], order_p[r.pay_id]))
    used_t, used_p, out = set(), set(), []
    for r in pairs:
        if r.score >= cfg.min_score and r.txn_id not in used_t and r.pay_id not in used_p:
            used_t.add(r.txn_id)
            used_p.add(r.pay_id)
            out.append((r.txn_id, r.pay_id, r.score, r.date_diff_days, r.amount_diff_cents))
    return sorted(out)


def test_candidates_of_a_transaction_follow_each_other(spark):
    tx, pay = feeds(spark, 5, 60, [100, 200], 12)
    ids = [r.txn_id for r in candidates(tx, pay, Matching(), "b").collect()]
    order = {r.txn_id: (r.amount_cents, r.date) for r in tx.collect()}
    runs = [a for a, b in zip(ids, [*ids[1:], None]) if a != b]
    assert len(runs) <= 2 * len(set(ids))  # one for each date cell
    near = [order[a][0] == order[b][0] for a, b in zip(runs, runs[1:])]
    assert near.count(False) < 8  # cells of an amount, not the order of the transactions


@pytest.mark.parametrize("cfg", [Matching(amount_tolerance_cents=25), Matching(date_window_days=0)])
def test_candidates_are_all_pairs_within_the_bands(spark, monkeypatch, cfg):
    for name, most in (("BLOCK", 7), ("RUN", 3), ("PART_FACTS", 60), ("PART_PAIRS", 60)):
        monkeypatch.setattr(listing, name, most)
    tx, pay = feeds(spark, 8, 90, [100, 100, 110, 125, 300], 9)
    tx = tx.union(tx.limit(5)).union(tx.limit(1).withColumn("date", F.lit(None).cast("string")))  # repeated ids, no date
    near = lambda a, b, reach: abs(a - b) <= reach
    want = sorted(
        (t.txn_id, p.pay_id, int(p.date[-2:]) - int(t.date[-2:]), p.amount_cents - t.amount_cents)
        for t in tx.collect() if t.date for p in pay.collect()
        if near(t.amount_cents, p.amount_cents, cfg.amount_tolerance_cents)
        and (cfg.date_window_days == 0 or near(int(t.date[-2:]), int(p.date[-2:]), cfg.date_window_days)))
    got = candidates(tx, pay, cfg, "b").select("txn_id", "pay_id", "date_diff_days", "amount_diff_cents").collect()
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.parametrize("window", [0, 3])
def test_the_written_list_takes_little_room(spark, tmp_path, window):
    """40,000 payments of 40 amounts: with their ids written in full a row took 64 bytes or more."""

    def facts(n, name):
        k = F.col("id")
        day = F.date_add(F.lit("2025-01-01").cast("date"), (F.xxhash64(k, F.lit(name)) % 2).cast("int")).cast("string")
        return spark.range(n).select(
            F.sha2(F.concat(F.lit(name), k.cast("string")), 256).alias(name), F.concat(F.lit("Vendor "), (k % 7).cast("string")).alias("vendor_canonical"),
            day.alias("date"), (k % 40 * 100).alias("amount_cents"))

    listed = candidates(facts(1200, "txn_id"), facts(40_000, "pay_id"), Matching(date_window_days=window), "b")
    listed.write.option("compression", "snappy").parquet(str(tmp_path / "list"))
    assert spark.read.parquet(str(tmp_path / "list")).count() == 1_200_000
    assert sum(f.stat().st_size for f in (tmp_path / "list").glob("*.parquet")) < 8 * 1_200_000


def found(tx, pay, cfg, **kw):
    rows = assign(tx, pay, cfg, "b", "now", **kw).collect()
    return sorted((r.txn_id, r.pay_id, r.match_score, r.date_diff_days, r.amount_diff_cents) for r in rows)


@pytest.mark.parametrize(
    "seed,n,amounts,days,cfg,limit",
    [
        (1, 120, [100, 200, 300], 12, Matching(), 200_000),
        (2, 90, [100, 200], 6, Matching(), 60),
        (3, 50, [100], 4, Matching(), 0),
        (4, 80, [100, 103, 106, 110], 6, Matching(amount_tolerance_cents=4), 20),
        (5, 60, [100, 200], 8, Matching(date_window_days=0, min_score=0.65), 200_000),
        (6, 60, [100, 200], 8, Matching(min_score=0.2), 200_000),
        (7, 60, [-5, 0, 5], 9, Matching(date_window_days=2, amount_tolerance_cents=5, min_score=0.5), 0),
        (8, 150, range(-300, 300), 5, Matching(amount_tolerance_cents=7, min_score=0.5), 40),
        (9, 150, range(-300, 300), 5, Matching(amount_tolerance_cents=7, min_score=0.5), 0),
        (10, 120, range(0, 40), 3, Matching(amount_tolerance_cents=3, min_score=0.3), 25),
    ],
)
def test_equals_plain_scan(spark, seed, n, amounts, days, cfg, limit):
    tx, pay = feeds(spark, seed, n, amounts, days)
    expected = plain_scan(tx, pay, cfg)
    assert expected
    assert found(tx, pay, cfg, group_limit=limit) == expected


def chain(spark, length, tolerance=30_000):
    """Facts in a line of amounts, each within reach of its neighbours alone, nearer ones to the end."""
    cents, rows = 0, ([], [])
    for i in range(length + 1):
        rows[i % 2].append((f"{i:06d}", "Acme", "2025-01-01", cents, "a.csv", i))
        cents += tolerance - 2_000 - i
    return tuple(spark.createDataFrame(r, SCHEMA.format(c)).repartition(4) for r, c in zip(rows, ("txn_id", "pay_id")))


@pytest.mark.parametrize("length", [1, 2, 7, 10_000])
def test_chain_takes_few_rounds(spark, monkeypatch, length):
    rounds = []
    monkeypatch.setattr(module, "_ranked", lambda edges, ranked=module._ranked: rounds.append(1) or ranked(edges))
    tx, pay = chain(spark, length)
    got = {frozenset(r[:2]) for r in found(tx, pay, Matching(amount_tolerance_cents=30_000), group_limit=0)}
    assert got == {frozenset((f"{i - 1:06d}", f"{i:06d}")) for i in range(length, 0, -2)}
    assert len(rounds) <= 2


@pytest.mark.parametrize("seed,cfg,vendors,limit", [
    (11, Matching(date_window_days=1), VENDORS, 150),
    (12, Matching(date_window_days=2, amount_tolerance_cents=3, min_score=0.4), VENDORS[:2], 1200),
])
def test_runs_of_days_instead_of_rounds(spark, monkeypatch, seed, cfg, vendors, limit):
    """An amount above the limit is settled in runs of days; only what is open about the cuts goes on."""
    rounds, sizes = [], []
    ranked, runs = module._ranked, module._in_runs_of_days
    monkeypatch.setattr(module, "_ranked", lambda edges: rounds.append(edges.count()) or ranked(edges))
    monkeypatch.setattr(module, "_in_runs_of_days", lambda edges, *rest: sizes.append(edges.count()) or runs(edges, *rest))
    tx, pay = feeds(spark, seed, 250, [100, 102], 28, vendors)
    assert found(tx, pay, cfg, group_limit=limit) == plain_scan(tx, pay, cfg)
    assert sizes and sum(rounds) < sizes[0] // 4


def test_same_day_pairs_meet_by_day(spark, monkeypatch):
    """Without a window unlike names are joined on their day; only names alike enough meet on other days."""
    floors = []
    names, cells = module.similar_names, module.vendor_pairs
    monkeypatch.setattr(module, "similar_names", lambda t, p, floor: floors.append((floor, "any")) or names(t, p, floor))
    monkeypatch.setattr(module, "vendor_pairs", lambda t, p, c, floor, same: floors.append((floor, same)) or cells(t, p, c, floor, same))
    cfg = Matching(date_window_days=0, min_score=0.65, amount_tolerance_cents=2)
    tx, pay = feeds(spark, 14, 90, [100, 101, 200], 5, [*VENDORS, "Red Wagon"])
    assert found(tx, pay, cfg) == plain_scan(tx, pay, cfg)
    assert sorted((round(f, 3), how) for f, how in floors) == [(0.417, True), (0.917, "any")]


def test_tolerance_splits_into_many_parts(spark, monkeypatch):
    parts = []
    settle = module._settle_small
    monkeypatch.setattr(module, "_settle_small", lambda edges, *rest: parts.append(edges.select("part", "unit").distinct().collect()) or settle(edges, *rest))
    tx, pay = feeds(spark, 3, 400, range(0, 60_000, 7), 3)
    cfg = Matching(amount_tolerance_cents=20, min_score=0.5)
    assert found(tx, pay, cfg) == plain_scan(tx, pay, cfg)
    assert len({r.part for r in parts[0]}) > 1 and len({r.unit for r in parts[0]}) > 20


def test_islands(spark):
    rng = random.Random(6)
    rows = [(a, a + rng.randint(-9, 9)) for a in (rng.randint(-700, 700) for _ in range(90))]
    edges = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "t_cents bigint, p_cents bigint, i int")
    for block in (2, 5, 65_536):
        got = {r.i: r.island for r in with_islands(edges, 9, "island", block).collect()}
        cells, root = [{a // 19, b // 19} for a, b in rows], {}
        for pair in cells:
            low, high = min(pair), max(pair)
            root.setdefault(low, low), root.setdefault(high, high)
        for pair in sorted(cells, key=max):
            root[max(pair)] = root[min(pair)] if len(pair) == 2 else root[max(pair)]
        find = lambda c: c if root[c] == c else find(root[c])
        want = {i: find(min(pair)) for i, pair in enumerate(cells)}
        assert len(got) == len(rows) and len(set(want.values())) > 5
        assert {frozenset(i for i in got if got[i] == g) for g in got.values()} == {frozenset(i for i in want if want[i] == g) for g in want.values()}


def test_copies_match_in_source_order(spark):
    tx, pay = feeds(spark, 9, 300, [100], 1, ["Acme"])
    expected = plain_scan(tx, pay, Matching())
    assert len(expected) == 300
    assert found(tx, pay, Matching()) == expected
    assert found(tx, pay, Matching(), group_limit=0) == expected


def test_basic_match_and_unmatched(spark):
    tx = spark.createDataFrame([("t1", "Amazon", "2025-12-02", 4827), ("t2", "Uber", "2025-12-02", 1)],
                               "txn_id string, vendor_canonical string, date string, amount_cents bigint")
    pay = tx.filter("txn_id = 't1'").withColumnRenamed("txn_id", "pay_id")
    assert candidates(tx, pay, Matching(), "b1").count() == 1
    m = assign(tx, pay, Matching(), "b1", "now")
    assert [r.match_type for r in m.collect()] == ["exact"]
    assert [r.txn_id for r in unmatched(tx, m, "txn_id").collect()] == ["t2"]
    assert unmatched(pay, m, "pay_id").isEmpty()


def test_match_types(spark):
    rows = [(1.0, 0, 0), (1.0, -1, 0), (0.95, 2, 0), (0.95, 0, 5), (0.5, 0, 0)]
    df = spark.createDataFrame(rows, "s double, d int, a bigint")
    got = [r.m for r in df.select(match_type(F.col("s"), F.col("d"), F.col("a")).alias("m")).collect()]
    assert got == ["exact", "date_window", "vendor_fuzzy", "weak", "weak"]


def test_nothing_matches(spark):
    tx, pay = feeds(spark, 1, 3, [100], 2, ["Acme"])
    assert assign(tx, pay.withColumn("amount_cents", F.lit(7).cast("bigint")), Matching(), "b", "now").count() == 0


@pytest.mark.parametrize("seed,n,amounts,days,cfg,limit", [
    (23, 90, [100, 200], 9, Matching(date_window_days=0, min_score=0.65), 25),
    (24, 60, [100, 101], 6, Matching(date_window_days=0, min_score=0.5, amount_tolerance_cents=1, date_weight=0.1, amount_weight=0.3), 200_000),
])
def test_passes_equal_plain_scan(spark, seed, n, amounts, days, cfg, limit):
    tx, pay = feeds(spark, seed, n, amounts, days, [*VENDORS, "Red Wagon"])
    assert found(tx, pay, cfg, group_limit=limit, one_pass=0) == plain_scan(tx, pay, cfg)


def test_other_days_form_one_group(spark, monkeypatch):
    """Without a window facts of one name on days of their own took a round for each pair."""
    rounds = []
    monkeypatch.setattr(module, "_ranked", lambda edges, ranked=module._ranked: rounds.append(edges.count()) or ranked(edges))
    tx, pay = (spark.createDataFrame([(f"{i:02d}", "Acme", f"2025-{month}-{i + 1:02d}", 100, "a.csv", i) for i in range(24)],
                                     SCHEMA.format(c)) for month, c in (("01", "txn_id"), ("02", "pay_id")))
    cfg = Matching(date_window_days=0, min_score=0.65)
    assert found(tx, pay, cfg, group_limit=0, one_pass=0) == plain_scan(tx, pay, cfg)
    assert rounds == [1]


@pytest.mark.parametrize("twice", [False, True])
def test_places_by_file_and_line(spark, twice):
    """Files and lines alone make the numbers, in source order; only repeated ones are told apart by id."""
    rows = [(f, n, i) for i, (f, n) in enumerate([("b", 1), ("a", 3), ("b", 0), ("a", 1 << 39), ("", 7)])]
    rows += [("a", 3, 9)] if twice else []
    df = spark.createDataFrame([(*r, 100, 1, "Acme") for r in rows], "t_file string, t_line bigint, t_id int, t_cents bigint, t_day int, t_vendor string")
    got = module._placed(df, "t").collect()
    assert [r.t_id for r in sorted(got, key=lambda r: r.t_pos)] == [i for *_, i in sorted(rows)]
    assert twice or {r.t_id: r.t_pos for r in got}[3] - {r.t_id: r.t_pos for r in got}[1] == (1 << 39) - 3


def test_ids_are_not_written_and_come_back_as_they_are(spark, monkeypatch):
    """Numbered facts, groups and edges carry no ids; ids of any form are looked up for the pairs."""
    written = []
    keep = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: written.extend(df.columns) or keep(df, name))
    odd = ["00ff", "00FF", "abc", "ab\n", "", "\x00", "\u00e9a", "0" * 64]
    tx, pay = (spark.createDataFrame([(x, "Acme", f"2025-01-{i + 1:02d}", 100 * i, "a.csv", i) for i, x in enumerate(odd)],
                                     SCHEMA.format(c)) for c in ("txn_id", "pay_id"))
    got = [(r.txn_id, r.pay_id) for r in assign(tx, pay, Matching(), "b", "now").collect()]
    assert sorted(got) == sorted(zip(odd, odd))
    assert written and not {"t_id", "p_id"} & set(written)


def test_members_of_large_groups_by_blocks(spark, monkeypatch):
    """Only groups above a block go by blocks; all are numbered in source order."""
    monkeypatch.setattr(module, "BLOCK", 4)
    days = [1] * 9 + [2] * 3 + [3]
    rows = [(i * 3, 100, d, "Acme") for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "t_pos bigint, t_cents bigint, t_day int, t_vendor string")
    got = [tuple(r) for r in module._members(df, module._groups(df, "t"), "t").select("t_key", "t_pos", "t_rank", "t_block").collect()]
    want = [(0, 3 * i, i + 1, (i + 1) // 4) for i in range(9)] + [(27, 27 + 3 * i, i + 1, (i + 1) // 4) for i in range(3)]
    assert sorted(got) == want


def test_a_part_says_which_edges_stay_open():
    """What a payment that a neighbouring run may take leaves open needs no join with the pairs."""
    edge = dict(t_day=1, p_day=1, t_cents=5, p_cents=5, vendor_sim=1.0, score=1.0)
    edges = module.pd.DataFrame([
        dict(part=0, t_key=1, p_key=2, shared=False, t_n=1, p_n=2, t_done=0, p_done=0, **edge),
        dict(part=0, t_key=7, p_key=8, shared=True, t_n=1, p_n=1, t_done=0, p_done=0, **edge)])
    members = module.pd.DataFrame({"end": ["p", "p"], "key": [2, 2], "pos": [2, 4]})
    out = module._settle_part(edges, members)
    assert out[["t_pos", "p_pos", "open"]].values.tolist() == [[1, 2, False], [7, 8, True]]
