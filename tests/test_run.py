"""A whole project on three rows per feed, and the file scans."""

import zipfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.config import DEFAULT_SOURCES, Project
from ledgerline.plans.ledgers import stage_counts
from ledgerline.plans.runs import Run
from ledgerline.sources.files import ingest, unique_headers
from ledgerline.sources.publish import combine_folder, snapshot_name
from ledgerline.sources.rules import load_aliases, load_policy_rules
from ledgerline.sources.store import Store

NOW = "2025-12-26T22:59:57+00:00"

# The four sample files.
TRANSACTIONS = """Transaction ID,Post Date,Transaction Date,Merchant,Amount,Currency,Card Last4,Memo
T1001,2025-12-02,2025-12-01,AMZN Mktp US*2H3K21,48.27,USD,1234,Laptop stand
T1002,2025-12-03,2025-12-03,UBER TRIP HELP.UBER.COM,17.90,USD,1234,Client visit
T1003,2025-12-05,2025-12-05,STARBUCKS #04921 MADISON,6.45,USD,5678,
"""
PAYMENTS = """Entry ID,Entry Date,Payee,Amount,Category,Account,Cost Center,Reference,Description
L9001,2025-12-02,Amazon,48.27,Office Supplies,6100,IT,,Amazon purchase
L9002,2025-12-03,Uber,17.90,Travel,6200,Sales,,Ride to client
L9003,2025-12-05,Starbucks,6.45,Meals,6300,Sales,,Coffee
"""
ALIASES = "pattern,canonical_vendor\nAMZN|AMAZON,Amazon\n(bad,Nobody\nUBER,Uber\nSTARBUCKS,Starbucks\n,x\n"
POLICY = (
    "flag_code,field,op,value,severity,message,applies_to\n"
    "POLICY_REVIEW_OVER_20,amount_cents,>,2000,info,Review transactions over $20,transactions\n"
    ",amount_cents,>,1,,,\nNOTE,currency,==,USD,,,\n"
)
# The stored hashes of the rows above.
TX_HASHES = [
    "e0c5adae4b633561df3ead3c6f58533bd1ec20f12241b1ab009dc5185e5ee2dc",
    "30c00bc24dfe58bbd88b21bcd6743d6c413c354064d112fbe95d79eea50b3802",
    "f36810198a1cdbf45eac03461eeffa06653bd18f5859778881862935a0788377",
]
PAY_HASHES = [
    "be41e9d6694afc4be91c8a8dccabebed56ea6ee06eeb6798d1ea3fa0c715cf08",
    "6fff0d02652f5ca93caabce61ea100b651621acea1ccf6ba18dbaba631538b2f",
    "43482207dc5a38426832040cda4aec91b4dacee0381d8c0bcaf5177230a2fb5e",
]


def write(root, name, text):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    write(root, "data/raw/transactions_sample.csv", TRANSACTIONS)
    write(root, "data/raw/vendor_payments_sample.csv", PAYMENTS)
    write(root, "data/reference/vendor_aliases.csv", ALIASES)
    write(root, "data/reference/policy_rules.csv", POLICY)
    return Project(root=str(root), sources=DEFAULT_SOURCES)


def test_whole_project(spark, project):
    run = Run(spark, project, NOW, "b1")
    run.to_facts()
    run.post_model()
    store = Store(spark, project.path(project.store))
    raw = store.batch("stg_transactions_raw", "b1").orderBy("source_row_number").collect()
    assert [r.row_hash for r in raw] == TX_HASHES
    assert [r.source_row_number for r in raw] == [1, 2, 3]
    assert raw[0].source_file == "data/raw/transactions_sample.csv"
    assert raw[2].memo == ""
    pay = store.batch("stg_vendor_payments_raw", "b1").orderBy("source_row_number").collect()
    assert [r.row_hash for r in pay] == PAY_HASHES
    matches = store.batch("matches", "b1").collect()
    assert sorted(r.match_type for r in matches) == ["exact"] * 3
    flags = {(r.flag_code, r.record_type) for r in store.batch("qa_flags", "b1").collect()}
    assert flags == {
        ("POLICY_REVIEW_OVER_20", "transactions"), ("NOTE", "transactions"), ("NOTE", "vendor_payments"),
    }
    assert store.batch("exceptions", "b1").count() == 1 + 3 + 3
    rate = store.batch("rpt_match_rate_by_month", "b1").collect()
    assert [(r.month, r.txn_count, r.match_rate, r.spend_usd) for r in rate] == [("2025-12", 3, 1.0, 72.62)]
    assert store.table("dim_vendor").count() == 3
    run.to_facts()
    assert store.table("dim_vendor").count() == 3
    assert store.table("mapping_runs").count() == 4
    assert store.table("modeling_runs").count() == 2
    ledger = store.table("matching_runs").first()
    assert (ledger.match_count, ledger.unmatched_tx_count, ledger.unmatched_pay_count) == (3, 0, 0)
    counts = stage_counts({t: store.table(t) for t in ("matches", "exceptions")}).collect()
    assert {(r.stage, r.row_count) for r in counts} == {("matches", 3), ("exceptions", 7)}
    assert Run(spark, project, NOW).batch_id == "b1"
    written = run.publish()
    assert len(written) == 9
    assert snapshot_name(NOW, "b1") == "20251226T225957Z0000__b1"
    combined = combine_folder(spark, project.path("out/drop/history/exceptions"))
    assert combined.count() == 7 and "exception_id" in combined.columns


def test_rules(spark, project):
    aliases = load_aliases(spark, project.path(project.vendor_aliases_path))
    assert [a.canonical for a in aliases] == ["Amazon", "Uber", "Starbucks"]
    rules = load_policy_rules(spark, project.path(project.policy_rules_path))
    assert [(r.flag_code, r.severity, r.applies_to) for r in rules] == [
        ("POLICY_REVIEW_OVER_20", "info", "transactions"), ("NOTE", "warning", "both"),
    ]
    assert load_aliases(spark, project.path("missing.csv")) == []


def test_store_replaces_by_nothing_and_purges(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    df = spark.range(3).select(F.lit("x").alias("batch_id"), "id")
    store.replace("t", "001", df)
    store.replace("t", "2", df.withColumn("more", F.lit("m")))
    assert {(r.batch_id, r.more) for r in store.table("t").collect()} == {("001", None), ("2", "m")}
    store.replace("t", "001", df.limit(0))
    assert {r.batch_id for r in store.table("t").collect()} == {"2"}
    store.purge("t", "2")
    assert not store.exists("t", "2")


def test_a_replacement_is_one_step(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    rows = lambda n: spark.range(n).withColumn("batch_id", F.lit("a/b 1"))
    store.append("t", rows(3))
    store.append("t", spark.range(2).withColumn("batch_id", F.lit("other")))
    with monkeypatch.context() as broken:
        def dies(*args):
            raise RuntimeError("killed")

        broken.setattr(Store, "_point", dies)
        with pytest.raises(RuntimeError):
            store.replace("t", "a/b 1", rows(5))
        with pytest.raises(RuntimeError):
            store.replace("t", "new", rows(5))
    assert store.batch("t", "a/b 1").count() == 3 and store.table("t").count() == 5 and not store.exists("t", "new")
    for n in (7, 4, 6):
        found = store.replace("t", "a/b 1", store.batch("t", "a/b 1").limit(0).unionByName(rows(n)))
        assert found.count() == n == store.batch("t", "a/b 1").count() and store.table("t").count() == n + 2
        if n == 4:
            begun = found
    assert begun.collect() and begun.count() == 4  # a reader that began with the version before the last
    store.append("t", rows(1).withColumn("more", F.lit(1)))
    assert store.batch("t", "a/b 1").count() == 7 and store.table("t").columns == ["batch_id", "id", "more"]
    store.replace("t", "a/b 1", rows(0))
    assert store.batch("t", "a/b 1").count() == 0 and store.table("t").count() == 2
    store.purge("t", "a/b 1")
    assert not store.exists("t", "a/b 1") and store.table("t").count() == 2


def test_odd_files(spark, tmp_path):
    write(tmp_path, "in/f1.csv", '\ufeffA,B\n1,"x\ny"\nNA,null\n\n3,\n')
    write(tmp_path, "in/f2.csv", "A,A,a,C d\n1,2,3,4\n")
    write(tmp_path, "in/f 3+%.csv", "A,B\n" + "".join(f"{i},v\n" for i in range(50)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64)
    try:
        got = ingest(spark, f"{tmp_path}/in/f*.csv", "s", "b", NOW, str(tmp_path))
        rows = got.rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    one = sorted((r.source_row_number, r.a, r.b) for r in rows if r.source_file == "in/f1.csv")
    assert one == [(1, "1", "x\ny"), (2, "NA", "null"), (3, "3", "")]
    two = [r for r in rows if r.source_file == "in/f2.csv"][0]
    assert (two.a, two.a_1, two.a_2, two.c_d, two.b) == ("1", "2", "3", "4", None)
    three = sorted((r.source_row_number, int(r.a)) for r in rows if r.source_file == "in/f 3+%.csv")
    assert three == [(i + 1, i) for i in range(50)]
    registry = {r.source_file: r for r in got.files.collect()}
    assert registry["in/f2.csv"].original_columns_json == '["A", "A.1", "a", "C d"]'
    assert registry["in/f2.csv"].row_count == 1 and registry["in/f 3+%.csv"].row_count == 50
    assert registry["in/f1.csv"].file_size_bytes == len('\ufeffA,B\n1,"x\ny"\nNA,null\n\n3,\n'.encode())


def test_quotes_in_headers_and_fields(spark, tmp_path):
    write(tmp_path, "in/a.csv", 'Item 5" size,B\n5" pipe,x\n"a ""q"", b",y\n')
    write(tmp_path, "in/b.csv", '"two\nlines",B\n1,2\n')
    rows = ingest(spark, f"{tmp_path}/in/*.csv", "s", "b", NOW, str(tmp_path)).rows.collect()
    assert sorted((r.item_5_size, r.b) for r in rows if r.source_file == "in/a.csv") == [('5" pipe', "x"), ('a "q", b', "y")]
    assert [(r.two_lines, r.b) for r in rows if r.source_file == "in/b.csv"] == [("1", "2")]


def test_surplus_fields_and_endless_headers_raise(spark, tmp_path):
    write(tmp_path, "in/a.csv", "A,B\n1,2\n1,2,EXTRA\n")
    with pytest.raises(Exception, match="more fields than the header"):
        ingest(spark, f"{tmp_path}/in/a.csv", "s", "b", NOW, str(tmp_path)).rows.collect()
    write(tmp_path, "in/c.csv", '"never closed\n' + "x,y\n" * 300_000)
    with pytest.raises(ValueError, match="header"):
        ingest(spark, f"{tmp_path}/in/c.csv", "s", "b", NOW, str(tmp_path))


def test_one_feed_and_a_third_source(spark, tmp_path, project):
    write(tmp_path, "one/data/raw/transactions_x.csv", "Merchant,Post Date,Amount\nAcme,2025-12-02,4111111111111111\nAcme,2025-12-03,5\n")
    write(tmp_path, "one/data/raw/other_x.csv", "Merchant,Post Date,Amount\nOther,2025-12-02,1\n")
    sources = DEFAULT_SOURCES | {"other": replace(DEFAULT_SOURCES["transactions"], name="other", path="data/raw/other*.csv")}
    run = Run(spark, Project(root=f"{tmp_path}/one", sources=sources, publish_mode="latest"), NOW, "2025-12-02T01:02:03+00:00/a%b=c")
    run.to_facts()
    run.post_model()
    store = run.store
    assert store.batch("norm_other", run.batch_id).count() == 1 and not store.exists("fact_other")
    assert {r.exception_code for r in store.batch("exceptions", run.batch_id).collect()} >= {"UNMATCHED_TRANSACTION", "AMOUNT_OUTLIER"}
    assert {r.vendor_canonical for r in store.table("dim_vendor").collect()} == {"Acme"}
    assert store.table("mapping_runs").count() == 2 and store.batch("mapping_runs", run.batch_id).count() == 2
    assert [store.batch(t, run.batch_id).count() for t in ("qa_runs", "exception_runs", "report_runs")] == [1, 1, 1]
    published = run.publish()
    assert published == run.publish() and len(published) == 8
    assert not any("unmatched_vendor_payments" in p for p in published)
    exported = {p.rsplit("/", 1)[1] for p in run.export()}
    assert {"stg_other_raw", "norm_transactions", "fact_transactions", "qa_flags", "match_candidates", "unmatched_transactions"} <= exported
    assert combine_folder(spark, f"{tmp_path}/one/out/csv/stg_transactions_raw").count() == 2


def test_rerun_keeps_vendors_of_other_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: f"{tmp_path}/shared")
    def feed(root, vendor):
        write(tmp_path, "r/data/raw/transactions_x.csv", f"Merchant,Post Date,Amount\n{vendor},2025-12-02,5\n")
        run = Run(spark, Project(root=f"{tmp_path}/r", sources=DEFAULT_SOURCES), NOW, root)
        run.to_facts()
        return run.store

    for batch, vendor in (("p1", "Acme"), ("p2", "Acme"), ("p1", "Beta")):
        store = feed(batch, vendor)
    assert {r.vendor_canonical for r in store.table("dim_vendor").collect()} == {"Acme", "Beta"}
    assert [f for f in (tmp_path / "shared").rglob("*") if f.is_file()] == [], "stages leave no scratch"
    facts = store.table("fact_transactions")
    assert facts.join(store.table("dim_vendor"), "vendor_id", "left_anti").count() == 0


@pytest.mark.parametrize("batch", ["bt:1", "50%", "a/b", "k=v", "q'\"*?[{^\\#", "plain"])
def test_batch_ids_of_any_characters(spark, tmp_path, batch):
    store = Store(spark, str(tmp_path))
    df = spark.range(2).select(F.lit(batch).alias("batch_id"), "id")
    store.append("t", df)
    assert store.exists("t", batch) and store.batch("t", batch).count() == 2
    store.replace("t", batch, store.batch("t", batch).where("id > 0"))
    assert [tuple(r) for r in store.table("t").collect()] == [(batch, 1)]
    store.purge("t", batch)
    assert not store.exists("t", batch)


def test_snapshot_names():
    assert snapshot_name("2025-01-02T03:04:05", "b") == "20250102T030405Z0000__b"
    assert snapshot_name("2025-01-02T03:04:05-05:30", "b") == "20250102T030405M0530__b"


def test_unique_headers():
    assert unique_headers(["A", "A", "a", "", "A.1"]) == ["A", "A.2", "a", "Unnamed: 3", "A.1"]


def test_xlsx(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = (
        f'<worksheet {ns}><sheetData>'
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>Amount</t></is></c><c r="C1" t="str"><v>Day</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>48.27</v></c><c r="C2" s="1"><v>45993</v></c></row>'
        '<row r="3"><c r="B3"><v>5</v></c></row></sheetData></worksheet>'
    )
    with zipfile.ZipFile(tmp_path / "f.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Payee</t></si><si><t>Acme</t></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    got = ingest(spark, f"{tmp_path}/*.xlsx", "s", "b", NOW, str(tmp_path))
    rows = sorted((r.source_row_number, r.payee, r.amount, r.day) for r in got.rows.collect())
    assert rows == [(1, "Acme", "48.27", "2025-12-02 00:00:00"), (2, "", "5", "")]
