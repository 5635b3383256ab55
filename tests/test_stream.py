"""New files as micro-batches: what a stream leaves, also after a failure, against single runs."""

import pytest

from ledgerline.config import DEFAULT_SOURCES, Project
from ledgerline.operators.assign import assign
from ledgerline.plans import runs, stream
from ledgerline.plans.runs import Run

NOW = "2025-12-26T22:59:57+00:00"
HEADS = {"transactions": "Merchant,Post Date,Amount\n", "vendor_payments": "Payee,Entry Date,Amount\n"}
DROPS = [
    {"transactions": "Acme,2025-12-02,10\nUber,2025-12-03,7\n", "vendor_payments": "Acme,2025-12-02,10\n"},
    {"transactions": "Bolt,2025-12-05,3\n", "vendor_payments": "Bolt,2025-12-06,3\nUber,2025-12-03,7\n"},
]


def drop(root, number):
    for source, rows in DROPS[number].items():
        path = root / f"data/raw/{source}_{number}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(HEADS[source] + rows)


def contents(store):
    tables = ["stg_transactions_raw", "fact_transactions", "fact_vendor_payments", "matches", "exceptions", "mapping_runs", "dim_vendor"]
    return {t: sorted(str(r.asDict()) for r in store.table(t).drop("source_file").collect()) for t in tables}


def test_restart_after_a_failed_batch(spark, tmp_path, monkeypatch):
    project = Project(root=f"{tmp_path}/a", sources=DEFAULT_SOURCES)

    def watch():
        query = stream.start(spark, project, f"{tmp_path}/checkpoint", lambda: NOW, until_caught_up=True)
        query.awaitTermination()

    drop(tmp_path / "a", 0)
    watch()
    drop(tmp_path / "a", 1)
    with monkeypatch.context() as broken:
        def fails(*args, **more):
            raise RuntimeError("lost")

        broken.setattr(runs, "assign", fails)
        with pytest.raises(Exception, match="lost"):
            watch()
    assert runs.assign is assign
    watch()
    got = contents(Run(spark, project, NOW, "x").store)

    plain = Project(root=f"{tmp_path}/b", sources=DEFAULT_SOURCES)
    for number in range(2):
        drop(tmp_path / "b", number)
        files = {s: [f"{tmp_path}/b/data/raw/{s}_{number}.csv"] for s in DEFAULT_SOURCES}
        run = Run(spark, plain, NOW, stream.batch_name(number), files)
        run.to_facts()
        run.post_model()
    want = contents(run.store)
    assert got == want and len(got["matches"]) == 2 and len(got["mapping_runs"]) == 4
