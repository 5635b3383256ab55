"""CSV records over many blocks against a reader of whole files."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import records
from ledgerline.sources.files import ingest, open_quote, unescape_path
from ledgerline.sources.records import ends_inside, scan_records

NOW = "2025-12-26T22:59:57+00:00"


def test_ends_inside():
    rnd = random.Random(2)
    for _ in range(5000):
        line = "".join(rnd.choice('",a""x ') for _ in range(rnd.randint(0, 14)))
        for inside in (False, True):
            assert ends_inside(line, inside) == open_quote(line, inside), (line, inside)
    assert ends_inside('"' + '""' * 100_000, False) and not ends_inside('a,' * 100_000, False)


def field(rnd):
    text = "".join(rnd.choice(["a", "bc", " ", "é", "1"]) for _ in range(rnd.randint(0, 6)))
    if rnd.random() < 0.5:
        return text
    quoted = "".join(rnd.choice([text, "\n", "\r\n", '""', ",", "\n\n", '",""', "x"][:6]) for _ in range(rnd.randint(0, 5)))
    return f'"{quoted}"'


def sample(rnd, rows, end):
    lines = ["A,B,C"] + [",".join(field(rnd) for _ in range(3)) for _ in range(rows)]
    return end.join(x if x != ",," or i == 0 else "x,," for i, x in enumerate(lines)) + rnd.choice(["", end])


@pytest.mark.parametrize("seed,end,split", [(1, "\n", 70), (2, "\r\n", 150)])
def test_equal_to_a_reader_of_whole_files(spark, tmp_path, seed, end, split):
    rnd = random.Random(seed)
    (tmp_path / "f0.csv").write_bytes(sample(rnd, 40, end).encode())
    (tmp_path / "f1.csv").write_bytes(('﻿"A",B,C' + end + f'1,"{end * 120}",2' + end + "3,4,5").encode())
    paths = [str(tmp_path / f"f{i}.csv") for i in range(2)]
    want = []
    for path in paths:
        with open(path, encoding="utf-8-sig", newline="") as text:
            rows = [r for r in csv.reader(text) if r][1:]
        want += [(path, i + 1, *r) for i, r in enumerate(rows)]
    want.sort()
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = scan_records(spark, paths, ["A", "B", "C"], unescape_path(F.col("_metadata.file_path")))
        got = sorted(tuple(r) for r in found.select("_path", "source_row_number", "A", "B", "C").collect())
        tasks = spark.read.option("lineSep", "\n").text(paths[0]).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want and len(got) == 42
    assert tasks > 3


def test_a_missing_quote_and_surplus_fields_raise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MOST_LINES", 50)
    (tmp_path / "a.csv").write_text('A,B\n1,"never closed\n' + "x,y\n" * 200)
    with pytest.raises(Exception, match="quote may be missing"):
        ingest(spark, f"{tmp_path}/a.csv", "s", "b", NOW, str(tmp_path)).rows.collect()
    (tmp_path / "b.csv").write_text('A,B\n1,"x\ny",EXTRA\n')
    with pytest.raises(Exception, match="more fields than the header"):
        ingest(spark, f"{tmp_path}/b.csv", "s", "b", NOW, str(tmp_path)).rows.collect()
