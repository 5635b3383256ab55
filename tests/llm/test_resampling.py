"""Importance resampling against a plain recount, chunk borders, odd rows and whole tables."""

import hashlib
import math
import os
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import resampling
from ledgerline.llm.queries import QUERIES

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return len(words), [crc32(" ".join(words[i:i + n]).encode()) % 10000 for n in (1, 2) for i in range(len(words) - n + 1)]


def plain(rows, targets):
    """(doc_id, n_features, weight, score, rank) of rows (doc_id, text)."""
    counts = [np.zeros(10000, int) for _ in range(2)]
    found = [features(t) for _, t in rows]
    for count, lists in ((counts[0], [f for _, f in found]), (counts[1], [features(t)[1] for t in targets])):
        for one in lists:
            np.add.at(count, one, 1)
    (s, t), (S, T) = counts, map(int, map(sum, counts))
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (S + 10000) / ((float(s[b]) + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for (key, _), (n, one) in zip(rows, found):
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in one) // len(one) if one else 0
        out.append((key, n, len(one), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -math.inf if r[0] is None else r[0], r[2], r[3]))
    ranked = [(r[0], *r[2:], i + 1 if i < 25 * len(able) // 100 else None) for i, r in enumerate(able)]
    return sorted(ranked + [(r[0], *r[2:], None) for r in out if r[1] < 20], key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def texts(n, seed):
    rnd = random.Random(seed)
    pool = ["aB", "é", "x9", "日本", "Zz", "the", "of", "Ünï"]
    return ["".join(rnd.choice(pool) + rnd.choice([" ", ", ", "\x00", "-", "\x7f", " ", "\n"]) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_equals_recount(frame, spark):
    rows = list(enumerate(texts(150, 1)))
    targets = texts(20, 2)
    drawn = resampling.draw(frame([(i, t, "s") for i, t in rows]), spark.createDataFrame([(t,) for t in targets], "text string"))
    assert rows_of(drawn) == plain(rows, targets)


def test_chunks_and_separators(monkeypatch):
    monkeypatch.setattr(resampling, "CHUNK_WORDS", 3)
    batch = [*texts(30, 3), "", "one", "\x00", "a b c d e f g h"]
    for longest in (1, 2, 3, 5):
        got = [[] for _ in batch]
        for owners, found, n in resampling.feature_chunks([t.encode() for t in batch], 10000, longest):
            for o, f in zip(owners, found):
                got[o].append((n, int(f)))
        for text, one in zip(batch, got):
            words = [m.decode() for m in resampling.WORD.findall(text.encode().lower())]
            want = [(n, crc32(" ".join(words[i:i + n]).encode()) % 10000) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
            assert sorted(one) == sorted(want)


def test_odd_rows_ties_and_empty_tables(odd, empty, frame):
    target = frame([(1, "long text", "a")])
    assert rows_of(resampling.draw(odd, target)) == plain([(r[0], r[1]) for r in ODD_ROWS], ["long text"])
    same = [(1, "word " * 30, "a")] * 9 + [(2, "word " * 30, "a")] * 3
    got = rows_of(resampling.draw(frame(same), empty))
    assert got == plain([(r[0], r[1]) for r in same], []) and sorted(r[4] for r in got if r[4]) == [1, 2, 3]
    assert rows_of(resampling.draw(empty, target)) == []
    weighed, names = resampling.weigh(odd.withColumn("weight", F.lit("mine")), target, ("doc_id", "weight", "text"))
    assert weighed.columns[:3] == ["doc_id", "weight", "text"] and len(set(weighed.columns)) == 6
    assert {r.text for r in weighed.collect()} == {r[1] for r in ODD_ROWS}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_on_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(QUERIES["op13_resampling"](spark, SF)) == plain(docs, targets)
