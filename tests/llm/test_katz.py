"""Katz scores against a plain model, normalisation, blocks, odd rows, held-out likelihood and whole tables."""

import math
import os
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from ledgerline.llm import katz
from ledgerline.llm.queries import QUERIES

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"
S, E, UNKNOWN = "<s>", "</s>", None


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def is_held(key):
    return crc32(("" if key is None else str(key)).encode()) % 5 == 1


class Plain:
    """The model by dictionaries, one history at a time."""

    def __init__(self, texts, order):
        self.order, self.n = order, [Counter() for _ in range(order + 1)]
        for words in texts:
            line = (S, *words, E)
            for t in range(1, len(line)):
                for k in range(1, min(order, t + 1) + 1):
                    self.n[k][line[t - k + 1:t + 1]] += 1
        self.starts = len(texts)
        self.after = [defaultdict(set) for _ in range(order + 1)]
        for k in range(2, order + 1):
            for g in self.n[k]:
                self.after[k][g[:-1]].add(g[-1])
        self.e = [None] + [katz.good_turing([sum(c == r for c in n.values()) for r in range(1, 7)]) for n in self.n[1:]]
        self.total = sum(self.n[1].values())

    def lose(self, k, r):
        return self.e[k][min(r, 5)]

    def count(self, history):
        return self.starts if history == (S,) else self.n[len(history)][history]

    def p(self, word, history):
        k = len(history) + 1
        if k == 1:
            if not self.total:
                return 1.0
            r = self.n[1][(word,)]
            return (r - self.lose(1, r)) / self.total if r else sum(self.lose(1, c) for c in self.n[1].values()) / self.total
        r = self.n[k][(*history, word)]
        if r:
            return (r - self.lose(k, r)) / self.count(history)
        return self.weight(history) * self.p(word, history[1:])

    def weight(self, history):
        seen = self.after[len(history) + 1][history]
        if not seen:
            return 1.0
        lost = sum(self.lose(len(history) + 1, self.n[len(history) + 1][(*history, w)]) for w in seen) / self.count(history)
        return lost / (1 - sum(self.p(w, history[1:]) for w in seen))

    def score(self, words):
        line = (S, *words, E)
        return sum(math.log10(self.p(line[t], line[max(0, t - self.order + 1):t])) for t in range(1, len(line)))


def plain(rows, order=2):
    model = Plain([words_of(t) for k, t in rows if not is_held(k)], order)
    kinds = len(model.n[1])
    out = []
    for key, text in rows:
        line = [*words_of(text), E]
        n = [model.n[1][(w,)] for w in line]
        base = sum(math.log10((c + 0.5) / (model.total + 0.5 * (kinds + 1))) for c in n)
        out.append((key, is_held(key), len(line), sum(c > 0 for c in n), model.total, base, model.score(line[:-1])))
    return sorted(out, key=str), model


def same(frame, want):
    got = sorted((tuple(r) for r in frame.collect()), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for column in (5, 6):  # each token's logarithm is rounded to nine places
        assert all(abs(a[column] - b[column]) <= 1e-9 * a[2] for a, b in zip(got, want))


def texts(n, seed, kinds=40):
    rnd = random.Random(seed)
    pool = [f"w{i}" for i in range(kinds)] + ["É", "The", "the", "日本"]
    odds = [1 / (i + 1) for i in range(len(pool))]
    return [(i, "  ".join(rnd.choices(pool, odds, k=rnd.randint(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_plain_model_and_sums_to_one(frame, monkeypatch, order):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 500)
    monkeypatch.setattr(katz, "GROUP_TOKENS", 400)
    rows = texts(200, order)
    want, model = plain(rows, order)
    same(katz.score(frame([(*r, "s") for r in rows]), order=order), want)
    if order > 1:
        histories = random.Random(1).sample(sorted(model.after[order]), 8) + [(S,)]
        for history in histories:
            assert math.isclose(sum(model.p(w, history) for w in [*(g[0] for g in model.n[1]), UNKNOWN]), 1, abs_tol=1e-9)


def test_good_turing():
    lost = katz.good_turing([100, 40, 20, 12, 8, 5])
    rest = 6 * 5 / 100
    assert lost[0] == 0 and len(lost) == 6
    assert math.isclose(lost[1], 1 - (2 * 40 / 100 - rest) / (1 - rest))
    assert katz.good_turing([0] * 6) == [0.0] + [0.5] * 5 and all(0 < e < r for r, e in enumerate(katz.good_turing([1, 9, 1, 9, 1, 9])) if r)


def test_packed():
    for x in (np.empty(0, np.uint64), np.array([0, 2 ** 64 - 1, 5], np.uint64), np.arange(1000).astype(np.uint64)):
        assert (katz.unpack(katz.pack(x)) == x).all()


def test_odd_rows_and_empty(odd, empty, frame):
    same(katz.score(odd), plain([r[:2] for r in ODD_ROWS])[0])
    assert katz.score(empty).collect() == []
    held = [k for k in range(60) if is_held(k)][:5]
    rows = [(k, "only held out texts") for k in held]
    same(katz.score(frame([(*r, "s") for r in rows])), plain(rows)[0])


def test_result_does_not_depend_on_the_deal(frame, monkeypatch):
    rows = [(*r, "s") for r in texts(300, 9)]
    first = sorted(map(tuple, katz.score(frame(rows, 1)).collect()))
    monkeypatch.setattr(katz, "BLOCK_BYTES", 300)
    assert sorted(map(tuple, katz.score(frame(rows[::-1], 4)).collect())) == first


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_on_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_katz"](spark, SF)
    want = plain(docs)[0]
    same(found, want)
    held = [r for r in found.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
