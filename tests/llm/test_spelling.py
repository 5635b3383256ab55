"""Spelling variants against all pairs, the pivots, chains of forms, odd rows and whole tables."""

import itertools
import os
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from ledgerline.llm import spelling
from ledgerline.llm.queries import QUERIES

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"


def plain_words(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def plain_groups(n):
    """Rows by the set of all words with one letter left out, independent of the index."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            holes[i, cut].add(w)
            if cut in n:
                near[w].add(cut)
                near[cut].add(w)
    for group in holes.values():
        for a, b in itertools.permutations(group, 2):
            near[a].add(b)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    rows = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(rows)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def edited(rnd, word, letters):
    i, c = rnd.randrange(len(word)), rnd.choice(letters)
    return rnd.choice([word[:i] + word[i + 1:], word[:i] + c + word[i:], word[:i] + c + word[i + 1:], word + c])


@pytest.mark.parametrize("letters", ["ab", "abcdé", "a"])
def test_all_pairs(spark, letters):
    rnd = random.Random(len(letters))
    pool = {"".join(rnd.choice(letters) for _ in range(rnd.randint(7, 12))) for _ in range(120)}
    for w in list(pool):
        for _ in range(3):
            w = edited(rnd, w, letters)
            pool.add(w)
    n = {w: rnd.choice([2, 3, 25, 30, 300, 4000]) for w in pool if len(w) >= 7}
    words = spark.createDataFrame([(w, k, i) for i, (w, k) in enumerate(n.items())], "word string, n long, id long").repartition(3)
    assert rows_of(spelling.group_variants(words)) == plain_groups(n)


def test_pivots_are_the_cheapest_disjoint_pair():
    rnd = random.Random(5)
    for _ in range(300):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(4, 14)))
        grams = sorted({a + b for a in "abcd" for b in "abcd"})
        order, cost = {g: i for i, g in enumerate(grams)}, [rnd.randint(1, 50) for _ in grams]
        from_start, from_end, ends = spelling.prefix_of(word, order)
        first, second = spelling.pivots_of(from_start, from_end, cost)
        assert max(g for g, _ in from_start) == ends and second - first >= 2
        assert cost[order[word[first:first + 2]]] + cost[order[word[second:second + 2]]] == min(
            cost[a[0]] + cost[b[0]] for a in from_start for b in from_end if b[1] - a[1] >= 2)


def test_postings_of_a_word_are_bounded():
    for word in ("ab" * 5000, "a" * 10_000, "abc" * 3000 + "x"):
        from_start, from_end, _ = spelling.prefix_of(word, {g: i for i, g in enumerate(["cx", "ab", "bc", "ca", "ba", "aa"])})
        assert len(from_start) <= 9 and len(from_end) <= 9


def test_chain_of_forms_and_long_words(spark):
    chain = ["abcdefghij"[:10 - k] + "z" * k for k in range(8)]
    rows = [(w, 10 ** (k + 1), k) for k, w in enumerate(chain)] + [("x" * 3000, 5, 90), ("x" * 3001, 50, 91), ("yx" * 1500, 7, 92)]
    got = rows_of(spelling.group_variants(spark.createDataFrame(rows, "word string, n long, id long")))
    assert got == plain_groups({w: n for w, n, _ in rows})
    assert {r[2] for r in got if r[0] in chain} == {chain[-1]}


def test_no_table_of_words_is_broadcast(spark):
    """A small file of words has large postings: they must not go through the driver, whatever the file's size."""
    words = spelling.numbered(spark.createDataFrame([(f"{c}bcdefg{d}", 10 + 5 * i) for i, c in enumerate("abcdef") for d in "xyz"], "word string, n long"))
    for frame in (spelling.near_pairs(words), spelling.group_variants(words)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def counted(frame):
    return spelling.count_words(spelling.lowered_runs(frame).select(
        spelling.with_slips(spelling.F.col("run"), spelling.F.col("doc_id")).alias("word")))


def test_words_odd_rows_and_empty(frame, odd, empty):
    rnd = random.Random(8)
    pool = ["Straßenbahn", "ÉLÉPHANTS", "elephants", "elephant", "ordinaryÿ", "naïvement", "short", "multiply×factor"]
    rows = [(k % 40, " ".join(rnd.choice(pool) for _ in range(9))) for k in range(120)] + [(None, "elephants " * 40)]
    assert rows_of(spelling.group_variants(counted(frame([(*r, "s") for r in rows])))) == plain_groups(plain_words(rows))
    assert rows_of(spelling.group_variants(counted(odd))) == plain_groups(plain_words([r[:2] for r in ODD_ROWS]))
    assert rows_of(spelling.group_variants(counted(empty))) == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_on_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op12_spelling"](spark, SF)) == plain_groups(plain_words(docs))
