"""The name index against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.similarity import vendor_similarity
from ledgerline.operators.names import letter_keys, name_pairs, similar_names


def names(seed, n, words, most):
    rnd = random.Random(seed)
    made = set()
    while len(made) < n:
        name = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, most)))
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(name))
            name = name[:i] + rnd.choice("abx é") + name[i + rnd.randint(0, 1):]
        if name.strip():
            made.add(name.strip())
    return sorted(made)


def frames(spark, t, p):
    return spark.createDataFrame([(x,) for x in t], "t_vendor string"), spark.createDataFrame([(x,) for x in p], "p_vendor string")


def all_pairs(t, p, floor):
    compared = t.crossJoin(p).withColumn("vendor_sim", vendor_similarity(F.col("t_vendor"), F.col("p_vendor")))
    return {tuple(r) for r in compared.where(F.col("vendor_sim") >= floor).collect()}


WORDS = ["a", "b", "ab", "red", "Red", "widget", "gadget", "group", "international", "x1", "日本", "sa", "blue", "co-op", "midget"]


@pytest.mark.parametrize("floor", [0.501, 0.6, 0.75, 0.9, 1.0])
@pytest.mark.parametrize("seed,words,most", [(1, WORDS, 4), (2, ["a", "b", "c", "ab"], 6), (3, ["aaaa", "aaab", "bbbb", "abab"], 3)])
def test_no_pair_is_missed(spark, seed, words, most, floor):
    t, p = frames(spark, names(seed, 90, words, most), names(seed + 10, 90, words, most))
    want = all_pairs(t, p, floor)
    assert want
    assert {tuple(r) for r in similar_names(t, p, floor).collect()} == want


def test_unlike_names_do_not_meet(spark):
    rnd = random.Random(4)
    name = lambda: " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(5, 9))) for _ in range(2)) + " group"
    t, p = frames(spark, sorted({name() for _ in range(600)}), sorted({name() for _ in range(600)}))
    assert name_pairs(t, p, 0.75).count() < 600 * 600 / 25


def test_long_names_have_a_bounded_number_of_keys():
    for n in (30, 80, 300):
        keys = list(letter_keys(["".join(random.Random(n).choices("abcdefghij", k=n))], {}, 0.75))
        assert len(keys) <= 3 * 120 + n


def test_low_floor_is_refused(spark):
    with pytest.raises(ValueError):
        name_pairs(*frames(spark, ["a"], ["b"]), 0.5)
