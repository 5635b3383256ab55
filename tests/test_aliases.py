"""Many alias rules by index against the chain of all rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.text import vendor_clean
from ledgerline.operators import aliases
from ledgerline.operators.aliases import first_alias, index_rules, needed_letters, with_alias
from ledgerline.sources.rules import AliasRule


@pytest.mark.parametrize("pattern,want", [
    ("AMZN|AMAZON", ["amzn", "amazon"]), ("^blue", ["blue"]), ("red.*widget", ["widget"]), (r"7\-eleven", ["7-eleven"]),
    ("colou?rs", ["colo"]), ("abc+d", ["abc"]), ("(?:north|south) star", [" star"]), ("a|widget", None), ("[a-z]+", None),
    ("(uber|lyft)", None), (r"\Qa.b.c\E", None), ("(?i)uber", None), (r"\d+ stores", [" stores"]), ("ab", None), ("", None),
    ("cafés noir", ["s noir"]), ("x{2}yzz", ["yzz"]), ("w[]x]abc", None), ("shop|", None), (r"\x41bcd", None), ("abc{0}def", ["def"]),
])
def test_needed_letters(pattern, want):
    assert needed_letters(pattern) == want


def test_letters_are_in_every_match():
    rnd = random.Random(3)
    pieces = ["ab", "c", "x?", "y*", "z+", "[ab]", "(?:ab|c)", ".", "|", "^", "a{2}", "b{0,1}", r"\d", r"\.", "abc", "cab"]
    tried = 0
    for _ in range(3000):
        pattern = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6)))
        try:
            compiled = re.compile(pattern)
        except re.error:
            continue
        needed = needed_letters(pattern)
        for _ in range(20):
            text = "".join(rnd.choice(["abc", "cab", "ab", "c", "1", ".", "aa", "x"]) for _ in range(rnd.randint(1, 7)))
            if needed and compiled.search(text):
                tried += 1
                assert any(n in text for n in needed), (pattern, text)
    assert tried > 100


def vendors(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, vendor_raw string").repartition(3)
    return df.withColumn("vendor_clean", vendor_clean(F.col("vendor_raw")))


def test_thousands_of_rules(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(3, 6)))
    rules = [AliasRule(rnd.choice(["{}", "^{}", "{}.*{}", "{}|{}", "{}s?$"]).format(word(), word()), f"C{i}") for i in range(4990)]
    rules[100:100] = [AliasRule("^..$", "short"), AliasRule("[hg]{3}", "class"), AliasRule("kiss", "Kiss"), AliasRule("foo bar", "Joined")]
    names = [rnd.choice(["{} {}", "{}*{}", "{} #12 {}", "{}"]).format(word().upper(), word()) for _ in range(400)]
    names += ["", None, "hh", "Kiſsİ", "foo #77 bar", "TİTLE", "kiss"] * 2
    df = vendors(spark, names)
    postings, unlisted = index_rules(rules)
    assert len(unlisted) == 2 and len({n for _, n in postings}) == len(rules) - 2
    patterns = [(re.compile(r.pattern, re.I), r) for r in rules]
    got = {r.i: r for r in with_alias(df, rules, "alias").collect()}
    assert len(got) == len(names)
    for r in got.values():
        if r.vendor_raw is None or not r.vendor_raw.isascii():
            continue
        want = next((rule for p, rule in patterns if p.search(r.vendor_raw) or (r.vendor_clean and p.search(r.vendor_clean))), None)
        assert (r.alias and (r.alias.canonical, r.alias.pattern)) == (want and (want.canonical, want.pattern))
    assert got[403].alias.canonical == "Kiss" and got[401].alias is None


def test_index_equals_chain_and_splits_by_distinct_vendors(spark, monkeypatch):
    rules = [AliasRule(p, c) for p, c in (("widget|gizmo", "W"), ("^blue", "B"), ("tıtle|title", "T"), ("z", "Z"))]
    df = vendors(spark, ["Blue Gear", "a gizmo", "TİTLE", "zz", None, "", "none", "blue widget"] * 5)
    chained = df.withColumn("alias", first_alias(F.col("vendor_raw"), F.col("vendor_clean"), rules)).collect()
    seen = []
    monkeypatch.setattr(aliases, "CHAINED", 1)
    monkeypatch.setattr(aliases, "aliases_of", lambda *args, of=aliases.aliases_of: seen.append(of(*args)) or seen[-1])
    assert sorted(map(str, with_alias(df, rules, "alias").collect())) == sorted(map(str, chained))
    assert seen[0].count() == 5  # one row for each vendor that a rule matches
