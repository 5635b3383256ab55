"""First alias rule that matches a vendor, for any number of rules.

A few rules are a chain of conditions in the projection of the rows.  More go by an index: most patterns
cannot match a text without some stretch of plain letters, so each rule is listed under three letters in a
row of such a stretch (one for each alternative), and distinct vendors meet the rules whose letters they
have.  Only there is the pattern itself tried; the first rule in file order is the least number.  Rules
without such a stretch are tried on every distinct vendor.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import vendor_clean
from ..session import materialize
from ..sources.rules import AliasRule

CHAINED = 16  # rules that are a chain of conditions
LETTERS = 3

_ALIAS = "struct<canonical:string,pattern:string>"


def _matches(text: Column, cleaned: Column, pattern: Column) -> Column:
    """Whether a pattern (Java syntax) matches the text or, if there is one, the cleaned text, in any case."""
    folded = F.concat(F.lit("(?iu)"), pattern)
    return F.rlike(text, folded) | ((cleaned != "") & F.rlike(cleaned, folded))


def first_alias(raw: Column, cleaned: Column, rules: Sequence[AliasRule]) -> Column:
    """Struct (canonical, pattern) of the first rule that matches either text, else NULL."""
    hits = [
        F.when(_matches(raw, cleaned, F.lit(r.pattern)), F.struct(F.lit(r.canonical).alias("canonical"), F.lit(r.pattern).alias("pattern")))
        for r in rules
    ]
    return F.coalesce(*hits, F.lit(None).cast(_ALIAS))


def _end_of_class(pattern: str, at: int) -> int | None:
    """Place behind a bracketed class that begins here; null where it is unusual."""
    if pattern[at + 1:at + 2] == "]" or pattern[at + 1:at + 3] == "^]":
        return None
    depth = 0
    while at < len(pattern):
        c = pattern[at]
        depth += (c == "[") - (c == "]")
        at += 2 if c == "\\" else 1
        if depth == 0:
            return at
    return None


def _end_of_group(pattern: str, at: int) -> int | None:
    depth = 0
    while at < len(pattern):
        c = pattern[at]
        if c == "[":
            end = _end_of_class(pattern, at)
            if end is None:
                return None
            at = end
            continue
        if c == "\\" and pattern[at + 1:at + 2] in ("Q", "E"):
            return None
        depth += (c == "(") - (c == ")")
        at += 2 if c == "\\" else 1
        if depth == 0:
            return at
    return None


def needed_letters(pattern: str) -> list[str] | None:
    """The longest plain stretch of each alternative, in lower case; null unless all have one of LETTERS letters.

    Careful rather than complete: what is not understood counts as no letters.
    """
    alternatives: list[list[str]] = [[""]]
    runs, at = alternatives[0], 0
    while at < len(pattern):
        c = pattern[at]
        step, plain = 1, ""
        if c == "\\":
            after = pattern[at + 1:at + 2]
            step = 2
            if after.isalnum() or not after:
                if after not in tuple("dDsSwWbB"):
                    return None
            else:
                plain = after
        elif c in "([":
            if pattern.startswith("(?", at) and not pattern.startswith("(?:", at):
                return None
            end = (_end_of_group if c == "(" else _end_of_class)(pattern, at)
            if end is None:
                return None
            step = end - at
        elif c == "|":
            alternatives.append(runs := [""])
            at += 1
            continue
        elif c in "?*{":
            runs[-1] = runs[-1][:-1]  # perhaps not there at all
            if c == "{":
                end = pattern.find("}", at)
                if end < 0:
                    return None
                step = end + 1 - at
        elif c in ".^$+)":
            pass
        else:
            plain = c
        if plain and " " <= plain <= "~":
            runs[-1] += plain
        else:
            runs.append("")
        at += step
    longest = [max(runs, key=len).lower() for runs in alternatives]
    return longest if all(len(x) >= LETTERS for x in longest) else None


def _grams(text: str) -> list[str]:
    return [text[i:i + LETTERS] for i in range(len(text) - LETTERS + 1)]


def _folded(text: Column) -> Column:
    """Lower case as patterns compare plain letters in any case: four other letters count as plain ones."""
    return F.lower(F.translate(text, "\u0130\u0131\u017f\u212a", "iisk"))


def _grams_of(text: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(text) - (LETTERS - 1))
    return F.when(F.length(text) >= LETTERS, F.transform(places, lambda i: F.substring(text, i, F.lit(LETTERS)))).otherwise(
        F.array().cast("array<string>"))


def index_rules(rules: Sequence[AliasRule]) -> tuple[list[tuple[str, int]], list[int]]:
    """Postings (letters, rule number), the rarest letters of each alternative, and the rules that have none."""
    needed = [needed_letters(r.pattern) for r in rules]
    used = Counter(g for stretches in needed if stretches for s in stretches for g in set(_grams(s)))
    postings = {(min(_grams(s), key=lambda g: (used[g], g)), n) for n, stretches in enumerate(needed) if stretches for s in stretches}
    return sorted(postings), [n for n, stretches in enumerate(needed) if not stretches]


def aliases_of(names: DataFrame, rules: Sequence[AliasRule]) -> DataFrame:
    """Rows vendor_raw, alias (see ``first_alias``) of the distinct vendors that a rule matches; names has vendor_raw."""
    spark = names.sparkSession
    postings, unlisted = index_rules(rules)
    table = spark.createDataFrame([(n, r.pattern, r.canonical) for n, r in enumerate(rules)], "rule int, pattern string, canonical string")
    listed = spark.createDataFrame(postings, "letters string, rule int").join(table, "rule")
    distinct = materialize(names.select("vendor_raw").where("vendor_raw IS NOT NULL").distinct().withColumn(
        "cleaned", vendor_clean(F.col("vendor_raw"))), "vendors")
    either = F.array_union(_grams_of(_folded(F.col("vendor_raw"))), _grams_of(_folded(F.col("cleaned"))))
    met = distinct.select("vendor_raw", "cleaned", F.explode(either).alias("letters")).join(listed, "letters")
    found = met.where(_matches(F.col("vendor_raw"), F.col("cleaned"), F.col("pattern"))).select("vendor_raw", "rule", "pattern", "canonical")
    if unlisted:
        first = first_alias(F.col("vendor_raw"), F.col("cleaned"), [AliasRule(rules[n].pattern, str(n)) for n in unlisted])
        tried = distinct.select("vendor_raw", first["canonical"].cast("int").alias("rule")).where("rule IS NOT NULL")
        found = found.unionByName(tried.join(table, "rule").select(*found.columns))
    hit = F.min_by(F.struct("canonical", "pattern"), "rule").alias("alias")
    return materialize(found.groupBy("vendor_raw").agg(hit), "aliases")


def with_alias(df: DataFrame, rules: Sequence[AliasRule], name: str) -> DataFrame:
    """Add the struct of the first rule that matches vendor_raw or vendor_clean."""
    if len(rules) <= CHAINED:
        return df.withColumn(name, first_alias(F.col("vendor_raw"), F.col("vendor_clean"), rules))
    return df.join(aliases_of(df, rules).withColumnRenamed("alias", name), "vendor_raw", "left").select(*df.columns, name)
