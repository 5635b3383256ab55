"""Quality rules: a threshold table compiled into one projection.

Measures are DataFrame expressions over one row, so the operator is a scan and a projection:
no user functions, no shuffle.  A rule names a measure and the range in which it must lie; the
table of rules becomes one boolean and the list of rules that a text breaks.

Defined results: a null or empty text has no words, so every ratio is zero; it breaks the word
count rule.  Repeated rows get equal results.  Very long texts are measured whole.  An empty table gives
no rows.  Columns of
the input stay; new names that clash are the caller's to choose (``prefix``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, whole_text, word_array

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"

#: Frequent words of the languages in use.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "which", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "im", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "au", "dans", "de", "du", "en", "est", "et", "la", "le", "les", "par", "pour", "que", "qui", "un", "une",
    "al", "con", "del", "el", "es", "los", "las", "no", "para", "por", "se", "su", "y",
)


@dataclass(frozen=True)
class Rule:
    """A text must have least <= measure <= most; a rule holds from so many words or lines on."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The threshold table.
RULES = (
    Rule("few_words", "n_words", least=10),
    Rule("repeated_words", "repeat_ratio", most=0.20),
    Rule("word_length", "mean_word_length", least=2.0, most=15.0, from_words=20),
    Rule("symbols", "symbol_ratio", most=0.30, from_words=20),
    Rule("stop_words", "stop_ratio", least=0.01, from_words=50),
    Rule("repeated_lines", "dup_line_ratio", most=0.50),
)


def measures(text: Column) -> dict[str, list[tuple[str, Column]]]:
    """Steps of named expressions; a step may use the names of those before."""
    words = lambda: F.col("_words")
    n, lines = F.col("n_words"), F.col("_lines")
    window_hash = F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.element_at(words(), (i + k).cast("int")) for k in range(WINDOW)]),
    )
    # Sorted (hash, place): equal neighbours are windows found twice or more.
    placed = F.array_sort(F.transform(F.col("_hashes"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.array_sort(F.transform(
        F.filter(F.col("_placed"), lambda x, j: (
            (F.get(F.col("_placed"), j - 1)["h"] == x["h"]) & (j > 0)
        ) | F.coalesce(F.get(F.col("_placed"), j + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"],
    ))
    # Each repeated window covers its words up to where the next one begins.
    covered = F.aggregate(
        F.transform(F.col("_twice"), lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_twice"), j + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda total, x: total + x,
    )
    repeats = F.size("_hashes") > F.size(F.array_distinct("_hashes"))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return {
        "words": [("_words", F.filter(word_array(text), lambda w: w != ""))],
        "counts": [
            ("n_words", F.size("_words").cast("long")),
            ("word_chars", F.length(F.array_join("_words", "")).cast("long")),
            ("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long")),
            ("_lines", F.filter(F.split(text, "\n"), has_word)),
            ("_stops", F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS)))),
        ],
        "hashes": [
            ("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")),
            ("_n_lines", F.size(lines)),
            ("_hashes", F.when(n >= WINDOW, window_hash).otherwise(F.array().cast("array<bigint>"))),
        ],
        "placed": [("_placed", F.when(repeats, placed))],
        "twice": [("_twice", F.when(F.col("_placed").isNotNull(), twice))],
        "repeats": [("n_repeat_words", F.when(F.col("_twice").isNotNull(), covered).otherwise(F.lit(0)).cast("long"))],
        "ratios": [
            ("repeat_ratio", ratio(F.col("n_repeat_words"), n)),
            ("mean_word_length", ratio(F.col("word_chars"), n)),
            ("symbol_ratio", ratio(F.col("n_symbols"), n)),
            ("stop_ratio", ratio(F.col("_stops"), n)),
            ("dup_line_ratio", ratio(F.col("n_dup_lines"), F.col("_n_lines"))),
        ],
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_ratio", "mean_word_length",
            "symbol_ratio", "stop_ratio", "dup_line_ratio")


def broken_rules(measured: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a struct of measures breaks, in the order of the table."""
    checks = []
    for rule in rules:
        value, out = measured[rule.measure], F.lit(False)
        if rule.least is not None:
            out = out | (value < rule.least)
        if rule.most is not None:
            out = out | (value > rule.most)
        checks.append(F.when(out & (measured["n_words"] >= rule.from_words), F.lit(rule.name)))
    return F.array_compact(F.array(*checks))


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """The frame with one more column: a struct of the measures, base_failed, kept and broken; and its name."""
    (name,) = fresh(docs, "quality")
    step = docs.select(F.struct("*").alias("row"), whole_text(text_col).alias("_text"))
    for columns in measures(F.col("_text")).values():
        step = step.select("*", *[c.alias(n) for n, c in columns])
    step = step.select("row", F.struct(*MEASURES).alias("_measured"))
    m = F.col("_measured")
    base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    broken = F.col("_broken")
    judged = step.select("row", "_measured", base.alias("_base"), broken_rules(m, rules).alias("_broken"))
    # Always true, but not known to be: a filter on the verdict stays above instead of repeating every measure.
    evaluated = F.monotonically_increasing_id() >= 0
    kept = ~F.col("_base") & (F.size(broken) == 0) & evaluated
    return judged.select(
        "row.*",
        F.struct(*[m[x].alias(x) for x in MEASURES], F.col("_base").alias("base_failed"), kept.alias("kept"),
                 broken.alias("broken")).alias(name),
    ), name
