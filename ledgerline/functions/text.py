"""Text functions on columns."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

# The characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Words that say nothing about the vendor.
NOISE_WORDS = (
    "inc", "llc", "ltd", "co", "corp", "company", "the",
    "pos", "debit", "credit", "purchase", "online",
    "com", "help", "mktp", "us", "store", "payment",
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times (else each use repeats its expression)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column) -> Column:
    """Trim all Unicode white space (``trim`` knows the space only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def sanitize_name(name: str) -> str:
    """Header name as a safe column name, on the driver's header list."""
    words = re.findall(r"[a-z0-9]+", name.strip(WHITESPACE).lower())
    safe = "_".join(words) or "col"
    return f"c_{safe}" if safe[0].isdigit() else safe


def sanitize_names(names: Iterable[str]) -> list[str]:
    """Safe names, later duplicates numbered _2, _3, ..."""
    taken: dict[str, None] = {}
    copies: Counter[str] = Counter()
    for base in map(sanitize_name, names):
        unique = base
        while unique in taken:
            copies[base] += 1
            unique = f"{base}_{copies[base] + 1}"
        taken[unique] = None
    return list(taken)


def sanitize_column(c: Column) -> Column:
    """:func:`sanitize_name` for a column of names."""
    safe = F.btrim(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_"), F.lit("_"))
    safe = F.when(safe == "", "col").otherwise(safe)
    return F.when(safe.rlike("^[0-9]"), F.concat(F.lit("c_"), safe)).otherwise(safe)


def vendor_clean(c: Column) -> Column:
    """Messy vendor text as lower-case tokens; ``""`` when nothing is left.

    The text before the first ``*`` counts.  ``#123`` store numbers, punctuation, digit-only
    tokens and noise words go.  After the second replacement only ASCII letters, digits and
    single blanks remain, so one word-boundary pattern drops digit tokens and noise words.
    """
    s = F.substring_index(strip(F.coalesce(c, F.lit(""))), "*", 1)
    s = F.regexp_replace(s, r"#[\s\p{Z}]*\p{Nd}+", " ")
    s = F.lower(F.regexp_replace(s, "[^A-Za-z0-9]+", " "))
    s = F.regexp_replace(s, rf"\b(?:[0-9]+|{'|'.join(NOISE_WORDS)})\b", " ")
    return F.trim(F.regexp_replace(s, " +", " "))


def title_case(c: Column) -> Column:
    """Upper-case every letter that does not follow a letter (lower-case ASCII input).

    ``initcap`` differs only where a letter follows a digit, so only such text takes the
    character-wise form.
    """
    chars = F.split(c, "")
    cased = F.transform(
        chars,
        lambda ch, i: F.when(
            (i == 0) | ~F.get(chars, i - 1).rlike("[A-Za-z]"), F.upper(ch)
        ).otherwise(ch),
    )
    return F.when(c.rlike("[0-9][a-z]"), F.array_join(cased, "")).otherwise(F.initcap(c))


def json_string(c: Column) -> Column:
    """Quoted JSON string, non-ASCII text kept, control characters as lower-case escapes."""
    named = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}
    for ch, escape in named.items():
        c = F.replace(c, F.lit(ch), F.lit(escape))

    def rare(s: Column) -> Column:
        """The other control characters, which hardly any text has, character by character."""
        codes = F.from_json(F.lit(json.dumps({chr(n): f"\\u{n:04x}" for n in range(32)})), "map<string,string>")
        chars = F.transform(F.split(s, ""), lambda ch: F.coalesce(F.try_element_at(codes, ch), ch))
        return F.when(s.rlike(r"[\x00-\x1f]"), F.array_join(chars, "")).otherwise(s)

    return F.concat(F.lit('"'), let(c, rare), F.lit('"'))
