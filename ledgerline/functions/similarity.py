"""Vendor similarity as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import let, strip

_WORD = 60  # characters whose match positions fit one long with a spare carry bit


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda ch: ch != "")


def _lcs_bits(a: Column, b: Column) -> Column:
    """Longest common subsequence for short ``a``: one long holds the row of differences.

    Hyyro's bit-vector recurrence: a zero bit marks a position of ``a`` where the row grows.
    """
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    bits = F.transform(
        _chars(a),
        lambda ch, i: F.struct(ch.alias("ch"), F.call_function("shiftleft", one, i).alias("bit")),
    )

    def grow(bits: Column, full: Column) -> Column:
        def positions(ch: Column) -> Column:
            return F.aggregate(
                bits, zero, lambda acc, x: F.when(x["ch"] == ch, acc.bitwiseOR(x["bit"])).otherwise(acc)
            )

        def step(v: Column, ch: Column) -> Column:
            return let(
                v.bitwiseAND(positions(ch)), lambda u: (v + u).bitwiseOR(v - u).bitwiseAND(full)
            )

        return F.aggregate(_chars(b), full, step)

    full = F.call_function("shiftleft", one, F.length(a)) - 1
    row = let(F.struct(bits.alias("bits"), full.alias("full")), lambda x: grow(x["bits"], x["full"]))
    return F.length(a) - F.bit_count(row)


def _lcs_words(a: Column, b: Column) -> Column:
    """Longest common subsequence, any length: the same recurrence over several longs with a carry.

    The match positions of each distinct character of ``a`` are worked out once; a character of
    ``b`` then costs one look-up and one step for each long.
    """
    zero, full = F.lit(0).cast("bigint"), F.lit((1 << _WORD) - 1)

    def positions(chars: Column) -> Column:
        longs = F.sequence(F.lit(0), F.floor((F.size(chars) - 1) / _WORD).cast("int"))

        def of(ch: Column, k: Column) -> Column:
            part = F.slice(chars, k * _WORD + 1, F.lit(_WORD))
            bits = F.transform(part, lambda x, i: F.when(x == ch, F.call_function("shiftleft", zero + 1, i)).otherwise(zero))
            return F.aggregate(bits, zero, lambda acc, x: acc.bitwiseOR(x))

        known = F.array_distinct(chars)
        return F.map_from_arrays(known, F.transform(known, lambda ch: F.transform(longs, lambda k: of(ch, k))))

    def step(row: Column, matches: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            v, u = x["v"], x["v"].bitwiseAND(x["m"])
            return let(v + u + acc["carry"], lambda total: F.struct(
                F.concat(acc["row"], F.array(total.bitwiseOR(v - u).bitwiseAND(full))).alias("row"),
                F.shiftright(total, _WORD).alias("carry"),
            ))

        start = F.struct(F.array().cast("array<bigint>").alias("row"), zero.alias("carry"))
        pairs = F.zip_with(row, matches, lambda v, m: F.struct(v.alias("v"), m.alias("m")))
        return F.when(matches.isNull(), row).otherwise(F.aggregate(pairs, start, add)["row"])

    def count(known: Column) -> Column:
        start = F.array_repeat(full, F.ceil(F.length(a) / _WORD).cast("int"))
        row = F.aggregate(_chars(b), start, lambda acc, ch: step(acc, F.try_element_at(known, ch)))
        return F.aggregate(row, F.lit(0), lambda n, v: n + _WORD - F.bit_count(v))

    return let(let(_chars(a), positions), count)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings."""
    return (
        F.when((F.length(a) == 0) | (F.length(b) == 0), 0)
        .when(F.length(a) <= _WORD, _lcs_bits(a, b))
        .when(F.length(b) <= _WORD, _lcs_bits(b, a))
        .otherwise(_lcs_words(a, b))
    )


def tokens(s: Column) -> Column:
    """Distinct tokens between white space."""
    return F.array_distinct(F.filter(F.split(strip(s), r"\s+"), lambda t: t != ""))


def _joined(parts: Column) -> Column:
    return F.array_join(F.array_sort(parts), " ")


def _ratio(distance: Column, total: Column) -> Column:
    return F.lit(100.0) - F.lit(100.0) * distance / total


def _best_ratio(x: Column) -> Column:
    """Best of the ratios between S, S+A and S+B from their texts."""
    shared, only_a, only_b = x["s"], x["a"], x["b"]
    n_s, n_a, n_b = F.length(shared), F.length(only_a), F.length(only_b)
    sep = F.when(n_s > 0, 1).otherwise(0)
    len_a, len_b = n_s + sep + n_a, n_s + sep + n_b
    full = _ratio(n_a + n_b - 2 * lcs_length(only_a, only_b), len_a + len_b)
    return (
        F.when((n_s > 0) & ((n_a == 0) | (n_b == 0)), 100.0)
        .when(n_s == 0, full)
        .otherwise(F.greatest(full, _ratio(sep + n_a, n_s + len_a), _ratio(sep + n_b, n_s + len_b)))
    )


def token_set_ratio(a: Column, b: Column) -> Column:
    """Token-set ratio, 0 to 100, case sensitive.

    With the shared tokens S and the leftovers A and B, the best of the three ratios between
    S, S+A and S+B, each 100 * (1 - insertions and deletions / total length).
    """

    def texts(t: Column) -> Column:
        return F.struct(
            _joined(F.array_intersect(t["a"], t["b"])).alias("s"),
            _joined(F.array_except(t["a"], t["b"])).alias("a"),
            _joined(F.array_except(t["b"], t["a"])).alias("b"),
        )

    ratio = let(F.struct(tokens(a).alias("a"), tokens(b).alias("b")), lambda t: let(texts(t), _best_ratio))
    return F.when((strip(a) == "") | (strip(b) == ""), 0.0).otherwise(ratio)


def vendor_similarity(a: Column, b: Column) -> Column:
    """0 to 1: blank 0, equal but for case 1, else the token-set ratio."""
    a, b = strip(F.coalesce(a, F.lit(""))), strip(F.coalesce(b, F.lit("")))
    return (
        F.when((a == "") | (b == ""), 0.0)
        .when(F.lower(a) == F.lower(b), 1.0)
        .otherwise(token_set_ratio(a, b) / 100.0)
    )
