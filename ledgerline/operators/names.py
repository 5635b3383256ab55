"""Pairs of vendor names that may reach a similarity, by inverted indexes instead of all pairs.

A similarity of ``floor`` or more needs one of three things (see ``functions.similarity``):

- the names are equal but for case;
- the tokens that both share make up most of one name: with L its length, spaces included, they have
  floor / (2 - floor) * L of it.  A name posts its rarest tokens up to the point where the rest cannot make
  that up any more; the other side posts all tokens;
- insertions and deletions between the names, shared tokens first, are at most (1 - floor) of both lengths.
  Then both lengths are within that of each other, and at least floor / (2 - floor) * L - (tokens - 1) letters
  of a name, copies counted, are in the other.  A name posts combinations of up to three of its letters, rare
  letters first, from a prefix as long as it takes for the common letters that come first to lie in both
  prefixes.  How many letters make a combination depends on the name alone; two names meet at the lesser number.

Pairs that meet by letters must also pass the length bound and a bound on their letter sets, two words of
bits whose difference is at most the number of insertions and deletions.  The similarity itself decides.

Lists are joined by key; a frequent token or combination is split by the skew join.  The driver sees how
frequent letters are, of which there are ``CLASSES`` kinds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.similarity import tokens, vendor_similarity
from ..session import materialize, ship_functions

ship_functions(__name__)

LEAST_FLOOR = 0.5  # below it names need not share a letter
COMBINED = 3  # letters of a combination at most
MOST_KEYS = 120  # combinations of a name, else they have fewer letters
CLASSES, COPIES = 64, 8  # kinds of letters, and of copies of a letter, that are told apart by frequency

Letter = tuple[int, int]  # kind, and which copy of it


def _letters(name_tokens: list[str]) -> list[Letter]:
    """Letters of all tokens, copies numbered."""
    seen: Counter[int] = Counter()
    found = []
    for kind in (ord(c) % CLASSES for t in name_tokens for c in t):
        found.append((kind, seen[kind]))
        seen[kind] += 1
    return found


def _letter_set(letters: list[Letter]) -> int:
    """Bits of the letters' kinds, and of those there twice, as a signed word."""
    bits = 0
    for kind, copy in letters:
        if copy < 2:
            bits |= 1 << (kind % 32 + 32 * copy)
    return bits - (1 << 64) if bits >> 63 else bits


def _letter_counts(names: DataFrame) -> dict[Letter, int]:
    """How many names have each letter; at most CLASSES * COPIES numbers."""

    def count(batches):
        import pyarrow as pa

        total: Counter[Letter] = Counter()
        for batch in batches:
            for name_tokens in batch.column("tokens").to_pylist():
                total.update(x for x in _letters(name_tokens) if x[1] < COPIES)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in total], pa.int32()), pa.array([c for _, c in total], pa.int32()), pa.array(total.values(), pa.int64())],
            ["kind", "copy", "n"])

    counted = names.select("tokens").mapInArrow(count, "kind int, copy int, n long").groupBy("kind", "copy").agg(F.sum("n").alias("n"))
    return {(r.kind, r.copy): r.n for r in counted.collect()}


def letter_keys(name_tokens: list[str], counts: dict[Letter, int], floor: float) -> Iterator[tuple[int, int, int]]:
    """Of each number of letters up to the name's own: that number, the own one, and the keys of the combinations."""
    letters = sorted(_letters(name_tokens), key=lambda x: (counts.get(x, 0), -x[1], x))
    size = len(letters) + len(name_tokens) - 1
    common = max(1, math.ceil(floor / (2 - floor) * size - 1e-9) - len(name_tokens) + 1)
    prefix = lambda k: letters[:min(len(letters), len(letters) - common + k)]
    own = max(k for k in range(1, min(COMBINED, common) + 1) if k == 1 or math.comb(len(prefix(k)), k) <= MOST_KEYS)
    for k in range(1, own + 1):
        for chosen in combinations(prefix(k), k):
            yield k, own, hash(chosen)


def _by_letters(names: DataFrame, prefix: str, counts: dict[Letter, int], floor: float) -> DataFrame:
    """Rows k, key and, prefixed, own, vendor, size, letters."""

    def post(batches):
        import pyarrow as pa

        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64()]
        columns = ["k", "key", *(f"{prefix}_{c}" for c in ("own", "vendor", "size", "letters"))]
        for batch in batches:
            rows: list[list] = [[] for _ in kinds]
            for vendor, name_tokens in zip(batch.column("vendor").to_pylist(), batch.column("tokens").to_pylist()):
                letters = _letters(name_tokens)
                about = (vendor, len(letters) + len(name_tokens) - 1, _letter_set(letters))
                for k, own, key in letter_keys(name_tokens, counts, floor):
                    for column, value in zip(rows, (k, key, own, *about)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], columns)

    schema = f"k int, key long, {prefix}_own int, {prefix}_vendor string, {prefix}_size int, {prefix}_letters long"
    return names.select("vendor", "tokens").mapInArrow(post, schema)


def _weight(token: Column) -> Column:
    return F.length(token) + 1


def _by_tokens(names: DataFrame) -> DataFrame:
    """Rows vendor, token and the weight of all tokens."""
    whole = F.aggregate("tokens", F.lit(0), lambda s, t: s + _weight(t))
    return names.select("vendor", whole.alias("whole"), F.explode("tokens").alias("token"))


def _rare_tokens(listed: DataFrame, counts: DataFrame, floor: float) -> DataFrame:
    """The rarest tokens of each name, as long as they and the commoner ones could be shared for the floor."""
    onward = F.sum(_weight(F.col("token"))).over(
        Window.partitionBy("vendor").orderBy(F.desc("n"), F.desc("token")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    needed = floor / (2 - floor) * (F.col("whole") - 1) + 1
    return listed.join(counts, "token").withColumn("onward", onward).where(F.col("onward") >= needed - 1e-9).select("vendor", "token")


def name_pairs(tx_names: DataFrame, pay_names: DataFrame, floor: float) -> DataFrame:
    """Distinct pairs (t_vendor, p_vendor) of which every pair at ``floor`` or more is one.

    The frames have one column of distinct, stripped, non-blank names.
    """
    if floor <= LEAST_FLOOR:
        raise ValueError(f"names are indexed for similarities above {LEAST_FLOOR}")
    sides = {
        end: names.select(F.col(names.columns[0]).alias("vendor"), F.array_sort(tokens(F.col(names.columns[0]))).alias("tokens"))
        for end, names in (("t", tx_names), ("p", pay_names))
    }
    both = sides["t"].unionByName(sides["p"])
    letters = _letter_counts(both)
    by_letters = {end: _by_letters(names, end, letters, floor) for end, names in sides.items()}
    apart = (1 - floor) * (F.col("t_size") + F.col("p_size")) + 1e-9
    met = by_letters["t"].join(by_letters["p"], ["k", "key"]).where(
        (F.least("t_own", "p_own") == F.col("k")) & (F.abs(F.col("t_size") - F.col("p_size")) <= apart)
        & (F.bit_count(F.col("t_letters").bitwiseXOR(F.col("p_letters"))) <= apart))
    listed = {end: _by_tokens(names) for end, names in sides.items()}
    counts = listed["t"].unionByName(listed["p"]).groupBy("token").agg(F.count("*").alias("n"))
    found = [met]
    for end, other in (("t", "p"), ("p", "t")):
        rare = _rare_tokens(listed[end], counts, floor).withColumnRenamed("vendor", f"{end}_vendor")
        found.append(rare.join(listed[other].select("token", F.col("vendor").alias(f"{other}_vendor")), "token"))
    found.append(sides["t"].select(F.col("vendor").alias("t_vendor"), F.lower("vendor").alias("lower")).join(
        sides["p"].select(F.col("vendor").alias("p_vendor"), F.lower("vendor").alias("lower")), "lower"))
    return reduce(DataFrame.unionByName, [f.select("t_vendor", "p_vendor") for f in found]).distinct()


def similar_names(tx_names: DataFrame, pay_names: DataFrame, floor: float) -> DataFrame:
    """Rows t_vendor, p_vendor and vendor_sim of all pairs at ``floor`` or more.

    Written to the shared folder: the size decides how later joins run, and the filter stays above ``distinct``.
    """
    pairs = name_pairs(materialize(tx_names, "t-names"), materialize(pay_names, "p-names"), floor)
    compared = pairs.withColumn("vendor_sim", vendor_similarity(F.col("t_vendor"), F.col("p_vendor")))
    return materialize(compared, "vendor-pairs").filter(F.col("vendor_sim") >= floor)
