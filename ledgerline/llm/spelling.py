"""Spelling variants: words one edit apart, found by pivotal bigrams, and the usual form of each.

Bigrams are ordered by how many places of words hold them, rare ones first.  A word's *prefix* is its
three first bigrams in that order, places of equal bigrams counted singly.  Of two words one edit apart
take the one whose prefix ends first in the order: a bigram of its prefix that the edit leaves is in the
other's prefix as well, as that ends later.  A word's two *pivots* are disjoint bigrams of its prefix,
the cheapest such pair by dynamic programming over places.  An edit lies behind the first pivot or before
the second, since they are disjoint.

Position limits: behind the first pivot, so all up to its end is the same in both words; or before the
second, so all from it on is.  Where that side is short, the other one is halved: the edit lies behind its
first half or before the rest, so one of them is the same too.  The index posts, for each bigram of a word's
prefix, the start and end that a partner would share in each of these cases, with the letters left over
between them; pivots look the same up.  Words decide: what meets is verified on the letters left over.

A bigram that a word repeats counts in its three places nearest to either side, enough for the partner's
prefix, so a word has a bounded number of postings however long it is.  Words are numbered by falling
occurrences, so that the near word of least number is the usual form; following forms to the last, where
each has ``RATIO`` times the occurrences of the one before, doubling ends after a few joins.

Texts are split and counted with combination before the shuffle.  Joins are on shared letters and on
numbers and are split by the skew join; a word has no more near words than letters have places and kinds.
They are merge joins by hint: Spark would size the postings by the compressed file of the words, a few
thousandths of what they hold in memory, and send them through the driver to be broadcast.  The bigrams
of the alphabet, at most its size squared, are the only thing that the driver sees.

Defined results: null and empty texts have no words; a null id counts as an empty one; very long texts
and words are taken whole; repeated rows count as further occurrences; ties among near words go to the
smallest in code-point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import whole_text
from ledgerline.session import materialize, ship_functions

ship_functions(__name__)

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
SLIP = 31
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PREFIX = 3  # one edit destroys two bigrams at most
LONG = 6  # letters of a shared side that need no half of the other side

Place = tuple[int, int]  # of a bigram: in the order, in the word


def lowered_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST_LETTERS) -> DataFrame:
    """The rows of docs with one more column, run, for each run of at least so many letters; only A-Z is lower-cased."""
    runs = F.regexp_extract_all(whole_text(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), 0)
    return docs.select("*", F.explode(runs).alias("run")).withColumn("run", F.translate("run", UPPER, LOWER))


def with_slips(run: Column, key: Column, every: int = SLIP) -> Column:
    """The run, or for one in so many pairs of key and run, by their CRC-32, the run without one code point."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def count_words(words: DataFrame, word_col: str = "word", least: int = LEAST_LETTERS, often: int = LEAST_COUNT) -> DataFrame:
    """Rows word and n of words that are long (four letters at least) and frequent enough."""
    if least < PREFIX + 1:
        raise ValueError(f"words need {PREFIX + 1} letters at least")
    counted = words.where(F.length(word_col) >= least).groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= often)


def numbered(words: DataFrame) -> DataFrame:
    """Words with an id that grows as occurrences fall, and with the word among equals; written, so that it stays."""
    known = materialize(words.select("word", "n"), "words")
    return materialize(known.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()), "numbered")


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """In how many places of distinct words each bigram is; there are no more than the alphabet has pairs of letters."""

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        total: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                total.update(map(str.__add__, word, word[1:]))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["gram", "n"])

    counted = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in counted.collect()}


def prefix_of(word: str, order: dict[str, int]) -> tuple[list[Place], list[Place], int]:
    """Places of the first bigrams in the order, of equal ones those nearest to the start or to the end; and where the prefix ends."""
    grams = sorted((order[g], i) for i, g in enumerate(map(str.__add__, word, word[1:])))
    ends = grams[PREFIX - 1][0]
    from_start: list[Place] = []
    from_end: list[Place] = []
    for _, equal in groupby(takewhile(lambda g: g[0] <= ends, grams), key=lambda g: g[0]):
        places = list(equal)
        from_start += places[:PREFIX]
        from_end += places[-PREFIX:]
    return from_start, from_end, ends


def pivots_of(from_start: list[Place], from_end: list[Place], cost: list[int]) -> tuple[int, int]:
    """Places of the cheapest pair of disjoint bigrams, the first from the start, the second from the end.

    Going along the word, the best pair so far ends here or is the one before; what a pair that ends
    here begins with is the cheapest bigram that ends before it.
    """
    firsts = sorted((i, cost[g]) for g, i in from_start)
    best, cheapest, at = None, None, 0
    for place, price in sorted((i, cost[g]) for g, i in from_end):
        while at < len(firsts) and firsts[at][0] + 2 <= place:
            if cheapest is None or firsts[at][1] < cheapest[0]:
                cheapest = firsts[at][1], firsts[at][0]
            at += 1
        if cheapest is not None and (best is None or cheapest[0] + price < best[0]):
            best = cheapest[0] + price, cheapest[1], place
    return best[1:]


def shared_before(word: str, end: int) -> set[tuple[int, int]]:
    """Lengths of the start and the end that a word one edit away, made behind the first letters, may share."""
    rest = len(word) - end
    if end >= LONG:
        return {(end, 0)}
    # by the letters behind in the shorter word, one less than here or as many
    return {case for t in (rest - 1, rest) if t >= 0 for case in ((end + t // 2, 0), (end, t - t // 2))}


def shared_behind(word: str, place: int) -> set[tuple[int, int]]:
    """The same for an edit made before a place."""
    return {(start, end) for end, start in shared_before(word, len(word) - place)}


def posts(word: str, cases: set[tuple[int, int]]) -> Iterator[tuple[str, str]]:
    """What is shared, and the letters left over between."""
    for start, end in cases:
        yield f"{word[:start]}|{word[len(word) - end:]}", word[start:len(word) - end]


def index_of(words: DataFrame, order: dict[str, int], cost: list[int], looking: bool) -> DataFrame:
    """Rows key, rest, id and ends of all words: what their pivots look up, or the postings of their prefixes."""

    def post(batches):
        import pyarrow as pa

        schema = pa.schema([("key", pa.string()), ("rest", pa.string()), ("id", pa.int64()), ("ends", pa.int32())])
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for word, number in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist()):
                from_start, from_end, ends = prefix_of(word, order)
                if looking:
                    first, second = pivots_of(from_start, from_end, cost)
                    cases = shared_before(word, first + 2) | shared_behind(word, second)
                else:
                    cases = set().union(*[shared_before(word, i + 2) for _, i in from_start], *[shared_behind(word, i) for _, i in from_end])
                for key, rest in posts(word, cases):
                    for column, value in zip(rows, (key, rest, number, ends)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return words.select("word", "id").mapInArrow(post, "key string, rest string, id long, ends int")


def near_pairs(words: DataFrame) -> DataFrame:
    """Rows a and b (ids), both ways and each once: pairs of words exactly one insertion, deletion or replacement apart."""
    counts = bigram_counts(words)
    ranked = sorted(counts, key=lambda g: (counts[g], g))
    order, cost = {g: i for i, g in enumerate(ranked)}, [counts[g] for g in ranked]
    looking = index_of(words, order, cost, True).select("key", *[F.col(c).alias(f"a_{c}") for c in ("rest", "id", "ends")])
    met = looking.hint("merge").join(index_of(words, order, cost, False), "key").where(
        "a_ends < ends OR a_ends = ends AND a_id < id").where(F.levenshtein("a_rest", "rest", 1) == 1)
    both = F.explode(F.array(F.struct(F.col("a_id").alias("a"), F.col("id").alias("b")), F.struct(F.col("id").alias("a"), F.col("a_id").alias("b"))))
    # All of a word's near words in one place: the pairs are reduced and grouped without another shuffle.
    return met.select(both.alias("pair")).select("pair.*").repartition("a").dropDuplicates(["a", "b"])


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Rows word, n, n_near, form, form_n and root of counted words (see ``count_words``)."""
    words = numbered(words)
    best = near_pairs(words).groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min("b").alias("top")).hint("merge")
    usual = words.select(F.col("id").alias("top"), F.col("word").alias("top_word"), F.col("n").alias("top_n"))
    found = F.col("top_n") >= ratio * F.col("n")
    judged = materialize(words.join(best.join(usual, "top"), F.col("id") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(found, F.col("top_word")).alias("form"), F.when(found, F.col("top_n")).alias("form_n")), "forms")
    steps = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps that a root is away
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = materialize(steps.hint("merge").join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return judged.hint("merge").join(steps.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
