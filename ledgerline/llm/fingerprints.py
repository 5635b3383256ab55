"""Document fingerprints by consistent weighted sampling.

A text is a bag of lower-cased words weighted by how often they occur.  For each sample, every
weighted term draws r and c from Gamma(2, 1) and b from a uniform distribution, all fixed by the
term's hash; t = floor(ln w / r + b) quantises its weight and ln a = ln c - r (t - b + 1) is its
value.  The term with the least value is the sample, and (term, t) its component of the
signature.  Two signatures agree in a component with a probability equal to the generalised
Jaccard similarity, sum of least weights over sum of greatest weights.

Everything is a DataFrame expression: words are exploded, counted and reduced to one least
value for each sample; all of it within the partitioning by text, so nothing but texts is
shuffled, and no group is gathered.

Defined results: a null text is empty; a text without words has the one term "", so all such
texts have equal fingerprints.  Equal texts have equal fingerprints.  Repeated rows (same id and
same text) count once in the order and keep all their rows in the result; rows with one id and
different texts are ordered by the hash of the text; null ids come last.  Other columns are
ignored.  Very long texts are taken whole, as terms with their counts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import whole_text, word_array
from ledgerline.session import materialize

SAMPLES = 32

#: Hexadecimal digits of a component.
DIGITS = 4


def _uniform(bits: Column) -> Column:
    """Open interval (0, 1) from 24 bits."""
    return (bits.cast("double") + 0.5) / float(1 << 24)


def _packed_sample(term: Column, log_weight: Column, sample: int) -> Column:
    """A long: 31 bits of the sample's value, ordered, above 32 bits of the hash of (term, t)."""
    first, second = F.xxhash64(term, F.lit(2 * sample)), F.xxhash64(term, F.lit(2 * sample + 1))
    low = (1 << 24) - 1
    r = -F.ln(_uniform(F.shiftrightunsigned(first, 40)) * _uniform(F.shiftrightunsigned(first, 16).bitwiseAND(low)))
    c = -F.ln(_uniform(F.shiftrightunsigned(second, 40)) * _uniform(F.shiftrightunsigned(second, 16).bitwiseAND(low)))
    b = (F.shiftleft(first.bitwiseAND(0xFF), 8) + second.bitwiseAND(0xFF) + 0.5) / 65536.0
    t = F.floor(log_weight / r + b)
    value = F.ln(c) - r * (t - b + 1)
    ordered = ((value + 64.0) * float(1 << 24)).cast("long")  # within 0 and 2^31 for all weights below e^12
    component = F.xxhash64(term, t, F.lit(sample)).bitwiseAND(0xFFFFFFFF)
    return F.shiftleft(F.greatest(ordered, F.lit(0)), 32).bitwiseOR(component)


def signatures(terms: DataFrame, keys: list[str], term: str, weight: str, samples: int = SAMPLES) -> DataFrame:
    """The keys and ``fingerprint`` of weighted terms, one row for each term of a key."""
    logged = terms.select(*keys, F.col(term).alias("_term"), F.ln(F.col(weight).cast("double")).alias("_log"))
    least = logged.groupBy(*keys).agg(*[
        F.min(_packed_sample(F.col("_term"), F.col("_log"), i)).alias(f"_s{i}") for i in range(samples)
    ])
    digits = [F.lpad(F.lower(F.hex(F.col(f"_s{i}").bitwiseAND((1 << 4 * DIGITS) - 1))), DIGITS, "0") for i in range(samples)]
    return least.select(*keys, F.concat(*digits).alias("fingerprint"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of components in which two fingerprints agree: estimates generalised Jaccard similarity."""
    part = lambda x, i: F.substring(x, 1 + DIGITS * i, DIGITS)
    same = [F.when(part(a, i) == part(b, i), 1).otherwise(0) for i in range(samples)]
    return sum(same[1:], same[0]) / float(samples)


def fingerprint_texts(texts: DataFrame, keys: list[str], text_col: str, samples: int = SAMPLES) -> DataFrame:
    """The keys and ``fingerprint``, one row for each key."""
    words = texts.select(*keys, F.explode(word_array(F.lower(F.col(text_col)))).alias("_word"))
    terms = words.select(*keys, F.xxhash64("_word").alias("_term")).groupBy(*keys, "_term").agg(F.count(F.lit(1)).alias("_weight"))
    return signatures(terms, keys, "_term", "_weight", samples)


def successors(keys: DataFrame, order: list[str]) -> DataFrame:
    """Distinct keys with ``next_`` columns: the next in descending order of the columns, nulls last, the first after the last.

    Keys are sorted into ranges and written; each range looks ahead, and its last key takes the
    first of the next range, of which there are as many as partitions.
    """
    sort = [F.col(c).desc_nulls_last() for c in order]
    ranged = keys.repartitionByRange(*sort).select("*", F.spark_partition_id().alias("_range"))
    stored = materialize(ranged, "ordered-keys")
    nexts = F.struct(*order)
    heads = stored.groupBy("_range").agg(F.max_by(nexts, _descending(order)).alias("_head"))
    ring = heads.select(
        "_range",
        F.coalesce(
            F.lead("_head").over(Window.orderBy("_range")),
            F.first("_head").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("_after"),
    )
    looked = stored.withColumn("_next", F.lead(nexts).over(Window.partitionBy("_range").orderBy(*sort)))
    joined = looked.join(F.broadcast(ring), "_range")  # as many rows as partitions
    after = F.coalesce("_next", "_after")
    return joined.select(*keys.columns, *[after[c].alias(f"next_{c}") for c in order])


def _descending(order: list[str]) -> Column:
    """What is greatest for the first key: nulls are least in a struct."""
    return F.struct(*order)


def edit_and_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Every text and its edited text, fingerprinted and compared.

    The edited text has its last floor(n / 2) code points replaced by as many (or all) of the
    next text's first.  Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    # (_id, _h) is never null and tells rows apart by id and text.
    rows = docs.select(F.col(id_col).alias("_doc"), whole_text(text_col).alias("_text")).select(
        F.coalesce("_doc", F.lit(0)).cast("long").alias("_id"), F.col("_doc").isNull().alias("_null"),
        F.xxhash64(F.col("_doc").isNull(), "_text").alias("_h"), "_text",
    )
    counted = rows.select("_id", "_null", "_h", F.length("_text").alias("_n")).groupBy("_null", "_id", "_h", "_n").agg(
        F.count(F.lit(1)).alias("_copies"))
    ordered = successors(
        counted.select("*", F.when(~F.col("_null"), F.col("_id")).alias("_doc")), ["_doc", "_h"],
    ).select("_id", "_h", "_n", "_copies", "_doc", F.coalesce("next__doc", F.lit(0)).cast("long").alias("_next_id"),
             F.col("next__h").alias("_next_h"))
    links = materialize(ordered, "next-texts")

    # One row for each distinct key, in the partitioning by key.
    first = F.lag(F.lit(1)).over(Window.partitionBy("_id", "_h").orderBy("_id")).isNull()
    distinct = rows.select("_id", "_h", "_text").withColumn("_first", first).where("_first").drop("_first")
    heads = distinct.withColumnsRenamed({"_id": "_next_id", "_h": "_next_h"}).join(links, ["_next_id", "_next_h"]).select(
        "_id", "_h", "_n", "_copies", "_doc", "_next_id", "_next_h",
        F.substr("_text", F.lit(1), F.floor(F.col("_n") / 2).cast("int")).alias("_head"),
    )
    edited = distinct.join(heads, ["_id", "_h"]).withColumn("_edited", F.concat(
        F.substr("_text", F.lit(1), (F.col("_n") - F.floor(F.col("_n") / 2)).cast("int")), "_head"))
    keys = ["_id", "_h"]
    both = edited.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("_text").alias("text")),
        F.struct(F.lit(1).alias("which"), F.col("_edited").alias("text")),
    )).alias("_v")).select(*keys, F.col("_v.which").alias("_which"), F.col("_v.text").alias("_text"))
    prints = fingerprint_texts(both, [*keys, "_which"], "_text", samples).groupBy(*keys).agg(
        F.max(F.when(F.col("_which") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("_which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    about = edited.select(*keys, "_n", "_copies", "_doc", "_next_id", "_next_h", F.sha2("_edited", 256).alias("edited_sha256"))
    made = materialize(about.join(prints, keys), "fingerprints")
    nexts = made.select(F.col("_id").alias("_next_id"), F.col("_h").alias("_next_h"), F.col("fingerprint").alias("_next_fingerprint"))
    result = made.join(nexts, ["_next_id", "_next_h"]).select(
        F.col("_doc").alias(id_col), F.col("_n").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_fingerprint"), samples).alias("near_next"), "_copies",
    )
    return result.select("*", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).drop("_copies", "_copy")
