"""SimHash near duplicates by a byte-position inverted index with count filtering.

A fingerprint has a bit where more than half of the hashes of a text's word shingles have it.
Two fingerprints that differ in at most three bits differ in at most three of their eight
bytes, so they share at least five positional bytes.  A posting list for one positional byte
would hold a 256th of all fingerprints, so the index posts sets of four positional bytes: the
14 sets form a Steiner system S(3, 4, 8), in which any three positions are avoided by some set,
so each such pair meets in a list of fingerprints that agree in 32 bits.  For each pair in a
list the shared positional bytes are tallied, pairs with at least five are kept, and their
differing bits are counted.

Lists longer than ``LONGEST_LIST`` are not paired up.  Their fingerprints are spread to all
values within two bits instead: two fingerprints within three bits have a value within one bit
of one and two bits of the other.  At each value, its least fingerprint within one bit is linked
to the rest, which keeps connectedness with rows in proportion to the fingerprints.

Equal fingerprints are grouped first, so copies are never paired.

Defined results: a null text is empty; a text without words has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle of all of them; repeated rows and
rows with a null id keep their rows (a component of null ids only has a null component); very
long texts are hashed whole, in steps of bounded memory; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import fresh, whole_text
from ledgerline.llm.components import components
from ledgerline.session import materialize, scratch, scratch_scope, ship_functions

RADIUS = 3
SEED = 42
LONGEST_LIST = 256

#: Sets of four byte positions; any three positions are avoided by one of them.
POSITION_SETS = tuple(s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0)

ship_functions(__name__)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each shingle of a text; words are split at white space, A-Z in lower case."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    one = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([one(b" ".join(found), SEED)], np.uint64)
    return np.array([one(b" ".join(s), SEED) for s in zip(*[found[i:] for i in range(words)])], np.uint64)


def fingerprint_bits(hashes: np.ndarray) -> int:
    """64 bits, each set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[start:start + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3) -> tuple[DataFrame, str]:
    """The frame with one more column, the fingerprint as a long; and its name."""
    import pyarrow as pa

    (name,) = fresh(docs, "fingerprint")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint_bits(shingle_hashes(x.as_py(), words)) for x in batch.column(batch.schema.get_field_index(text_col))]
            signed = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, signed], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema), name


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(0xFF)


def _mask(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << 8 * p for p in positions)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _tally(a: Column, b: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    differing = a.bitwiseXOR(b)
    same = [F.when(_byte(differing, p) == 0, 1).otherwise(0) for p in range(8)]
    return sum(same[1:], same[0])


def links_within(prints: DataFrame, radius: int = RADIUS, longest: int = LONGEST_LIST) -> DataFrame:
    """Links u, v between the distinct fingerprints (column ``print``) within so many bits, at most three.

    All pairs within the radius, but for pairs that meet in long lists only: of those, enough to
    connect the same fingerprints.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the position sets guarantee radius 0 to 3")
    posted = prints.select("print", F.explode(F.array(*[
        F.struct(F.lit(i).alias("s"), F.col("print").bitwiseAND(_mask(s)).alias("k")) for i, s in enumerate(POSITION_SETS)
    ])).alias("p")).select("p.s", "p.k", "print")
    lists = posted.groupBy("s", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(posted.join(lists, ["s", "k"]), "postings")
    short = shared.where(F.col("n") <= longest).select("s", "k", "print")
    a, b = short.withColumnRenamed("print", "u"), short.withColumnRenamed("print", "v")
    differing = F.col("u").bitwiseXOR(F.col("v"))
    close = (_tally(F.col("u"), F.col("v")) >= 8 - radius) & (F.bit_count(differing) <= radius)
    pairs = a.join(b, ["s", "k"]).where(F.col("u") < F.col("v")).where(close).select("u", "v")
    return pairs.unionByName(_spread(shared.where(F.col("n") > longest).select("print").distinct(), radius)).distinct()


def _spread(prints: DataFrame, radius: int) -> DataFrame:
    """Links within the radius by common values within two bits; rows in proportion to the fingerprints."""
    one = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), (i - 1).cast("int")))
    flipped = (
        prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
        .select("print", "i", F.explode(F.sequence(F.lit(0), F.greatest(F.col("i") - 1, F.lit(0)))).alias("j"))
        .select("print", F.col("print").bitwiseXOR(one(F.col("i"))).bitwiseXOR(one(F.col("j"))).alias("value"),
                ((F.col("i") > 0).cast("int") + (F.col("j") > 0).cast("int")).alias("bits"))
    )
    centers = flipped.where("bits <= 1").groupBy("value").agg(F.min("print").alias("u"))
    met = flipped.join(centers, "value").where(F.col("u") != F.col("print"))
    return met.where(F.bit_count(F.col("u").bitwiseXOR(F.col("print"))) <= radius).select(
        F.least("u", "print").alias("u"), F.greatest("u", "print").alias("v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    radius: int = RADIUS) -> DataFrame:
    """Rows id, fingerprint (long), component_id (least id reachable): one for each row of docs."""
    only = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    printed, name = fingerprints(only, "_text", words)
    rows = materialize(printed.select("_id", F.col(name).alias("print")), "simhash")
    classes = rows.groupBy("print").agg(F.min("_id").alias("least"))
    roots = components(links_within(rows.select("print").distinct(), radius))
    labelled = classes.join(roots, classes["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "root").select("print", "component_id")
    return rows.join(named, "print").select(F.col("_id").alias(id_col), F.col("print").alias("fingerprint"), "component_id")


# Groups of similar texts: five-word shingles, similarity 0.8.

#: Bytes of a long fingerprint, how many positional bytes make a posting, and how many postings there are.
LONG_BYTES, POSTED_BYTES, POSTINGS = 128, 3, 128
#: Fewest positional bytes that a pair must share before its bits are compared.
LEAST_SHARED = 12
#: What the similarity that long fingerprints show is off by at most, nearly always.
MARGIN = 0.06
#: Longs of parity bits of a set of shingles.
PARITIES = 8
#: Shingles are ordered by the counts of so many buckets over one in so many texts.
ORDER_BUCKETS, ORDER_SAMPLE = 1 << 18, 8

_MIX = np.random.Generator(np.random.PCG64(SEED)).integers(1, 1 << 63, LONG_BYTES // 8, np.uint64) | np.uint64(1)
_PLACES = np.array([[i, (i + 37) % LONG_BYTES, (i + 90) % LONG_BYTES] for i in range(POSTINGS)])


def long_fingerprint(hashes: np.ndarray) -> bytes:
    """LONG_BYTES * 8 bits, each set in over half of the shingles, from more hashes of each shingle."""
    counts = np.zeros(8 * LONG_BYTES, np.int64)
    for start in range(0, len(hashes), 2048):  # bounded memory for very long texts
        h = hashes[start:start + 2048, None] * _MIX
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        counts += np.unpackbits(h.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def most_bits(similarity: float) -> int:
    """Differing bits of two long fingerprints whose shingle sets have this Jaccard similarity."""
    cosine = 2 * similarity / (1 + similarity)
    return round(8 * LONG_BYTES * np.arccos(cosine) / np.pi)


def _posted(prints: DataFrame) -> DataFrame:
    """Rows posting, node, root: the sets of positional bytes of each long fingerprint (columns node, root, print)."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                data = np.frombuffer(b"".join(part.column("print").to_pylist()), np.uint8).reshape(-1, LONG_BYTES)
                keys = np.arange(POSTINGS, dtype=np.int64)[None, :]
                for k in range(POSTED_BYTES):
                    keys = keys << 8 | data[:, _PLACES[:, k]]
                named = [np.repeat(part.column(c).to_numpy(zero_copy_only=False), POSTINGS) for c in ("node", "root")]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *map(pa.array, named)], names=["posting", "node", "root"])

    return prints.select("node", "root", "print").mapInArrow(run, "posting long, node long, root long")


def _compared(pairs: DataFrame, bits: int) -> DataFrame:
    """Rows u, v, bits: pairs whose prints (columns a, b) share enough positional bytes and differ in at most so many bits."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, LONG_BYTES) for c in "ab")
            differing = a ^ b
            n = np.bitwise_count(differing).sum(axis=1, dtype=np.int64)
            near = ((differing == 0).sum(axis=1) >= LEAST_SHARED) & (n <= bits)
            columns = [*batch.select(["u", "v"]).columns, pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "bits"]).filter(pa.array(near))

    return pairs.mapInArrow(run, "u long, v long, bits long")


def jaccard(a: str | None, b: str | None, words: int) -> float:
    """Jaccard similarity of the shingle sets of two texts."""
    x, y = (set(shingle_hashes(t, words).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def _similar(pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Pairs u, v whose texts (columns a, b) have this similarity."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [jaccard(a.as_py(), b.as_py(), words) >= similarity for a, b in zip(batch.column("a"), batch.column("b"))]
            yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    return pairs.mapInArrow(run, "u long, v long")


def similar_pairs(prints: DataFrame, similarity: float, neighbours: int, postings: int = POSTINGS) -> DataFrame:
    """Rows u, v, bits: nodes of different roots whose long fingerprints (columns node, root, print) show this similarity.

    Texts meet where they share a set of positional bytes, of the first so many sets, and each
    is compared with so many before it in such a list.
    """
    ordered = Window.partitionBy("posting").orderBy("node")
    before = F.array_compact(F.array(*[F.lag(F.struct("node", "root"), k).over(ordered) for k in range(1, neighbours + 1)]))
    posted = _posted(prints).where(F.shiftright("posting", 8 * POSTED_BYTES) < postings)
    met = posted.select("node", "root", before.alias("before")).where(F.size("before") > 0)
    others = met.select("node", F.filter("before", lambda x: x["root"] != F.col("root")).alias("others"))
    pairs = others.where(F.size("others") > 0).select("node", F.explode("others.node").alias("u"))
    tallied = pairs.groupBy("u", F.col("node").alias("v")).agg(F.count(F.lit(1)).alias("shared"))
    a = prints.select(F.col("node").alias("u"), F.col("print").alias("a"))
    b = prints.select(F.col("node").alias("v"), F.col("print").alias("b"))
    return _compared(tallied.join(a, "u").join(b, "v").select("u", "v", "a", "b"), most_bits(similarity))


def shingle_counts(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """In how many texts of a sample the shingles of each of ``ORDER_BUCKETS`` buckets are: a table of fixed size."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ORDER_BUCKETS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                counts += np.bincount(_order_bucket(np.unique(shingle_hashes(x.as_py(), words))), minlength=ORDER_BUCKETS)
        used = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    sample = docs.select(text_col).where(F.pmod(F.xxhash64(text_col), F.lit(ORDER_SAMPLE)) == 0)
    found = sample.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(ORDER_BUCKETS, np.int64)
    table[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return table


def _order_bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(ORDER_BUCKETS - 1)).astype(np.int64)


def prefix(unique: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a text, rare ones first: two texts of this similarity share one of them.

    They have at least similarity * size shingles in common, so the first common one in the order
    comes before so many others of either text.  Any order that all texts share will do.
    """
    order = np.lexsort((unique, counts[_order_bucket(unique)]))
    return unique[order[:len(unique) - math.ceil(similarity * len(unique) - 1e-6) + 1]]


def shingle_digest(unique: np.ndarray) -> bytes:
    """Of the set of shingles, so that only texts of equal sets have it in common."""
    return xxhash.xxh3_128_digest(unique.tobytes())


def parities(unique: np.ndarray) -> np.ndarray:
    """Of each of PARITIES * 64 parts of the hashes whether an odd number of shingles falls in it, as longs.

    A shingle that only one of two texts has changes one of these bits, so texts differ in at least
    as many shingles as bits.
    """
    odd = np.bincount(((unique >> np.uint64(40)) % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def met_pairs(marks: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Rows u, v, shared: every pair of nodes of different roots that may have this similarity.

    marks has node, size, parities and prefix.  Nodes meet where their prefixes share a shingle, so no
    pair of this similarity is left out; pairs go, where they meet, by bounds that hold for all of them.
    """
    rooted = marks.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "size", "prefix")
    posted = rooted.select("node", "root", "size", F.posexplode("prefix").alias("place", "shingle"))
    of_one = Window.partitionBy("shingle")
    several = materialize(posted.withColumn("least", F.min("root").over(of_one)).withColumn("most", F.max("root").over(of_one)).where(
        "least < most").drop("least", "most"), "shared-prefixes")
    # Only what is shared carries the bits, as single columns, which keeps the condition of the join small enough to be compiled.
    bits = [f"bits{i}" for i in range(PARITIES)]
    several = several.join(marks.select("node", *[F.coalesce(F.get("parities", i), F.lit(0)).alias(c) for i, c in enumerate(bits)]), "node")
    a, b = (several.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "root", "size", "place", *bits)]) for x in "uv")
    both = F.col("size_u") + F.col("size_v")
    sizes = F.least("size_u", "size_v") >= similarity * F.greatest("size_u", "size_v") - 1e-6
    # The first shingle that a pair has in common, in the order, comes before all others: they are at most
    # this one and those after it.  A pair of this similarity passes at its first one, wherever else it fails.
    most = F.least(F.col("size_u") - F.col("place_u"), F.col("size_v") - F.col("place_v"))
    enough = most >= similarity / (1 + similarity) * both - 1e-6
    differing = reduce(Column.__add__, [F.bit_count(F.col(f"{c}_u").bitwiseXOR(F.col(f"{c}_v"))) for c in bits])
    few = differing <= (1 - similarity) / (1 + similarity) * both + 1e-6
    pairs = a.join(b, "shingle").where((F.col("node_u") < F.col("node_v")) & (F.col("root_u") != F.col("root_v")) & sizes & enough & few)
    return pairs.groupBy(F.col("node_u").alias("u"), F.col("node_v").alias("v")).agg(F.count(F.lit(1)).alias("shared"))


def settle(links: DataFrame, marks: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Rows node, root after every pair of this similarity is linked, from the links found so far.

    Of the pairs that may be similar, the one that shares most for each node is compared first; then
    all that still are in different groups are.
    """
    roots = components(links)
    pairs = materialize(met_pairs(marks, roots, similarity), "met-pairs")
    best = pairs.groupBy("v").agg(F.max_by("u", "shared").alias("u")).select("u", "v")
    for asked in (best, pairs.select("u", "v")):
        links = materialize(links.unionByName(_confirmed(asked, roots, texts, words, similarity)), "links-so-far")
        roots = components(links)
    return roots


def _confirmed(pairs: DataFrame, roots: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Of the pairs u, v that would join different groups, those whose texts have this similarity."""
    root = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    asked = materialize(pairs.join(root("u"), "u", "left").join(root("v"), "v", "left").where(
        F.coalesce("u_root", "u") != F.coalesce("v_root", "v")).select("u", "v"), "unsure-pairs")
    nodes = asked.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    said = materialize(texts.join(nodes, "node", "left_semi").select("node", "text"), "asked-texts")
    a = said.select(F.col("node").alias("u"), F.col("text").alias("a"))
    b = said.select(F.col("node").alias("v"), F.col("text").alias("b"))
    return _similar(asked.join(a, "u").join(b, "v").select("u", "v", "a", "b"), words, similarity)


def similar_groups(prints: DataFrame, marks: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Rows node, root of nodes that have similar ones; prints has node and print, texts node and text.

    First each text is compared with the one before it in half of its lists, which connects
    most of a group, however large, by pairs in proportion to its texts.  That only saves pairs:
    what it leaves in different groups is settled exactly.
    """
    rooted = prints.select("node", "print", F.col("node").alias("root"))
    pairs = materialize(similar_pairs(rooted, similarity - MARGIN, 1, POSTINGS // 2), "similar-pairs")
    return settle(_links(pairs, texts, words, similarity), marks, texts, words, similarity)


def _links(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links u, v whose texts have this similarity, of pairs u, v, bits: for each v the nearest u before it.

    These are at most as many as texts, and enough to span a group whose members are that near.
    """
    nearest = pairs.groupBy("v").agg(F.min(F.struct("bits", "u")).alias("near")).select("near.u", "v")
    none = nearest.select(F.col("u").alias("node"), F.col("u").alias("root")).limit(0)
    return materialize(_confirmed(nearest, none, texts, words, similarity), "links-so-far")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs without near copies: of each group of similar texts, the row with the least id.

    Texts of fewer words than a shingle are one shingle; texts without words are one group.
    Null ids come last.
    """
    import pyarrow as pa

    name, digest, size, parts, first, row = fresh(docs, "long_fingerprint", "digest", "size", "parities", "prefix", "row")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType()), T.StructField(digest, T.BinaryType()), T.StructField(size, T.LongType()),
                           T.StructField(parts, T.ArrayType(T.LongType())), T.StructField(first, T.ArrayType(T.LongType()))])
    shared = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, text_col, words))

    def marks_of(text: str | None) -> tuple:
        hashes = shingle_hashes(text, words)
        unique = np.unique(hashes)
        return long_fingerprint(hashes), shingle_digest(unique), len(unique), parities(unique).tolist(), prefix(unique, shared.value, similarity).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            values = [marks_of(x.as_py()) for x in texts]
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            made = [pa.array([v[i] for v in values], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, name, digest, size, parts, first])

    # Written, so that row numbers stay.
    rows = materialize(docs.mapInArrow(run, schema).withColumn(row, F.monotonically_increasing_id()), "long-fingerprints")
    order = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    # What the steps below write is not needed once the groups are known.
    found = scratch(docs.sparkSession, "kept")
    with scratch_scope(docs.sparkSession, "near-dedup"):
        # Texts of equal shingle sets are one node; their fingerprints may differ where shingles repeat.
        classes = materialize(rows.groupBy(digest).agg(
            F.min(F.struct(F.col(row).alias("node"), F.col(name).alias("print"))).alias("c"), F.min(order).alias("first"),
        ).select("c.node", "c.print", "first"), "classes")
        texts = rows.select(F.col(row).alias("node"), F.col(text_col).alias("text"))
        marks = rows.select(
            F.col(row).alias("node"), F.col(size).alias("size"), F.col(parts).alias("parities"), F.col(first).alias("prefix")
        ).join(classes.select("node"), "node", "left_semi")
        roots = similar_groups(classes, marks, texts, words, similarity)
        groups = classes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("group")).agg(F.min("first").alias("first"))
        groups.select(F.col("first.row").alias(row)).write.parquet(found)
    kept = docs.sparkSession.read.schema(T.StructType([T.StructField(row, T.LongType())])).parquet(found)
    return rows.join(kept, row, "left_semi").drop(name, digest, size, parts, first, row)
