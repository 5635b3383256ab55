"""Language-model scores by Katz backoff with Good-Turing discounts and exactly normalised weights.

An n-gram seen r times after its history loses e(r) of its count: Good-Turing's r - r* for r up to ``GT_UP_TO``
(half a count where that is not between 0 and r), and as much as the last of these beyond, so that every
history keeps some mass.  A seen word has probability (r - e(r)) / count of the history.  The lost mass of a
history goes to the words never seen after it, in proportion to their probability after the history without
its first word: that is its backoff weight, lost mass over the sum of those probabilities.  Below single
words, the mass they lost is that of one class of unknown words.  So probabilities of all words and the
unknown one sum to 1 after every history.  Histories begin with one start mark; the end is a token.

Work goes by blocks of whole texts.  A block is tokenised once into a table: hashes of its distinct words,
and its tokens as numbers of these.  It asks for the counts of its distinct n-grams of all lengths, each
once, with its own training counts: asking and counting are one shuffle, dealt by ranges of 64-bit n-gram
hashes, so a frequent n-gram is one row of each block at most.  Answers, the table of counts, go back to
the blocks, which add up the logarithms of all seen tokens, follow the unseen ones to shorter histories,
and list the weights that these need.  Each seen n-gram has one owning block, which adds it to the lost
mass and the seen probability of its history; grouped sums make the table of weights, stored by length of
the history, and joins bring them to the texts.

Logarithms are rounded to nine places before they are summed as whole numbers, so scores do not depend
on how rows were dealt out.  Two n-grams of equal hash would count as one: among 10^8 kinds that has a
chance of about 0.0003, among 10^13 it meets one kind in some millions.

Defined results: a null or empty text is scored as its end alone; a null id counts as an empty one;
a very long text is one block; repeated rows are counted and scored each; an empty training set leaves
probability 1 to the unknown class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import slices, whole_text
from ledgerline.session import scratch, ship_functions

ship_functions(__name__)

ORDER = 2
GT_UP_TO = 5
FOLDS, HELD_OUT = 5, 1

BLOCK_BYTES = 4 << 20  # text of a block
GROUP_TOKENS = 1 << 20  # tokens for each range of hashes
PLACES = 10 ** 9

#: No word holds white space.
START, END = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" ", b"\n"))


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def pack(values: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, compressed."""
    import pyarrow as pa

    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    import pyarrow as pa

    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def joined_hash(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of n-grams from that of all but the last word and that of the last."""
    x = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (last + np.uint64(0x7F4A7C15F39CC060))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def tokenised(texts: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Words of each text, hashes of the distinct words and the number of each token among these."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    sizes, tokens = [], []
    for text in texts:
        words = text.lower().split()
        sizes.append(len(words))
        tokens.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    return sizes, hashes, np.concatenate(tokens) if tokens else np.empty(0, np.uint32)


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows block, ids, held, sizes, words, tokens: the texts as numbers."""

    def encode(batches):
        import pyarrow as pa

        numbers = count(TaskContext.get().partitionId() << 32)
        listed = lambda column: pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                sizes, hashes, tokens = tokenised(part.column("text").cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([next(numbers)], pa.int64()), listed(part.column("id")), listed(part.column("held")),
                     listed(pa.array(sizes, pa.int64())), pa.array([pack(hashes)], pa.binary()), pa.array([pack(tokens)], pa.binary())],
                    ["block", "ids", "held", "sizes", "words", "tokens"])

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
        T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("words", T.BinaryType()), T.StructField("tokens", T.BinaryType())])
    coded = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held"), whole_text(text_col).alias("text"))
    return stored(coded.mapInArrow(encode, schema), "katz-blocks")


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Written to the shared folder, partitioned by some columns, and read back."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Block:
    """The n-grams of a block: for each length the distinct ones, sorted, and which one ends at each token."""

    def __init__(self, sizes: list[int], words: bytes, tokens: bytes, held: list[bool], order: int) -> None:
        sizes = np.asarray(sizes, np.int64)
        begins = np.cumsum(sizes + 2) - sizes - 2
        total = int((sizes + 2).sum())
        self.text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 2)
        self.offset = (np.arange(total) - begins[self.text]).astype(np.int32)
        marks = np.empty(total, np.uint64)
        inner = np.ones(total, bool)
        inner[begins], inner[begins + sizes + 1] = False, False
        marks[begins], marks[begins + sizes + 1] = START, END
        marks[inner] = unpack(words)[unpack(tokens).astype(np.int64)]
        train = ~np.asarray(held, bool)[self.text] if total else np.empty(0, bool)
        self.keys, self.first, self.at, self.n = [], [], [], []
        key = marks
        for k in range(1, order + 1):
            if k > 1:
                key = np.concatenate([key[:1], joined_hash(key[:-1], marks[1:])])
            valid = np.flatnonzero(self.offset >= k - 1)
            distinct, first, which = np.unique(key[valid], return_index=True, return_inverse=True)
            at = np.full(total, -1, np.int32)
            at[valid] = which
            self.keys.append(distinct)
            self.first.append(valid[first])
            self.at.append(at)
            self.n.append(np.bincount(which, train[valid], len(distinct)).astype(np.uint64))


def requests(state: DataFrame, order: int, bits: int) -> DataFrame:
    """Rows level, bucket, block, keys, n: the distinct n-grams of each block, by ranges of their hashes."""

    def ask(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["sizes"], row["words"], row["tokens"], row["held"], order)
                rows = []
                for level, (keys, n) in enumerate(zip(block.keys, block.n), 1):
                    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    used, starts = np.unique(bucket, return_index=True)
                    for b, lo, hi in zip(used, starts, [*starts[1:], len(keys)]):
                        rows.append((level, int(b), row["block"], pack(np.diff(keys[lo:hi], prepend=np.uint64(0))), pack(n[lo:hi])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["level", "bucket", "block", "keys", "n"])

    return state.mapInArrow(ask, "level long, bucket long, block long, keys binary, n binary")


def answers(asked: DataFrame) -> DataFrame:
    """Rows level, bucket, block, counts, owned: the counts in training of what each block asked for.

    Of the blocks that hold an n-gram the first one owns it.  One row of each range has its statistics.
    """

    def answer(table):
        import pyarrow as pa

        table = table.sort_by("block")
        asked_for = [np.cumsum(unpack(x), dtype=np.uint64) for x in table.column("keys").to_pylist()]
        given = np.concatenate([unpack(x) for x in table.column("n").to_pylist()])
        keys, first, which = np.unique(np.concatenate(asked_for), return_index=True, return_inverse=True)
        total = np.zeros(len(keys), np.uint64)
        np.add.at(total, which, given)
        owned = np.zeros(len(which), np.uint64)
        owned[first] = total > 0
        kinds = total[(total > 0) & (keys != START)]  # the start mark is no token
        stats = [len(kinds), int(kinds.sum()), *np.bincount(np.minimum(kinds, GT_UP_TO + 2).astype(np.int64), minlength=GT_UP_TO + 3)[1:GT_UP_TO + 2].tolist()]
        cuts = np.cumsum([len(x) for x in asked_for])[:-1]
        return pa.table({
            "level": table.column("level"), "bucket": table.column("bucket"), "block": table.column("block"),
            "counts": [pack(x) for x in np.split(total[which], cuts)], "owned": [pack(x) for x in np.split(owned, cuts)],
            "stats": pa.array([stats] + [None] * (len(table) - 1), pa.list_(pa.int64()))})

    schema = "level long, bucket long, block long, counts binary, owned binary, stats array<long>"
    return stored(asked.groupBy("level", "bucket").applyInArrow(answer, schema), "katz-counts", "level")


def good_turing(of_counts: list[int]) -> list[float]:
    """e(0), e(1) ...: what counts lose, from the numbers of kinds seen 1, 2 ... times; the last holds beyond."""
    n, up_to = [0, *of_counts], len(of_counts) - 1
    rest = (up_to + 1) * n[up_to + 1] / n[1] if n[1] else 1.0
    lost = [0.0]
    for r in range(1, up_to + 1):
        star = (r + 1) * n[r + 1] / n[r] / r if n[r] else 0.0
        kept = (star - rest) / (1 - rest) if rest < 1 else 0.0
        lost.append(r * (1 - kept) if 0 < kept < 1 else 0.5)
    return lost


def _rounded(logs: np.ndarray) -> np.ndarray:
    return np.rint(np.log10(logs) * PLACES).astype(np.int64)


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers whose groups are in order."""
    ends = np.concatenate([[0], np.cumsum(values)])
    cuts = np.searchsorted(group, np.arange(n + 1))
    return ends[cuts[1:]] - ends[cuts[:-1]]


def part_scores(state: DataFrame, counted: DataFrame, stats: dict[int, list[int]], order: int) -> DataFrame:
    """Rows of three kinds: texts with what seen tokens add up to, parts of histories, and weights that texts need."""
    kinds, tokens = stats[1][:2]
    lost = {k: np.array(good_turing(stats[k][2:])) for k in stats}
    loses = lambda level, r: lost[level][np.minimum(r, GT_UP_TO).astype(np.int64)]
    often = kinds - sum(stats[1][2:2 + GT_UP_TO])
    unknown = (sum(n * e for n, e in zip(stats[1][2:], lost[1][1:])) + often * lost[1][-1]) / tokens if tokens else 1.0
    id_type = state.schema["ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("block", T.LongType()), T.StructField("row", T.LongType()),
        T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base", T.LongType()), T.StructField("seen", T.LongType()),
        T.StructField("level", T.LongType()), T.StructField("key", T.LongType()), T.StructField("times", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("lost", T.DoubleType()), T.StructField("lower", T.DoubleType())])

    def score(table, counts):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        row = table.to_pylist()[0]
        block = Block(row["sizes"], row["words"], row["tokens"], row["held"], order)
        given = counts.select(["level", "bucket", "counts", "owned"]).sort_by([("level", "ascending"), ("bucket", "ascending")]).to_pylist()
        seen, owned = ([np.concatenate([unpack(g[column]) for g in given if g["level"] == k] or [np.empty(0, np.uint64)])
                        for k in range(1, order + 1)] for column in ("counts", "owned"))
        texts = len(row["sizes"])
        scored = block.offset > 0
        text, own = block.text[scored], [a[scored] for a in block.at]
        r = seen[0][own[0]]
        base = _sums(text, _rounded((r + 0.5) / (tokens + 0.5 * (kinds + 1))), texts)
        known = _sums(text, (r > 0).astype(np.int64), texts)
        parts = []
        # probabilities of the distinct n-grams of each length, where seen
        chances = [np.where(seen[0] > 0, (seen[0] - loses(1, seen[0])) / max(tokens, 1), unknown)]
        histories, needed = [None], []
        for k in range(2, order + 1):
            at = block.first[k - 1]
            history, shorter = block.at[k - 2][at - 1], block.at[k - 2][at]
            n = seen[k - 2][history]
            chances.append((seen[k - 1] - loses(k, seen[k - 1])) / np.maximum(n, 1))
            histories.append(history)
            mine = owned[k - 1] > 0
            of = history[mine]
            used = np.unique(of)
            parts.append({
                "kind": np.full(len(used), "history"), "level": np.full(len(used), k), "key": block.keys[k - 2][used].view(np.int64), "n": seen[k - 2][used].astype(np.int64),
                "lost": np.bincount(of, loses(k, seen[k - 1][mine]), len(seen[k - 2]))[used],
                "lower": np.bincount(of, chances[k - 2][shorter[mine]], len(seen[k - 2]))[used]})
        log = np.zeros(len(text), np.int64)
        open_tokens = np.ones(len(text), bool)
        for k in range(order, 1, -1):
            tried = np.flatnonzero(open_tokens & (own[k - 1] >= 0))
            gram = own[k - 1][tried]
            hit = seen[k - 1][gram] > 0
            log[tried[hit]] = _rounded(chances[k - 1][gram[hit]])
            open_tokens[tried[hit]] = False
            missed, history = tried[~hit], histories[k - 1][gram[~hit]]
            backed = seen[k - 2][history] > 0
            pairs, times = np.unique(text[missed[backed]].astype(np.int64) * len(seen[k - 2]) + history[backed], return_counts=True)
            parts.append({
                "kind": np.full(len(pairs), "need"), "block": np.full(len(pairs), row["block"]), "row": pairs // max(len(seen[k - 2]), 1),
                "level": np.full(len(pairs), k), "key": block.keys[k - 2][pairs % max(len(seen[k - 2]), 1)].view(np.int64), "times": times})
        log[open_tokens] = _rounded(chances[0])[own[0][open_tokens]]
        parts.append({
            "kind": np.full(texts, "text"), "block": np.full(texts, row["block"]), "row": np.arange(texts), "id": row["ids"], "held_out": row["held"],
            "n_tokens": [s + 1 for s in row["sizes"]], "n_known": known, "base": base, "seen": _sums(text, log, texts)})
        made = []
        for part in parts:
            size = len(part["kind"])
            made.append(pa.Table.from_arrays([pa.array(part[f.name], f.type) if f.name in part else pa.nulls(size, f.type) for f in arrow], schema=arrow))
        return pa.concat_tables(made)

    return stored(state.groupBy("block").cogroup(counted.drop("stats").groupBy("block")).applyInArrow(score, schema), "katz-parts", "kind")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Rows id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    The model learns from the texts that are not held out (see ``held_out``); scores are log10 of
    probabilities, base_score that of single words with half a count added.
    """
    state = blocks(docs, id_col, text_col)
    size = state.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    bits = max(0, int(size // GROUP_TOKENS).bit_length())
    counted = answers(requests(state, order, bits))
    sums = counted.where("stats IS NOT NULL").groupBy("level").agg(*[F.sum(F.col("stats")[i]) for i in range(GT_UP_TO + 3)]).collect()
    stats = {k: [0] * (GT_UP_TO + 3) for k in range(1, order + 1)} | {r[0]: list(r[1:]) for r in sums}
    parts = part_scores(state, counted, stats, order)
    of_kind = lambda kind, *columns: parts.where(F.col("kind") == kind).select(*columns)
    weights = stored(
        of_kind("history", "level", "key", "n", "lost", "lower").groupBy("level", "key").agg(F.max("n").alias("n"), F.sum("lost").alias("lost"), F.sum("lower").alias("lower"))
        .select("level", "key", (F.col("lost") / F.col("n") / (1 - F.col("lower"))).alias("weight")), "katz-weights", "level")
    backed = (
        of_kind("need", "block", "row", "level", "key", "times")
        .join(weights.select("level", "key", F.rint(F.log10("weight") * PLACES).cast("long").alias("log")), ["level", "key"])
        .groupBy("block", "row").agg(F.sum(F.col("times") * F.col("log")).alias("backed")))
    texts = of_kind("text", "block", "row", "id", "held_out", "n_tokens", "n_known", "base", "seen")
    return texts.join(backed, ["block", "row"], "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(stats[1][1]).cast("long").alias("train_tokens"),
        (F.col("base") / PLACES).alias("base_score"), ((F.col("seen") + F.coalesce("backed", F.lit(0))) / PLACES).alias("score"))
