"""Importance resampling towards a target distribution, by hashed bags of word n-grams.

A feature is a run of one to ``longest`` words; its bucket is the CRC-32 of its bytes modulo the number
of buckets.  The gain of a bucket is the floored, scaled log ratio of its smoothed shares in the target
and in the source.  A document's weight is the floored mean of the gains of its features; with Gumbel
noise from a hash of its id the highest scores are a draw without replacement in proportion to weights.

Texts are read in batches joined by a separator that no word holds: one pass of a pattern finds all words
of a batch, ``searchsorted`` over the offsets of the documents tells whose they are, and n-grams whose
first and last word belong to different documents are masked before the counts.  The words of a batch
are taken in chunks, the last words of one going before the next, so memory holds a batch of texts and
one chunk.  A task sends at most one row for each bucket, so counts are combined before the shuffle; the
gains are as many numbers as there are buckets, which bounds what the driver sees.  Ranks come from a sort
by ranges of score and id (ids split equal scores) and the sizes of the sorted parts.

Defined results: a null or empty text has no features and weight 0; very long texts are read whole, in
chunks; a null id counts as an empty one and comes first among equal scores; repeated rows get equal
scores and follow each other in the order of their features; an empty table gives no rows, an empty
target makes all gains follow the source alone; other columns are ignored unless they are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import fresh, slices
from ledgerline.session import materialize, ship_functions

ship_functions(__name__)

BUCKETS = 10_000
LONGEST = 2
SCALE = 1000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25

BATCH_BYTES = 4 << 20  # texts joined at a time
CHUNK_WORDS = 100_000

#: Letters, digits and all that is not ASCII; in UTF-8 the latter are the bytes from 80 on.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"


def feature_chunks(texts: list[bytes], buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Of each chunk of words and each length of n-grams: document numbers, buckets and the length."""
    joined = SEPARATOR.join(texts).lower()
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + len(SEPARATOR) for t in texts[:-1]], out=starts[1:])
    matches = WORD.finditer(joined)
    words: list[bytes] = []
    owners = np.empty(0, np.int64)
    while chunk := list(islice(matches, CHUNK_WORDS)):
        before = len(words)
        places = np.fromiter((m.start() for m in chunk), np.int64, len(chunk))
        owners = np.concatenate([owners, np.searchsorted(starts, places, "right") - 1])
        words += [m[0] for m in chunk]
        spaced = [b" " + w for w in words]
        hashes = list(map(crc32, words))
        for n in range(1, min(longest, len(words)) + 1):
            if n > 1:  # the hash of a longer run goes on from that of its first words
                hashes = list(map(crc32, spaced[n - 1:], hashes))
            first = max(0, before - n + 1)  # runs that end in this chunk
            found = np.array(hashes[first:], np.int64) % buckets
            last = owners[first + n - 1:]
            within = owners[first:len(owners) - n + 1] == last
            yield last[within], found[within], n
        kept = max(0, len(words) - longest + 1)
        words, owners = words[kept:], owners[kept:]


def _texts(batch, column: str) -> Iterator[tuple[list[bytes], object]]:
    """Parts of a batch with their texts as bytes."""
    import pyarrow as pa

    for part in slices(batch, column, BATCH_BYTES):
        yield [t or b"" for t in part.column(column).cast(pa.binary()).to_pylist()], part


def bucket_counts(docs: DataFrame, text_col: str, buckets: int, longest: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts, _ in _texts(batch, "text"):
                for _, found, _ in feature_chunks(texts, buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(buckets, np.int64)
    for row in counted.collect():  # as many rows as buckets at most
        found[row.bucket] = row.n
    return found


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Floored, scaled log ratio of the smoothed shares of each bucket."""
    of_source, of_target = float(source.sum()) + len(source), float(target.sum()) + len(target)
    return np.array([math.floor(scale * math.log((float(t) + 1) * of_source / ((float(s) + 1) * of_target)))
                     for s, t in zip(source, target)], np.int64)


def weigh(docs: DataFrame, target: DataFrame, keep: tuple[str, ...], text_col: str = "text", target_col: str = "text",
          buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[DataFrame, list[str]]:
    """The kept columns of every document with n_words, n_features and weight; and the names of these three."""
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))
    kept = docs.select(*keep)
    names = fresh(kept, "n_words", "n_features", "weight", "text")
    text = names.pop()

    def weights(batches):
        import pyarrow as pa

        for batch in batches:
            for texts, part in _texts(batch, text):
                words, features, total = (np.zeros(len(texts), np.int64) for _ in range(3))
                for owner, found, n in feature_chunks(texts, buckets, longest):
                    count = np.bincount(owner, minlength=len(texts))
                    words += count if n == 1 else 0
                    features += count
                    # whole numbers far below 2**53, so the sums of doubles are exact
                    total += np.bincount(owner, gain[found], len(texts)).astype(np.int64)
                mean = total // np.maximum(features, 1)
                yield pa.RecordBatch.from_arrays(
                    [*part.drop_columns([text]).columns, pa.array(words), pa.array(features), pa.array(mean)],
                    schema=pa.schema([f for f in part.schema if f.name != text] + [pa.field(c, pa.int64()) for c in names]))

    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, T.LongType()) for c in names]])
    return docs.select(*keep, F.col(text_col).alias(text)).mapInArrow(weights, schema), names


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
         percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Every document's id, n_words, n_features, weight, score and, if it is drawn, its rank from 1 on."""
    weighed, (n_words, n_features, weight) = weigh(docs, target, (id_col,), text_col, target_col)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialize(weighed.select(
        F.col(id_col), F.col(n_words).alias("n_words"), F.col(n_features).alias("n_features"), F.col(weight).alias("weight"),
        (F.col(weight) + noise).cast("long").alias("score")), "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    ordered = materialize(
        scored.where(able).orderBy(F.desc("score"), F.asc(id_col), "n_features", "weight")
        .withColumn("place", F.monotonically_increasing_id()), "ordered")
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    # One row for each part of the sorted table.
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ranked = ordered.withColumn("part", part).join(F.broadcast(sizes.select("part", before.alias("before"))), "part")
    rank = F.col("before") + row + 1
    columns = [id_col, "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(rank <= drawn, rank).cast("long").alias("rank")).unionByName(
        scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))
