"""Language identification by Bayesian fusion of evidence.

Evidence of a text's language, added up as logarithms: the likelihood of its characters under
each language, the language that its page's markup declares, the country suffix of its address,
and the prior of its host.  Host priors are grouped sums of the texts' own posteriors, smoothed
towards the prior of the host's suffix, which is smoothed towards that of the whole corpus; a
text's own share is taken out of its host's sums first.

The likelihoods are counts of hashed character triples over a sample of texts with a declared
language: at most ``SAMPLE`` texts for each language, by least hash of their id.  The model is
``BUCKETS`` rows for each of at most ``MOST_LANGUAGES`` languages, so its broadcast is bounded;
every text is scored whole, and all host sums cover all texts.

Texts aren't shuffled; scores are, once, to meet their page and their host.  A host with a third
of all texts is summed on the map side, and its rows are split by the skew join.

Defined results: a null or empty text has no text evidence; an unknown declared language or
suffix says nothing; a null host is a host of its own; without any evidence the prior decides;
if nothing declares a language there is no model, and language and confidence are null; ties go
to the first language by name; repeated rows stay; very long texts are read whole; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import whole_text
from ledgerline.session import materialize, ship_functions

ship_functions(__name__)

SAMPLE = 400
MOST_LANGUAGES = 64
BUCKETS = 1 << 14
#: Neighbouring triples depend on each other, so their evidence counts in part, and at most so much.
TEMPER, MOST_EVIDENCE = 0.1, 30.0
#: How often declared languages and country suffixes are right.
MARKUP_RIGHT, SUFFIX_RIGHT = 0.9, 0.8
#: Weight of the wider prior, in texts.
SMOOTHING = 5.0

#: Languages of country suffixes.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en",
                   "ie": "en", "it": "it", "nl": "nl", "pt": "pt", "br": "pt", "pl": "pl", "se": "sv", "ru": "ru", "jp": "ja"}


def triples(text: str) -> np.ndarray:
    """Buckets of the character triples of a text in lower case, with a space before and after it."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77) ^ codes[2:] * np.uint32(0xC2B2AE3D)
    return ((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def declared_language(html: Column) -> Column:
    """The language of the markup's root, without its region."""
    return F.nullif(F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1)), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.nullif(F.lower(F.element_at(F.split(host, r"\."), -1)), F.lit(""))


def train(texts: DataFrame, text_col: str, language_col: str) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-probability of each bucket (rows) in each language (columns)."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(language_col).to_pylist(), batch.column(text_col).to_pylist()):
                sums.setdefault(language, np.zeros(BUCKETS, np.int64))
                sums[language] += np.bincount(triples(text), minlength=BUCKETS)
        for language, counts in sums.items():
            used = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())],
                names=["language", "bucket", "n"])

    only = texts.select(text_col, language_col)
    counted = only.mapInArrow(count, "language string, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    rows = counted.collect()  # at most MOST_LANGUAGES * BUCKETS
    languages = sorted({r.language for r in rows})
    table = np.full((BUCKETS, len(languages)), 0.5)
    for r in rows:
        table[r.bucket, languages.index(r.language)] += r.n
    return languages, np.log(table / table.sum(axis=0)) if languages else table


def score(texts: DataFrame, text_col: str, model: np.ndarray, name: str) -> DataFrame:
    """The frame with each text's tempered log-likelihoods in its place, greatest zero."""
    import pyarrow as pa
    from pyspark.sql import types as T

    rest = [f for f in texts.schema.fields if f.name != text_col]
    schema = T.StructType([*rest, T.StructField(name, T.ArrayType(T.DoubleType()))])
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            values = np.zeros((batch.num_rows, table.shape[1]))
            for i, text in enumerate(batch.column(text_col)):
                counts = np.bincount(triples(text.as_py()), minlength=BUCKETS) if text.as_py() else None
                if counts is not None:
                    evidence = TEMPER * (counts @ table)
                    values[i] = np.maximum(evidence - evidence.max(), -MOST_EVIDENCE)
            flat = pa.array(values.ravel())
            listed = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * table.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], listed], names=[*(f.name for f in rest), name])

    return texts.mapInArrow(run, schema)


def _posterior(logits: list[Column]) -> list[Column]:
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    parts = [F.exp(x - top) for x in logits]
    whole = sum(parts[1:], parts[0])
    return [p / whole for p in parts]


def _says(column: Column, languages: list[str], right: float, values: dict[str, str] | None = None) -> list[Column]:
    """Log-likelihood of a declared language under each language; zero where it says nothing."""
    said = column
    if values is not None:
        said = F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), column)
    wrong = (1 - right) / max(1, len(languages) - 1)
    known = said.isin(languages)
    return [F.when(known & (said == x), float(np.log(right))).when(known, float(np.log(wrong))).otherwise(F.lit(0.0)) for x in languages]


def _sample(known: DataFrame) -> DataFrame:
    """At most SAMPLE ids of each of the MOST_LANGUAGES languages with most of them, by least hash.

    Ids are ranked in 256 parts of a language first, so that the last ranking sees so many samples
    at most, however many texts declare one language.
    """
    hashed = known.withColumn("_hash", F.xxhash64("_id")).withColumn("_part", F.pmod("_hash", F.lit(256)))
    for keys in (["declared", "_part"], ["declared"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash", "_id"))
        hashed = hashed.withColumn("_rank", rank).where(F.col("_rank") <= SAMPLE).drop("_rank")
    sizes = hashed.groupBy("declared").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.col("_n").desc(), "declared").limit(MOST_LANGUAGES)
    return hashed.join(F.broadcast(sizes), "declared").select("_id", "declared")  # at most MOST_LANGUAGES rows


def identify(docs: DataFrame, evidence: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Rows id, language, confidence, text_language, declared, host: one for each row of docs.

    ``evidence`` has at most one row for each id: id, declared and host.  Where it has none, the
    text's site stands for its host.
    """
    known = evidence.select(F.col(id_col).alias("_id"), "declared", F.col("host"))
    chosen = _sample(known.where("declared IS NOT NULL AND _id IS NOT NULL").select("_id", "declared"))
    only = docs.select(F.col(id_col).alias("_id"), F.col(site_col).cast("string").alias("_site"), whole_text(text_col).alias("_text"))
    # At most SAMPLE * MOST_LANGUAGES rows are broadcast.
    languages, model = train(only.join(F.broadcast(chosen), "_id").select("_text", "declared"), "_text", "declared")
    if not languages:
        nothing = F.lit(None).cast("string")
        return only.select(F.col("_id").alias(id_col), nothing.alias("language"), F.lit(None).cast("double").alias("confidence"),
                           nothing.alias("text_language"), nothing.alias("declared"), F.col("_site").alias("host"))
    n = range(len(languages))
    scored = score(only, "_text", model, "_scores")
    met = scored.join(known, "_id", "left").select(
        "_id", "declared", F.coalesce("host", "_site", F.lit("")).alias("_host"), "_scores",
        F.array(*_posterior([F.col("_scores")[i] for i in n])).alias("_own"))
    rows = materialize(met.withColumn("_suffix", F.coalesce(suffix_of(F.col("_host")), F.lit(""))), "language-scores")

    sums = [f"_s{i}" for i in n]
    hosts = rows.groupBy("_host", "_suffix").agg(*[F.sum(F.col("_own")[i]).alias(s) for i, s in zip(n, sums)])
    suffixes = hosts.groupBy("_suffix").agg(*[F.sum(s).alias(f"_t{s}") for s in sums])
    whole = suffixes.agg(*[F.sum(f"_t{s}").alias(f"_w{s}") for s in sums])  # one row
    add = lambda names: sum([F.col(x) for x in names[1:]], F.col(names[0]))
    wide = [(F.col(f"_w{s}") + 1) / (add([f"_w{x}" for x in sums]) + len(languages)) for s in sums]
    middle = [(F.col(f"_t{s}") + SMOOTHING * F.col(f"_p{i}")) / (add([f"_t{x}" for x in sums]) + SMOOTHING) for i, s in zip(n, sums)]
    priors = suffixes.join(F.broadcast(whole)).select("*", *[p.alias(f"_p{i}") for i, p in zip(n, wide)]).select(
        "_suffix", *[p.alias(f"_q{i}") for i, p in zip(n, middle)])
    joined = rows.join(hosts.join(priors, "_suffix").drop("_suffix"), "_host")
    # Without the text's own share.
    rest = [F.greatest(F.col(s) - F.col("_own")[i], F.lit(0.0)) for i, s in zip(n, sums)]
    total = sum(rest[1:], rest[0])
    host_prior = [(r + SMOOTHING * F.col(f"_q{i}")) / (total + SMOOTHING) for i, r in zip(n, rest)]
    markup = _says(F.col("declared"), languages, MARKUP_RIGHT)
    address = _says(F.col("_suffix"), languages, SUFFIX_RIGHT, SUFFIX_LANGUAGE)
    logits = [F.col("_scores")[i] + F.ln(p) + m + a for i, p, m, a in zip(n, host_prior, markup, address)]
    fused = joined.select("_id", "declared", "_host", "_own", *[x.alias(f"_l{i}") for i, x in zip(n, logits)]).select(
        "_id", "declared", "_host", "_own", F.array(*_posterior([F.col(f"_l{i}") for i in n])).alias("_posterior"))
    names = F.array(*[F.lit(x) for x in languages])
    best = lambda a: F.get(names, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    return fused.select(
        F.col("_id").alias(id_col), best(F.col("_posterior")).alias("language"), F.array_max("_posterior").alias("confidence"),
        best(F.col("_own")).alias("text_language"), "declared", F.col("_host").alias("host"))
