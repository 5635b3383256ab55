"""From raw documents to tokens: quality rules, near duplicates, personal data, mixing, tokens.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the documents of the next.  All but the last return the columns of documents.

Defined results: null and empty texts have too few words and go with the first stage; repeated
rows are near duplicates of each other, so one stays; very long texts go through whole; an empty
table stays empty; more columns
in documents stay until the last stage, also ones with the names that operators use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, pfair_mix, private_data, quality_rules, simhash
from ledgerline.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule."""
    judged, name = quality_rules.judge(docs)
    return judged.where(F.col(name)["kept"]).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: five-word shingles, similarity 0.8."""
    return simhash.keep_one(docs)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data reads as its kind in brackets; n_chars follows the text."""
    found, name = private_data.find(docs, masked="[{}]")
    masked = found.drop(name)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: a source's weight is the square root of its size."""
    mixed, names = pfair_mix.mix(docs, order_cols=("doc_id", "text"))
    return mixed.orderBy(names[1]).drop(*names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of them and of the bytes that they decode to."""
    import public_tokenizers

    coded = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                keep=("doc_id", "lang", "source"))
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("private_data", mask_private),
    ("pfair_mix", mix),
    ("byte_bpe", tokens),
]

#: SQL cannot express the fingerprints, the transducers, the schedule and the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
