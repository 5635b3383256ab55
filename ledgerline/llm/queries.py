"""One registered query for each operator: it applies the operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    byte_bpe, chat_format, fingerprints, katz, language_id, pfair_mix, private_data, quality_rules, resampling, secrets_scan,
    simhash, spelling, url_filters,
)
from ledgerline.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the table are structs of the layout "turn"; conversation -7 is a JSON record of the layout "messages"."""
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.struct("role", "text", "turn").alias("record"))
    messages = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(said).alias("content")) for role in ("user", "assistant")])
    extra = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
        F.to_json(F.struct(messages.alias("messages"))).alias("record"),
    )
    turns = chat_format.canonical_turns(rows, "conv_id", "record", ("turn",)).unionByName(
        chat_format.canonical_turns(extra, "conv_id", "record", ("turn",)))
    formatted = chat_format.format_turns(turns, "conv_id", ("turn",))
    back = formatted.select(
        "conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_and_fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, spans = private_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", spans).select(
        "doc_id", *[private_data.count_of(spans, k).alias(f"n_{k}") for k in private_data.KINDS],
        F.sha2(private_data.spelled_out(spans, base_only=True), 256).alias("base_sha256"),
        private_data.spelled_out(spans).alias("spans"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op7_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, (block, position) = pfair_mix.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", F.col(block).alias("block"), F.col(position).alias("position"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, name = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col(name)
    return judged.select(
        "doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                            "base_failed", "kept")],
        F.array_join(q["broken"], ",").alias("broken"),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its owner; a source's documents in one language are a repository."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = secrets_scan.scan(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    return found.select(
        "doc_id", *[private_data.count_of("spans", k).alias(f"n_{k}") for k in secrets_scan.BASE],
        F.sha2(private_data.spelled_out("spans", base_only=True), 256).alias("base_sha256"),
        private_data.spelled_out("spans").alias("spans"),
        F.array_join(F.col("spans.verdict"), ",").alias("verdicts"),
    )


#: The declared rules.
URL_RULES = (
    url_filters.UrlRule("allow", "com", "/"),
    url_filters.UrlRule("block", "example.com", "/en/"),
    url_filters.UrlRule("allow", "www.example.com", "/en/"),
    url_filters.UrlRule("block", "net", "/es/"),
    url_filters.UrlRule("block", "net", "/fr/"),
)


def page_document(url_col: str = "url"):
    """The document that a page shows: the number that is a segment of its path."""
    return F.try_to_number(F.regexp_extract(url_filters.path_of(F.col(url_col)), r"/([0-9]{1,18})(?:[./]|$)", 1), F.lit("9" * 18)).cast("long")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; the page that shows it (the one with the least id) gives markup and address."""
    pages = table(spark, sf_dir, "pages").select(
        page_document().alias("doc_id"), "page_id", url_filters.host_of(F.col("url")).alias("host"),
        language_id.declared_language(F.col("html")).alias("declared"))
    shown = pages.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("page_id", "host", "declared")).alias("p"))
    evidence = shown.select("doc_id", "p.host", "p.declared")
    found = language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), evidence)
    return found.withColumn("confidence", F.round("confidence", 6))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad when its document is labelled low in quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", page_document().alias("doc_id"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    # Pages without a document spread over keys that no document has.
    keyed = pages.withColumn("doc_id", F.coalesce("doc_id", -1 - F.abs(F.hash("url", "page_id").cast("long"))))
    judged = url_filters.judge(keyed.join(labels, "doc_id", "left"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", F.round("bad_share", 6).alias("bad_share"))


def op11_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.lowered_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = spelling.count_words(runs.select(spelling.with_slips(F.col("run"), F.col("doc_id")).alias("word")))
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.draw(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_fingerprints": op2_fingerprints,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language_id": op4_language_id,
    "op5_private_data": op5_private_data,
    "op6_simhash": op6_simhash,
    "op7_pfair_mix": op7_pfair_mix,
    "op8_quality_rules": op8_quality_rules,
    "op9_secrets": op9_secrets,
    "op10_url_filters": op10_url_filters,
    "op11_katz": op11_katz,
    "op12_spelling": op12_spelling,
    "op13_resampling": op13_resampling,
}
