"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import ColumnMapping, Matching, Source
from ..functions.keys import record_id, row_hash, vendor_id
from ..functions.parse import parse_cents, parse_date, parse_status
from ..functions.similarity import vendor_similarity
from ..functions.text import sanitize_column, vendor_clean
from ..operators import qa
from ..operators.aliases import with_alias
from ..operators.assign import assign, unmatched
from ..operators.candidates import candidates, match_type
from ..operators.cleaning import clean
from ..operators.dedupe import keep_one
from ..operators.exceptions import exceptions, from_low_confidence, preview
from ..operators.mapping import map_source
from ..operators.model import build_dim, build_fact, date_fields, empty_fact
from ..operators.normalize import canonicalize, normalize
from ..operators.reports import (
    dashboard_kpis, exceptions_by_code, flags_by_severity, match_rate_by_month, matches_by_score,
    spend_by_month_vendor, top_vendors, with_matched,
)
from ..schemas import FACT_TAIL
from ..session import materialize, scratch
from ..sources.files import ingest
from ..sources.publish import combine_folder, export_stages, publish
from ..sources.rules import load_aliases
from ..sources.store import Store, latest_batch
from .feeds import ALIASES, BATCH, NOW, PAYMENT_HEADER, POLICY, TEXT_HEADER, read, spark_feed
from .ledgers import (
    clean_ledger, exception_ledger, map_ledger, match_ledger, model_ledger, normalize_ledger, qa_ledger,
    report_ledger, stage_counts,
)
from .runs import add_vendors

Query = Callable[[SparkSession, str], DataFrame]

HUGE_CENTS = 2**62

CFG = Matching()
TOLERANT = Matching(amount_tolerance_cents=25)
NO_WINDOW = Matching(date_window_days=0, min_score=0.65)
WIDE = Matching(date_window_days=5, vendor_weight=0.5, date_weight=0.3, amount_weight=0.2)

MAPPINGS = {
    "transactions": ColumnMapping(("Merchant",), ("Post Date",), ("Amount",)),
    "vendor_payments": ColumnMapping(("payee",), ("pay_date",), ()),
}


# ---- shared steps -----------------------------------------------------------------------

def _staged(spark: SparkSession, sf: str, source: str) -> DataFrame:
    """A text feed with lineage and row hash, as ingest would stage it."""
    feed, header = {
        "transactions": ("text_transactions", TEXT_HEADER),
        "vendor_payments": ("text_payments", PAYMENT_HEADER),
    }[source]
    df = spark_feed(spark, sf, feed)
    columns = df.columns[: len(header)]
    return df.select(
        F.lit(BATCH).alias("batch_id"), F.lit(NOW).alias("ingested_at_utc"),
        F.lit(source).alias("source_name"), F.lit(f"{source}.csv").alias("source_file"),
        (F.col("k") + 1).alias("source_row_number"), *columns,
        row_hash(dict(zip(header, columns))).alias("row_hash"),
    )


def _mapped(spark, sf, source):
    return map_source(_staged(spark, sf, source), MAPPINGS[source])


def _cleaned(spark, sf, source):
    return clean(_mapped(spark, sf, source), run_year=int(NOW[:4]))


def _normed(spark, sf, source):
    return normalize(_cleaned(spark, sf, source), ALIASES, NOW, dedupe=False)


def _facts(spark: SparkSession, sf: str, kind: str = "typed") -> tuple[DataFrame, DataFrame]:
    """Facts of the typed feeds."""
    return tuple(
        build_fact(canonicalize(spark_feed(spark, sf, f"{kind}_{feed}"), ALIASES), record_type, dedupe=False)
        for feed, record_type in (("transactions", "transactions"), ("payments", "vendor_payments"))
    )


# What matching reads of a fact besides its id, what reports add to that, and what exceptions add to the two.
MATCHED = ("source_file", "source_row_number", "date", "amount_cents", "vendor_canonical")
REPORTED = (*MATCHED, "batch_id", "month")
REVIEWED = (*REPORTED, "year", "is_weekend", "currency", "vendor_id")


def _written_facts(spark, sf, kind="typed", columns=FACT_TAIL):
    """Facts as the model stage leaves them, those columns that are read: written once, read by several consumers."""
    tx, pay = _facts(spark, sf, kind)
    return materialize(tx.select("txn_id", *columns), "fact-transactions"), materialize(pay.select("pay_id", *columns), "fact-payments")


def _matched(spark, sf, columns=FACT_TAIL):
    tx, pay = _written_facts(spark, sf, columns=columns)
    return tx, pay, assign(tx, pay, CFG, BATCH, NOW)


def _exceptions(spark, sf):
    tx, pay, matches = _matched(spark, sf, REVIEWED)
    matches = materialize(matches, "matches")
    flags = qa.qa_flags(tx, pay, POLICY, NOW)
    return exceptions(flags, tx, pay, matches, CFG.low_confidence_threshold, BATCH, NOW), tx, matches


def _orders_batches(spark, sf):
    """Orders as rows of five batches, one per priority."""
    return read(spark, sf, "orders").select(
        F.concat(F.lit("b"), F.substring("o_orderpriority", 1, 1)).alias("batch_id"),
        F.col("o_orderkey").alias("record"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


BATCHES = ["b1", "b2", "b3", "b4", "b5"]


def _batch_store(spark, sf) -> Store:
    store = Store(spark, scratch(spark, "store"))
    store.append("orders", _orders_batches(spark, sf))
    return store


def _csv_folder(spark, sf, feed, header) -> str:
    """The feed as CSV files, one folder per year, each file in key order."""
    path = scratch(spark, "csv")
    df = spark_feed(spark, sf, feed)
    named = df.select(*[F.col(c).alias(h) for c, h in zip(df.columns, header)], "k", "y")
    (
        named.repartition("y").sortWithinPartitions("y", "k").drop("k")
        .write.partitionBy("y").options(header=True, quote='"', escape='"', emptyValue="").csv(path)
    )
    return path


def _ingested(spark, sf):
    root = _csv_folder(spark, sf, "text_transactions", TEXT_HEADER)
    return ingest(spark, f"{root}/y=*/*.csv", "transactions", BATCH, NOW, root)


def _folder():
    return F.regexp_extract("source_file", "^y=([0-9]+)/", 1).alias("folder")


# ---- sources and sinks ------------------------------------------------------------------

def csv_scan_raw(spark, sf):
    names = ["transaction_id", "post_date", "merchant", "amount", "currency", "memo"]
    return _ingested(spark, sf).rows.select(*names)


def csv_scan_line_breaks(spark, sf):
    """Texts with line breaks and quotes, exported and scanned again."""
    root = scratch(spark, "line-breaks")
    docs = read(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit("end").alias("last"))
    docs.write.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(root)
    rows = ingest(spark, f"{root}/*.csv", "documents", BATCH, NOW, root).rows
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2("text", 256).alias("text_sha256"), "last")


def ingest_lineage(spark, sf):
    return _ingested(spark, sf).rows.select(
        "batch_id", "ingested_at_utc", "source_name", _folder(),
        F.col("source_row_number"), "transaction_id", "row_hash",
    )


def ingest_files(spark, sf):
    return _ingested(spark, sf).files.select(
        "batch_id", "source_name", _folder(), "row_count", "original_columns_json",
        "sanitized_columns_json", (F.col("file_size_bytes") > 0).alias("has_size"), "ingested_at_utc",
    )


def sanitize_headers(spark, sf):
    """Column names made of part names, brands and types."""
    name = F.concat_ws(" ", F.lit(" "), "p_brand", F.lit("(%)"), "p_name", F.lit("- "), "p_type", F.lit(" "))
    numbered = F.concat(F.col("p_size").cast("string"), F.lit(". "), F.col("p_brand"))
    raw = F.when(F.col("p_partkey") % 3 == 0, numbered).when(F.col("p_partkey") % 3 == 1, name).otherwise("--")
    return read(spark, sf, "part").select("p_partkey", raw.alias("raw_name")).withColumn(
        "safe_name", sanitize_column(F.col("raw_name"))
    )


def documents_row_hash(spark, sf):
    """Whole document texts, hashed as JSON with awkward header names."""
    header = {"Text Body": "text", "lang": "lang", "Source": "source", 'n "chars"': "n_chars"}
    df = read(spark, sf, "documents")
    return df.withColumn("n_chars", F.col("n_chars").cast("string")).select(
        "doc_id", row_hash(header).alias("row_hash")
    )


def schema_evolution_union(spark, sf):
    """Two staged batches with different columns in one table."""
    store = Store(spark, scratch(spark, "store"))
    store.replace("stg", "first", read(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")))
    store.replace("stg", "second", read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("string").alias("balance")))
    return store.table("stg").select("batch_id", "id", "name", "segment", "balance")


def batch_scan(spark, sf):
    return _batch_store(spark, sf).batch("orders", "b3")


def latest(spark, sf):
    """One registry row per order: its batch and its day as ingest time."""
    orders = read(spark, sf, "orders")
    files = orders.select(
        F.concat(F.lit("b"), F.substring("o_orderpriority", 1, 1), F.lit("-"), "o_orderstatus").alias("batch_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ingested_at_utc"),
    )
    return latest_batch(files)


def batch_replace(spark, sf):
    """Replace one batch by changed rows, one by nothing; the others stay."""
    store = _batch_store(spark, sf)
    store.replace("orders", "b2", _orders_batches(spark, sf).filter("batch_id = 'b2'").withColumn(
        "amount", F.col("amount") * 2))
    store.replace("orders", "b4", _orders_batches(spark, sf).filter("batch_id = 'none'"))
    return store.table("orders")


def batch_purge(spark, sf):
    store = _batch_store(spark, sf)
    store.purge("orders", "b5")
    return store.table("orders").groupBy("batch_id").agg(F.count("*").alias("row_count"))


def snapshot_history(spark, sf):
    """Two published snapshots of a report; each file still shows its snapshot."""
    tx, _, matches = _matched(spark, sf, REPORTED)
    rate = match_rate_by_month(with_matched(tx, matches))
    root = scratch(spark, "drop")
    for now in (NOW, "2026-01-02T03:04:05+00:00"):
        publish({"rpt_match_rate_by_month": rate}, root, BATCH, now, "history")
    path = f"{root}/history/rpt_match_rate_by_month"
    df = spark.read.option("header", True).csv(f"{path}/*")
    return df.select(
        F.regexp_extract("_metadata.file_path", r"rpt_match_rate_by_month__([^/]+)/", 1).alias("snapshot"),
        "month", F.col("txn_count").cast("bigint").alias("txn_count"),
    )


def folder_combine(spark, sf):
    """Snapshots with different columns, combined by name."""
    root = scratch(spark, "drop")
    tx, _ = _facts(spark, sf)
    marts = {
        "rpt_top_vendors": top_vendors(tx, 20).select("batch_id", "vendor_canonical", "txn_count"),
    }
    publish(marts, root, BATCH, NOW, "history")
    marts = {"rpt_top_vendors": top_vendors(tx, 20).select("txn_count", "vendor_canonical")}
    publish(marts, root, BATCH, "2026-01-02T03:04:05+00:00", "history")
    return combine_folder(spark, f"{root}/history/rpt_top_vendors").select(
        "batch_id", "vendor_canonical", F.col("txn_count").cast("bigint").alias("txn_count")
    )


def run_ledger(spark, sf):
    """Counters of the map, clean, normalize and model ledgers, side by side."""
    source = "transactions"
    mapped = _mapped(spark, sf, source)
    norm = materialize(_normed(spark, sf, source), "norm")
    fact = build_fact(norm, source, dedupe=False)
    parts = [
        map_ledger(mapped, source, NOW), clean_ledger(norm, source, NOW),
        normalize_ledger(norm, source, NOW, "aliases.csv"), model_ledger(fact, source, NOW),
    ]
    counters = ["row_count", "error_count", "alias_match_count", "no_match_count", "distinct_vendor_count"]
    union = parts[0].select(F.lit("mapped").alias("stage"), "row_count")
    for stage, df in zip(("cleaned", "normalized", "modeled"), parts[1:]):
        df = df.select(F.lit(stage).alias("stage"), *[c for c in counters if c in df.columns])
        union = union.unionByName(df, allowMissingColumns=True)
    return union.select("stage", *counters)


def match_run_ledger(spark, sf):
    tx, pay, matches = _matched(spark, sf, MATCHED)
    return match_ledger(tx, pay, matches, CFG, BATCH, NOW)


def stages(spark, sf):
    tx, pay = _facts(spark, sf)
    return stage_counts({
        "stg_transactions_raw": _staged(spark, sf, "transactions"),
        "clean_transactions": _cleaned(spark, sf, "transactions"),
        "fact_transactions": tx, "fact_vendor_payments": pay,
    })


# ---- mapping, cleaning, normalising, model ----------------------------------------------

def map_columns(spark, sf):
    """Both feeds: configured headers, and fallbacks where nothing configured is present."""
    columns = ["source_name", "row_hash", "vendor_raw", "date_raw", "amount_raw", "map_vendor_from",
               "map_date_from", "map_amount_from", "mapping_status", "mapping_notes"]
    staged = _staged(spark, sf, "transactions")
    bare = map_source(staged.drop("merchant", "amount").withColumn("source_name", F.lit("bare")), None)
    return (
        _mapped(spark, sf, "transactions").select(*columns)
        .unionByName(_mapped(spark, sf, "vendor_payments").select(*columns))
        .unionByName(bare.select(*columns))
    )


def clean_dates(spark, sf):
    text = F.col("post_date")
    day = parse_date(text)
    return spark_feed(spark, sf, "text_transactions").select(
        "k", text, day.alias("day"), parse_status(text, day).alias("status")
    )


def clean_amounts(spark, sf):
    text = F.col("amount")
    cents = parse_cents(text)
    return spark_feed(spark, sf, "text_transactions").select(
        "k", text, cents.alias("cents"), parse_status(text, cents).alias("status")
    )


def clean_status(spark, sf):
    return _cleaned(spark, sf, "transactions").select(
        "transaction_id", "date", "amount_cents", "date_parse_status", "amount_parse_status",
        "clean_status", "clean_notes",
    )


def clean_vendors(spark, sf):
    return spark_feed(spark, sf, "text_transactions").select(
        "k", "merchant", vendor_clean(F.col("merchant")).alias("cleaned")
    )


def vendor_canonical(spark, sf):
    df = spark_feed(spark, sf, "text_transactions").withColumnRenamed("merchant", "vendor_raw")
    return canonicalize(df, ALIASES).select(
        "k", "vendor_raw", "vendor_clean", "vendor_canonical", "vendor_norm_method",
        "vendor_norm_confidence", "vendor_norm_notes",
    )


def vendor_canonical_rule_files(spark, sf):
    """Aliases of a rule file, one rule for each name of a part."""
    names = read(spark, sf, "part").select("p_name").distinct()
    rules = names.select(F.regexp_replace("p_name", " ", ".*").alias("pattern"), F.concat(F.lit("as "), "p_name").alias("canonical_vendor"))
    path = scratch(spark, "vendor_aliases.csv")
    rules.orderBy("canonical_vendor").coalesce(1).write.option("header", True).csv(path)
    df = spark_feed(spark, sf, "text_transactions").select("k", F.col("merchant").alias("vendor_raw"))
    found = with_alias(df.withColumn("vendor_clean", vendor_clean(F.col("vendor_raw"))), load_aliases(spark, path), "found")
    return found.select("k", "vendor_raw", F.col("found.canonical").alias("alias"), "found.pattern")


def _copies(spark, sf):
    """Orders of one customer and status count as copies of one row."""
    return read(spark, sf, "orders").select(
        F.concat(F.lit("b"), F.substring("o_orderpriority", 1, 1)).alias("batch_id"),
        F.sha2(F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderstatus"), 256).alias("row_hash"),
        F.concat("o_orderstatus", F.lit(".csv")).alias("source_file"),
        F.col("o_orderkey").alias("source_row_number"), F.col("o_totalprice").alias("amount"),
    )


def date_columns(spark, sf):
    df = spark_feed(spark, sf, "typed_payments").select("source_row_number", "date")
    df = df.withColumn("date", F.when(F.col("source_row_number") % 50 == 0, "").otherwise(F.col("date")))
    return date_fields(df)


def dim_vendor(spark, sf):
    """New vendors of both feeds next to a dimension that holds the payments' vendors."""
    tx, pay = (
        canonicalize(spark_feed(spark, sf, f"typed_{f}"), ALIASES) for f in ("transactions", "payments")
    )
    shouted = tx.withColumn("vendor_canonical", F.upper("vendor_canonical"))
    known = build_dim([pay.filter("vendor_canonical not like '% Group'")], None, "earlier")
    new = build_dim([tx, shouted, pay], known, NOW)
    return known.unionByName(new)


def dim_vendor_rerun(spark, sf):
    """Batch p1 brings the transactions' vendors, p2 the payments', and p1 runs again without its own."""
    tx, pay = (canonicalize(spark_feed(spark, sf, f"typed_{f}"), ALIASES) for f in ("transactions", "payments"))
    store = Store(spark, scratch(spark, "store"))
    for batch, norms, now in (("p1:a/b%", [tx], "first"), ("p2", [tx, pay], "second"), ("p1:a/b%", [pay], "third")):
        add_vendors(store, norms, batch, now)
    return store.table("dim_vendor").select("batch_id", "vendor_id", "vendor_canonical", "created_at_utc")


def fact_transactions(spark, sf):
    return build_fact(_normed(spark, sf, "transactions"), "transactions", dedupe=False)


def fact_vendor_payments(spark, sf):
    return build_fact(_normed(spark, sf, "vendor_payments"), "vendor_payments", dedupe=False)


# ---- quality ----------------------------------------------------------------------------

def _flag_query(rules_for) -> Query:
    def query(spark, sf):
        parts = []
        for record_type, df in zip(("transactions", "vendor_payments"), _written_facts(spark, sf)):
            rules = rules_for(df, record_type)
            if rules:
                parts.append(qa.flag_rows(df, record_type, rules, NOW))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return query


def qa_missing_fields(spark, sf):
    """Cleaned rows before modelling, where an amount can still be NULL."""
    df = _normed(spark, sf, "transactions").withColumns(
        {"txn_id": record_id("txn"), "vendor_id": vendor_id(F.col("vendor_canonical"))}
    )
    return qa.flag_rows(df, "transactions", qa.missing_rules(), NOW)


def qa_duplicates(spark, sf):
    tx, pay = _written_facts(spark, sf)
    return qa.duplicate_flags(tx, "transactions", NOW).unionByName(
        qa.duplicate_flags(pay, "vendor_payments", NOW)
    )


def qa_flags(spark, sf):
    return qa.qa_flags(*_written_facts(spark, sf), POLICY, NOW)


def _huge(facts: DataFrame) -> DataFrame:
    """Facts of which a few hold a number as large as a reference number in the place of the amount."""
    return facts.withColumn("amount_cents", F.when(
        F.col("source_row_number") % 500 == 0, F.lit(HUGE_CENTS) - F.col("source_row_number")).otherwise(F.col("amount_cents")))


def qa_outliers_huge(spark, sf):
    tx = materialize(_huge(_facts(spark, sf)[0]), "huge")
    return qa.flag_rows(tx, "transactions", qa.outlier_rules(tx), NOW)


def qa_flags_one_feed(spark, sf):
    """A batch whose second feed is late."""
    tx, _ = _written_facts(spark, sf)
    return qa.qa_flags(tx, empty_fact(spark, "vendor_payments"), POLICY, NOW)


def flags_listed(spark, sf):
    return flags_by_severity(qa_flags(spark, sf))


# ---- matching ---------------------------------------------------------------------------

def _pairs_query(cfg: Matching, kind: str = "typed") -> Query:
    return lambda spark, sf: candidates(*_written_facts(spark, sf, kind, MATCHED), cfg, BATCH)


def _match_query(cfg: Matching, kind: str = "typed", **limit: int) -> Query:
    return lambda spark, sf: assign(*_written_facts(spark, sf, kind, MATCHED), cfg, BATCH, NOW, **limit)


def vendor_similarities(spark, sf):
    """Each part on a line against its order's vendor, per distinct pair of names."""
    names = read(spark, sf, "part").select("p_partkey", F.initcap("p_name").alias("name"))
    n = names.select(F.count("*")).scalar()
    orders = read(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % n).alias("p_partkey"))
    vendors = orders.join(names.withColumnRenamed("name", "a"), "p_partkey").select("o_orderkey", "a")
    lines = read(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    parts = lines.join(names.withColumnRenamed("name", "b"), "p_partkey").select("l_orderkey", "b")
    pairs = vendors.join(parts, F.col("o_orderkey") == F.col("l_orderkey")).select("a", "b").distinct()
    return pairs.withColumn("vendor_sim", F.round(vendor_similarity(F.col("a"), F.col("b")), 9))


def match_scores(spark, sf):
    return _pairs_query(WIDE)(spark, sf).select("txn_id", "pay_id", "score")


def match_types(spark, sf):
    """Type of every candidate, whether chosen or not."""
    return _pairs_query(TOLERANT)(spark, sf).select(
        "txn_id", "pay_id",
        match_type(F.col("vendor_sim"), F.col("date_diff_days"), F.col("amount_diff_cents")).alias("match_type"),
    )


def unmatched_transactions(spark, sf):
    tx, _, matches = _matched(spark, sf)
    return unmatched(tx, matches, "txn_id")


def unmatched_vendor_payments(spark, sf):
    _, pay, matches = _matched(spark, sf)
    return unmatched(pay, matches, "pay_id")


def matches_listed(spark, sf):
    return matches_by_score(_matched(spark, sf, MATCHED)[2])


# ---- exceptions and reports -------------------------------------------------------------

def exc_low_confidence(spark, sf):
    _, _, matches = _matched(spark, sf, MATCHED)
    return from_low_confidence(matches, CFG.low_confidence_threshold, BATCH, NOW)


def all_exceptions(spark, sf):
    return _exceptions(spark, sf)[0]


def exceptions_preview(spark, sf):
    return preview(all_exceptions(spark, sf))


def rpt_spend_by_month_vendor(spark, sf):
    tx, _, matches = _matched(spark, sf, REPORTED)
    return spend_by_month_vendor(with_matched(tx, matches))


def rpt_match_rate_by_month(spark, sf):
    tx, _, matches = _matched(spark, sf, REPORTED)
    return match_rate_by_month(with_matched(tx, matches))


def rpt_exceptions_by_code(spark, sf):
    return exceptions_by_code(all_exceptions(spark, sf))


def rpt_top_vendors_huge(spark, sf):
    return top_vendors(_huge(_facts(spark, sf)[0]), 20)


def audit_ledgers(spark, sf):
    """The ledgers of the quality, exception and report stages, side by side."""
    parts = [
        qa_ledger(spark, BATCH, NOW, "policy_rules.csv").withColumnRenamed("qa_at_utc", "at_utc"),
        exception_ledger(all_exceptions(spark, sf), BATCH, NOW).withColumnRenamed("created_at_utc", "at_utc"),
        report_ledger(spark, BATCH, NOW).withColumnRenamed("created_at_utc", "at_utc"),
    ]
    named = [p.withColumn("ledger", F.lit(n)) for n, p in zip(("qa_runs", "exception_runs", "report_runs"), parts)]
    union = named[0].unionByName(named[1], allowMissingColumns=True).unionByName(named[2], allowMissingColumns=True)
    return union.select("ledger", "batch_id", "at_utc", "policy_rules_path", F.col("exception_count").cast("bigint").alias("exception_count"))


def publish_latest(spark, sf):
    """A report published twice under its stable name, then read back: the later one stays."""
    tx, _, matches = _matched(spark, sf, REPORTED)
    root = scratch(spark, "drop")
    spend = spend_by_month_vendor(with_matched(tx, matches))
    for frame in (spend.limit(5), spend):
        publish({"rpt_spend_by_month_vendor": frame}, root, BATCH, NOW, "latest")
    df = combine_folder(spark, f"{root}/latest/rpt_spend_by_month_vendor")
    return df.select("month", F.nullif("vendor_canonical", F.lit("")).alias("vendor_canonical"), F.col("txn_count").cast("bigint").alias("txn_count"))


def stage_export(spark, sf):
    """Two stage tables as CSV, read back by column name."""
    root = scratch(spark, "csv")
    tx, _ = _facts(spark, sf)
    export_stages({"stg_transactions_raw": _staged(spark, sf, "transactions"), "fact_transactions": tx}, root)
    raw, fact = (combine_folder(spark, f"{root}/{n}") for n in ("stg_transactions_raw", "fact_transactions"))
    return raw.select("row_hash", "merchant", "amount", "memo").unionByName(
        fact.select("row_hash", F.col("vendor_raw").alias("merchant"), F.col("amount_cents").alias("amount"), F.col("month").alias("memo")))


def rpt_top_vendors(spark, sf):
    return top_vendors(_facts(spark, sf)[0], 20)


def kpis(spark, sf):
    rows, tx, matches = _exceptions(spark, sf)
    return dashboard_kpis(match_rate_by_month(with_matched(tx, matches)), rows)


QUERIES: dict[str, Query] = {
    "csv_scan_raw": csv_scan_raw,
    "csv_scan_line_breaks": csv_scan_line_breaks,
    "sanitize_headers": sanitize_headers,
    "ingest_lineage": ingest_lineage,
    "row_hash": documents_row_hash,
    "schema_evolution_union": schema_evolution_union,
    "ingest_files": ingest_files,
    "batch_scan": batch_scan,
    "latest_batch": latest,
    "batch_replace": batch_replace,
    "batch_purge": batch_purge,
    "run_ledger": run_ledger,
    "match_run_ledger": match_run_ledger,
    "snapshot_history": snapshot_history,
    "folder_combine": folder_combine,
    "stage_counts": stages,
    "map_columns": map_columns,
    "clean_dates": clean_dates,
    "clean_amounts": clean_amounts,
    "clean_status": clean_status,
    "vendor_clean": clean_vendors,
    "vendor_canonical": vendor_canonical,
    "vendor_canonical_rule_files": vendor_canonical_rule_files,
    "dedupe_first": lambda spark, sf: keep_one(_copies(spark, sf)),
    "dedupe_last": lambda spark, sf: keep_one(_copies(spark, sf), last=True),
    "date_fields": date_columns,
    "dim_vendor": dim_vendor,
    "dim_vendor_rerun": dim_vendor_rerun,
    "fact_transactions": fact_transactions,
    "fact_vendor_payments": fact_vendor_payments,
    "qa_missing_fields": qa_missing_fields,
    "qa_duplicates": qa_duplicates,
    "qa_weekend": _flag_query(qa.weekend_rules),
    "qa_outliers": _flag_query(lambda df, record_type: qa.outlier_rules(df)),
    "qa_policy_rules": _flag_query(lambda df, record_type: qa.policy_rules(df, record_type, POLICY)),
    "qa_flags": qa_flags,
    "qa_flags_one_feed": qa_flags_one_feed,
    "qa_outliers_huge": qa_outliers_huge,
    "flags_by_severity": flags_listed,
    "vendor_similarity": vendor_similarities,
    "match_candidates": _pairs_query(CFG),
    "match_candidates_tolerance": _pairs_query(TOLERANT),
    "match_candidates_nodate": _pairs_query(NO_WINDOW, "fine"),
    "match_scores": match_scores,
    "match_types": match_types,
    "match_greedy": _match_query(CFG),
    "match_greedy_tolerance": _match_query(TOLERANT),
    "match_greedy_nodate": _match_query(NO_WINDOW, "fine"),
    "match_greedy_rounds": _match_query(CFG, group_limit=0),
    "match_greedy_tolerance_rounds": _match_query(TOLERANT, group_limit=0),
    "match_greedy_nodate_rounds": _match_query(NO_WINDOW, "fine", group_limit=0),
    "match_candidates_spread": _pairs_query(TOLERANT, "spread"),
    "match_greedy_spread": _match_query(TOLERANT, "spread"),
    "match_greedy_spread_rounds": _match_query(TOLERANT, "spread", group_limit=0),
    "matches_by_score": matches_listed,
    "unmatched_transactions": unmatched_transactions,
    "unmatched_vendor_payments": unmatched_vendor_payments,
    "exc_low_confidence": exc_low_confidence,
    "exceptions": all_exceptions,
    "exceptions_preview": exceptions_preview,
    "rpt_spend_by_month_vendor": rpt_spend_by_month_vendor,
    "rpt_match_rate_by_month": rpt_match_rate_by_month,
    "rpt_exceptions_by_code": rpt_exceptions_by_code,
    "rpt_top_vendors": rpt_top_vendors,
    "rpt_top_vendors_huge": rpt_top_vendors_huge,
    "dashboard_kpis": kpis,
    "audit_ledgers": audit_ledgers,
    "publish_latest": publish_latest,
    "stage_export": stage_export,
}
