"""Feeds derived from the given tables, as SQL that Spark and DuckDB both run.

``text_*`` are raw exports: decorated vendor names, mixed date formats, amount texts.
``typed_*`` are the same orders after cleaning, with coarse amounts so that many payments
compete for a transaction.  Every order is a transaction; orders that are not pending were
paid.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.rules import AliasRule, PolicyRule

BATCH = "batch-1"
NOW = "2025-12-26T22:59:57+00:00"

ALIASES = [AliasRule("widget|gizmo", "Widget Works"), AliasRule("^blue", "Blue Co")]
POLICY = [
    PolicyRule("POLICY_HIGH", "amount_cents", ">", "40000000", "info", "Review large amounts", "transactions"),
    PolicyRule("POLICY_NOT_USD", "currency", "!=", "USD"),
    PolicyRule("POLICY_BLUE", "vendor_canonical", "==", "Blue Co", "warning", "", "vendor_payments"),
    PolicyRule("POLICY_YEAR", "year", "<=", "1996"),
]

# Each order with its vendor: the part named by the customer key.
_ORDERS = """
  SELECT o.k, o.d, o.cents, o.status, p.p_name AS v FROM (
    SELECT o_orderkey AS k, CAST(o_orderdate AS date) AS d, o_orderstatus AS status,
           CAST(round(o_totalprice * 100) AS bigint) AS cents,
           o_custkey % (SELECT count(*) FROM part) AS pk
    FROM orders) o
  JOIN part p ON p.p_partkey = o.pk
"""

_VENDOR = """
  CASE k % 6 WHEN 0 THEN concat(upper(v), ' #0', CAST(k AS string))
             WHEN 1 THEN concat(v, '*', CAST(k AS string))
             WHEN 2 THEN concat(v, ' INC')
             WHEN 3 THEN concat('the ', v, ' store')
             WHEN 4 THEN '' ELSE v END
"""
_DATE = """
  CASE k % 7 WHEN 0 THEN CAST(d AS string)
             WHEN 1 THEN concat(CAST(month(d) AS string), '/', CAST(day(d) AS string), '/', lpad(CAST(year(d) % 100 AS string), 2, '0'))
             WHEN 2 THEN concat(CAST(month(d) AS string), '/', CAST(day(d) AS string), '/', CAST(year(d) AS string))
             WHEN 3 THEN concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(d) AS int) * 3 - 2, 3), ' ', CAST(day(d) AS string), ', ', CAST(year(d) AS string))
             WHEN 4 THEN replace(CAST(d AS string), '-', '')
             WHEN 5 THEN '' ELSE 'n/a' END
"""
_PLAIN = "concat(CAST(CAST(floor(cents / 100) AS bigint) AS string), '.', lpad(CAST(cents % 100 AS string), 2, '0'))"
_COMMA = (
    "concat('$', CAST(CAST(floor(cents / 100000) AS bigint) AS string), ',', "
    "lpad(CAST(CAST(floor(cents / 100) AS bigint) % 1000 AS string), 3, '0'), '.', lpad(CAST(cents % 100 AS string), 2, '0'))"
)
_AMOUNT = f"""
  CASE CAST(floor(k / 6) AS bigint) % 6 WHEN 0 THEN {_PLAIN} WHEN 1 THEN {_COMMA}
             WHEN 2 THEN concat('(', {_PLAIN}, ')') WHEN 3 THEN concat('USD ', {_PLAIN})
             WHEN 4 THEN '' ELSE '12,x' END
"""

TEXT_HEADER = ["Transaction ID", "Post Date", "Merchant", "Amount", "Currency", "Memo"]
PAYMENT_HEADER = ["Entry ID", "Entry Date", "Payee", "Amount", "Reference"]


def _text_transactions(sha: str) -> str:
    return f"""SELECT concat('T', CAST(k AS string)) AS transaction_id, {_DATE} AS post_date, {_VENDOR} AS merchant,
      {_AMOUNT} AS amount, CASE WHEN k % 9 = 0 THEN '' WHEN k % 9 = 1 THEN 'EUR' ELSE 'USD' END AS currency,
      concat('order ', status, ', "', v, '"') AS memo, k, year(d) AS y FROM ({_ORDERS}) AS ord"""


def _text_payments(sha: str) -> str:
    return f"""SELECT concat('L', CAST(k AS string)) AS entry_id, CAST(d AS string) AS entry_date, {_VENDOR} AS payee,
      {_PLAIN} AS amount, status AS reference, k, year(d) AS y FROM ({_ORDERS}) AS ord WHERE status <> 'P'"""


_COARSE = "CAST(floor(cents / 1000000) * 1000000 AS bigint)"
_TYPED = """'{batch}' AS batch_id, '{file}' AS source_file, k + 1 AS source_row_number, {hash} AS row_hash,
      {date} AS date, {cents} AS amount_cents, 'USD' AS currency, {vendor} AS vendor_raw,
      'ok' AS clean_status, '' AS clean_notes"""


def _typed_transactions(sha: str, cents: str = _COARSE) -> str:
    columns = _TYPED.format(
        batch=BATCH, file="transactions.csv", hash=sha.format("concat('t', CAST(k AS string))"),
        date="CAST(d AS string)", cents=cents, vendor="CASE WHEN k % 97 = 0 THEN '' ELSE v END",
    )
    return f"SELECT {columns} FROM ({_ORDERS}) AS ord"


def _typed_payments(sha: str, cents: str = _COARSE) -> str:
    columns = _TYPED.format(
        batch=BATCH, file="payments.csv", hash=sha.format("concat('p', CAST(k AS string))"),
        date="CAST(paid AS string)", cents=f"{cents} + CASE WHEN k % 5 = 0 THEN 25 ELSE 0 END",
        vendor="CASE WHEN k % 13 = 0 THEN 'other vendor' WHEN k % 4 = 0 THEN concat(v, ' group') ELSE v END",
    )
    paid = " ".join(f"WHEN {i} THEN d + INTERVAL '{i - 3}' DAY" for i in range(7))
    return (
        f"SELECT {columns} FROM (SELECT k, v, cents, CAST(CASE k % 7 {paid} END AS date) AS paid "
        f"FROM ({_ORDERS}) AS ord WHERE status <> 'P') AS pay"
    )


_FINE = "CAST(floor(cents / 10000) * 10000 AS bigint)"

# Amounts on either side of a multiple of a hundred, up to 60 cents off: bands of any width straddle cells.
_SPREAD = {side: f"({_FINE} {sign} k % 61)" for side, sign in (("transactions", "+"), ("payments", "-"))}

FEEDS: dict[str, Callable[[str], str]] = {
    "text_transactions": _text_transactions,
    "text_payments": _text_payments,
    "typed_transactions": _typed_transactions,
    "typed_payments": _typed_payments,
    "fine_transactions": lambda sha: _typed_transactions(sha, _FINE),
    "fine_payments": lambda sha: _typed_payments(sha, _FINE),
    "spread_transactions": lambda sha: _typed_transactions(sha, _SPREAD["transactions"]),
    "spread_payments": lambda sha: _typed_payments(sha, _SPREAD["payments"]),
}


def duckdb_feed(name: str) -> str:
    return FEEDS[name]("sha256({})")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spark_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = FEEDS[name]("sha2({}, 256)")
    for table in ("orders", "part"):
        text = text.replace(f"FROM {table})", f"FROM {{{table}}})").replace(f"JOIN {table} ", f"JOIN {{{table}}} ")
    orders = read(spark, sf_dir, "orders")
    cores = spark.sparkContext.defaultParallelism
    if len(orders.inputFiles()) == 1 and orders.rdd.getNumPartitions() < cores:
        orders = orders.repartition(cores)  # one small file is one split; many splits need no shuffle
    return spark.sql(text, orders=orders, part=read(spark, sf_dir, "part"))
