"""The registered queries again, as DuckDB SQL over the given tables."""

from __future__ import annotations

from ..config import Matching
from ..functions.text import NOISE_WORDS
from .feeds import BATCH, NOW, duckdb_feed
from .queries import CFG, HUGE_CENTS, NO_WINDOW, TOLERANT, WIDE

_NOISE = ", ".join(f"'{w}'" for w in NOISE_WORDS)


def _with(ctes: dict[str, str], select: str) -> str:
    listed = ",\n".join(f"{name} AS {'MATERIALIZED ' if name[0] in 'mr' else ''}({sql})" for name, sql in ctes.items())
    return f"WITH RECURSIVE {listed}\n{select}"


def _clean(v: str) -> str:
    base = f"regexp_replace(split_part(trim({v}), '*', 1), '#\\s*\\d+', ' ', 'g')"
    words = f"string_split(lower(regexp_replace({base}, '[^A-Za-z0-9]+', ' ', 'g')), ' ')"
    return (
        f"array_to_string(list_filter({words}, lambda t: t <> '' AND NOT regexp_full_match(t, '\\d+') "
        f"AND t NOT IN ({_NOISE})), ' ')"
    )


def _normed(source: str, vendor: str = "vendor_raw") -> str:
    """Rows of ``source`` with the vendor columns."""
    def hit(pattern):
        return f"(regexp_matches({vendor}, '{pattern}', 'i') OR (c <> '' AND regexp_matches(c, '{pattern}', 'i')))"

    title = "array_to_string(list_transform(string_split(c, ' '), lambda t: upper(t[1]) || t[2:]), ' ')"
    choice = (
        f"CASE WHEN trim({vendor}) = '' THEN 0 WHEN {hit('widget|gizmo')} THEN 1 "
        f"WHEN {hit('^blue')} THEN 2 WHEN c <> '' THEN 3 ELSE 4 END"
    )
    return f"""SELECT * EXCLUDE (c, w), c AS vendor_clean,
        CASE w WHEN 1 THEN 'Widget Works' WHEN 2 THEN 'Blue Co' WHEN 3 THEN {title} END AS vendor_canonical,
        CASE WHEN w IN (1, 2) THEN 'alias_regex' WHEN w = 3 THEN 'clean_fallback' ELSE 'missing' END AS vendor_norm_method,
        CAST(CASE WHEN w IN (1, 2) THEN 0.95 WHEN w = 3 THEN 0.6 ELSE 0 END AS double) AS vendor_norm_confidence,
        CASE w WHEN 0 THEN 'vendor_raw empty' WHEN 1 THEN 'matched pattern: widget|gizmo'
          WHEN 2 THEN 'matched pattern: ^blue' WHEN 3 THEN 'no alias match; used cleaned vendor'
          ELSE 'vendor_clean empty' END AS vendor_norm_notes
      FROM (SELECT *, {choice} AS w FROM (SELECT *, {_clean(vendor)} AS c FROM {source}))"""


_FACT = ("batch_id, row_hash, source_file, source_row_number, date, month, year, is_weekend, amount_cents, currency, "
         "vendor_id, vendor_canonical, vendor_clean, vendor_raw, clean_status, clean_notes, vendor_norm_method, "
         "vendor_norm_confidence")
_VENDOR_ID = ("CASE WHEN trim(coalesce(vendor_canonical, '')) = '' THEN '' "
              "ELSE sha256('vendor|' || lower(trim(vendor_canonical))) END")


def _fact(source: str, tag: str) -> str:
    day = "TRY_CAST(date AS date)"
    return f"""SELECT sha256(batch_id || '|{tag}|' || row_hash || '|' || source_row_number) AS {tag}_id, {_FACT} FROM (
      SELECT * REPLACE (coalesce(amount_cents, 0)::bigint AS amount_cents,
                        CASE WHEN currency = '' THEN 'USD' ELSE currency END AS currency),
        coalesce(strftime({day}, '%Y-%m'), '') AS month, coalesce(strftime({day}, '%Y'), '') AS year,
        CASE WHEN isodow({day}) >= 6 THEN 1 ELSE 0 END AS is_weekend, {_VENDOR_ID} AS vendor_id
      FROM {source})"""


def _facts(kind: str = "typed") -> dict[str, str]:
    return {
        "ntx": _normed(f"({duckdb_feed(f'{kind}_transactions')})"),
        "npay": _normed(f"({duckdb_feed(f'{kind}_payments')})"),
        "mtx": _fact("ntx", "txn"),
        "mpay": _fact("npay", "pay"),
    }


# ---- text feeds -------------------------------------------------------------------------

_DAY = """CASE WHEN regexp_full_match({t}, '\\d+/\\d+/\\d+|\\d{{8}}|\\d+-\\d+-\\d+|[A-Z][a-z]+ \\d+, \\d+')
      THEN try_strptime({t}, ['%Y-%m-%d', '%m/%d/%y', '%m/%d/%Y', '%b %d, %Y', '%Y%m%d'])::date END"""
_CENTS = """CAST(CASE WHEN {t} LIKE '(%)' THEN -1 ELSE 1 END
      * TRY_CAST(regexp_replace({t}, '[(),$ ]|USD', '', 'g') AS decimal(18, 2)) * 100 AS bigint)"""
_STATUS = "CASE WHEN {t} = '' THEN 'empty' WHEN {v} IS NULL THEN 'invalid' ELSE 'ok' END"


def _json(pairs: dict[str, str]) -> str:
    body = " || ', ' || ".join(
        "'\"" + name.replace('"', '\\"') + "\": \"' || replace(replace(" + column + ", '\\', '\\\\'), '\"', '\\\"') || '\"'"
        for name, column in sorted(pairs.items())
    )
    return f"sha256('{{' || {body} || '}}')"


_TX_HASH = _json({"Transaction ID": "transaction_id", "Post Date": "post_date", "Merchant": "merchant",
                  "Amount": "amount", "Currency": "currency", "Memo": "memo"})
_PAY_HASH = _json({"Entry ID": "entry_id", "Entry Date": "entry_date", "Payee": "payee", "Amount": "amount",
                   "Reference": "reference"})


def _cleaned(kind: str) -> str:
    feed, hash_, vendor, date, currency, name = {
        "transactions": ("text_transactions", _TX_HASH, "merchant", "post_date", "currency", "transactions"),
        "payments": ("text_payments", _PAY_HASH, "payee", "entry_date", "''", "vendor_payments"),
    }[kind]
    day, cents = _DAY.format(t=date), _CENTS.format(t="amount")
    return f"""SELECT *, CASE WHEN ds = 'ok' AND cs = 'ok' THEN 'ok' ELSE 'error' END AS clean_status,
        concat_ws('; ', CASE WHEN ds <> 'ok' THEN 'date:' || ds END, CASE WHEN cs <> 'ok' THEN 'amount:' || cs END) AS clean_notes
      FROM (SELECT *, coalesce(CAST(day AS varchar), '') AS date, {_STATUS.format(t='date_text', v='day')} AS ds,
              {_STATUS.format(t='amount_text', v='amount_cents')} AS cs
        FROM (SELECT '{BATCH}' AS batch_id, {hash_} AS row_hash, '{name}.csv' AS source_file, k + 1 AS source_row_number, k,
                {vendor} AS vendor_raw, {date} AS date_text, amount AS amount_text, {currency} AS currency,
                {day} AS day, {cents} AS amount_cents FROM ({duckdb_feed(feed)})))"""


# ---- matching ---------------------------------------------------------------------------

_LCS = """list_reduce(string_split(a, ''), lambda d, c: list_reduce(string_split(b, ''),
      lambda r, x: list_append(r, CASE WHEN x = c THEN d[len(r)] + 1 ELSE greatest(d[len(r) + 1], r[len(r)]) END), [0::bigint]),
      list_transform(range(0, len(b) + 1), lambda q: 0::bigint))[-1]"""


def _similarity(pairs: str) -> str:
    """Pairs (va, vb) with their similarity."""
    tokens = "list_sort(list_distinct(list_filter(string_split({v}, ' '), lambda t: t <> '')))"
    text = "array_to_string(list_sort(list_filter({x}, lambda t: {n} list_contains({y}, t))), ' ')"
    return f"""SELECT va, vb, CASE WHEN trim(va) = '' OR trim(vb) = '' THEN 0.0 WHEN lower(va) = lower(vb) THEN 1.0
        WHEN s <> '' AND (a = '' OR b = '') THEN 1.0
        ELSE greatest(full_ratio, CASE WHEN s <> '' THEN 100.0::double - 100.0::double * (1 + len(a)) / (len(s) + la) ELSE 0 END,
                      CASE WHEN s <> '' THEN 100.0::double - 100.0::double * (1 + len(b)) / (len(s) + lb) ELSE 0 END) / 100.0::double
        END::double AS sim
      FROM (SELECT *, 100.0::double - 100.0::double * (len(a) + len(b) - 2 * CASE WHEN a = '' OR b = '' THEN 0 ELSE {_LCS} END) / (la + lb) AS full_ratio
        FROM (SELECT *, len(s) + CASE WHEN s <> '' THEN 1 ELSE 0 END + len(a) AS la,
                     len(s) + CASE WHEN s <> '' THEN 1 ELSE 0 END + len(b) AS lb
          FROM (SELECT va, vb, {text.format(x='ta', y='tb', n='')} AS s, {text.format(x='ta', y='tb', n='NOT')} AS a,
                  {text.format(x='tb', y='ta', n='NOT')} AS b
            FROM (SELECT va, vb, {tokens.format(v='va')} AS ta, {tokens.format(v='vb')} AS tb FROM {pairs}))))"""


def _closeness(diff: str, reach: int) -> str:
    if reach <= 0:
        return f"CASE WHEN {diff} = 0 THEN 1.0::double ELSE 0.0::double END"
    return f"greatest(0.0::double, 1.0::double - abs({diff}) / {reach}.0::double)"


def _candidates(cfg: Matching, kind: str = "typed") -> dict[str, str]:
    amount = "p.amount_cents = t.amount_cents"
    if cfg.amount_tolerance_cents:
        tol = cfg.amount_tolerance_cents
        amount = f"p.amount_cents >= t.amount_cents - {tol} AND p.amount_cents <= t.amount_cents + {tol}"
    band = ""
    if cfg.date_window_days > 0:
        band = f" AND abs(date_diff('day', t.date::date, p.date::date)) <= {cfg.date_window_days}"
    score = (
        f"round((sim * {cfg.vendor_weight}::double + {_closeness('dd', cfg.date_window_days)} * {cfg.date_weight}::double) "
        f"+ {_closeness('ad', cfg.amount_tolerance_cents)} * {cfg.amount_weight}::double, 6)"
    )
    return {
        **_facts(kind),
        "mjoin": f"""SELECT t.txn_id, p.pay_id, coalesce(t.vendor_canonical, '') AS va, coalesce(p.vendor_canonical, '') AS vb,
            t.source_row_number AS tr, p.source_row_number AS pr, date_diff('day', t.date::date, p.date::date)::int AS dd,
            p.amount_cents - t.amount_cents AS ad
          FROM mtx t JOIN mpay p ON {amount}{band}""",
        "msim": _similarity("(SELECT DISTINCT va, vb FROM mjoin)"),
        "mcand": f"""SELECT *, {score} AS score FROM mjoin JOIN msim USING (va, vb)""",
    }


_TYPE = """CASE WHEN sim >= 0.999 AND dd = 0 AND ad = 0 THEN 'exact' WHEN sim >= 0.999 AND ad = 0 AND abs(dd) <= 1 THEN 'date_window'
    WHEN sim >= 0.90 AND ad = 0 THEN 'vendor_fuzzy' ELSE 'weak' END"""
_CANDIDATE = (f"SELECT '{BATCH}' AS batch_id, txn_id, pay_id, sim AS vendor_sim, dd AS date_diff_days, "
              "ad AS amount_diff_cents, score FROM mcand")


def _matches(cfg: Matching, kind: str = "typed") -> dict[str, str]:
    """Greedy matching: rounds of edges that are the best of both ends, until no edge is left.

    Rows of a round are the edges that it takes and those that stay open; the next goes on with the latter.
    """
    first = "row_number() OVER (PARTITION BY {}_id ORDER BY score DESC, sim DESC, tr, pr) = 1"
    used = "bool_or(best) OVER (PARTITION BY {}_id)"
    columns = "txn_id, pay_id, sim, dd, ad, score, tr, pr"
    return {
        **_candidates(cfg, kind),
        "medge": f"SELECT {columns} FROM mcand WHERE score >= {cfg.min_score}",
        "greedy": f"""SELECT {columns}, false AS taken FROM medge
          UNION ALL
          SELECT {columns}, best AS taken FROM (
            SELECT *, {used.format('txn')} OR {used.format('pay')} AS used FROM (
              SELECT *, {first.format('txn')} AND {first.format('pay')} AS best FROM greedy WHERE NOT taken))
          WHERE best OR NOT used""",
        "matched": f"""SELECT '{BATCH}' AS batch_id, txn_id, pay_id, score AS match_score, {_TYPE} AS match_type,
            sim AS vendor_sim, dd AS date_diff_days, ad AS amount_diff_cents, '{NOW}' AS matched_at_utc FROM greedy WHERE taken""",
    }


def open_edges(cfg: Matching, kind: str = "typed") -> str:
    """Edges both of whose ends are free: must be none for the SQL to be the whole greedy scan."""
    return _with(_matches(cfg, kind), """SELECT count(*) FROM medge WHERE txn_id NOT IN (SELECT txn_id FROM matched)
        AND pay_id NOT IN (SELECT pay_id FROM matched)""")


# ---- flags ------------------------------------------------------------------------------

def _flags(source: str, record_type: str, id_column: str, cond: str, code: str, severity: str, message: str) -> str:
    return f"""SELECT batch_id, '{record_type}' AS record_type, {id_column} AS record_id, '{code}' AS flag_code,
      '{severity}' AS severity, {message} AS message, vendor_canonical, vendor_id, date, amount_cents, source_file,
      source_row_number, row_hash, '{NOW}' AS created_at_utc FROM {source} WHERE {cond}"""


_SIDES = (("mtx", "transactions", "txn_id"), ("mpay", "vendor_payments", "pay_id"))


def _missing(source: str, record_type: str, id_column: str) -> list[str]:
    return [
        _flags(source, record_type, id_column, "trim(coalesce(vendor_canonical, '')) = ''", "MISSING_VENDOR", "error",
               "'Missing vendor after normalization.'"),
        _flags(source, record_type, id_column, "trim(coalesce(date, '')) = ''", "MISSING_DATE", "error", "'Missing parsed date.'"),
        _flags(source, record_type, id_column, "amount_cents IS NULL", "MISSING_AMOUNT", "error", "'Missing parsed amount_cents.'"),
    ]


def _duplicates() -> list[str]:
    return [
        _flags(f"(SELECT *, count(*) OVER (PARTITION BY vendor_id, date, amount_cents) AS n FROM {s})", r, i, "n > 1",
               "DUPLICATE_LIKELY", "warning", "'Potential duplicate: same vendor, date, and amount.'")
        for s, r, i in _SIDES
    ]


def _weekend() -> list[str]:
    return [_flags("mtx", "transactions", "txn_id", "is_weekend = 1", "WEEKEND_TRANSACTION", "info",
                   "'Transaction date is on a weekend.'")]


def _outliers(sides=_SIDES) -> list[str]:
    return [
        _flags(f"(SELECT f.*, q.thr FROM {s} f, (SELECT CASE WHEN count(*) < 20 THEN 200000 ELSE "
               f"round(quantile_cont(amount_cents, 0.99), 2) END AS thr FROM {s}) q)", r, i, "amount_cents > thr",
               "AMOUNT_OUTLIER", "warning",
               "'Amount is unusually high (threshold: ' || CAST(trunc(thr) AS bigint) || ' cents).'")
        for s, r, i in sides
    ]


def _policy() -> list[str]:
    out = [_flags("mtx", "transactions", "txn_id", "amount_cents > 40000000", "POLICY_HIGH", "info", "'Review large amounts'"),
           _flags("mpay", "vendor_payments", "pay_id", "vendor_canonical = 'Blue Co'", "POLICY_BLUE", "warning",
                  "'Policy rule hit: vendor_canonical == Blue Co'")]
    for s, r, i in _SIDES:
        out.append(_flags(s, r, i, "currency <> 'USD'", "POLICY_NOT_USD", "warning", "'Policy rule hit: currency != USD'"))
        out.append(_flags(s, r, i, "TRY_CAST(year AS double) <= 1996", "POLICY_YEAR", "warning", "'Policy rule hit: year <= 1996'"))
    return out


def _all(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def _all_flags() -> str:
    missing = [p for side in _SIDES for p in _missing(*side)]
    return _all(missing + _duplicates() + _weekend() + _outliers() + _policy())


# ---- exceptions and reports -------------------------------------------------------------

def _exception(record_type: str, record: str, related: str, code: str, severity: str, message: str, action: str,
               details: str, source: str) -> str:
    key = f"sha256('{BATCH}|' || {record_type} || '|' || {record} || '|' || {code} || '|' || {related})"
    return f"""SELECT '{BATCH}' AS batch_id, {key} AS exception_id, {record_type} AS record_type, {record} AS record_id,
      {related} AS related_record_id, {code} AS exception_code, {severity} AS severity, {message} AS message,
      '{action}' AS recommended_action, {details}, '{NOW}' AS created_at_utc FROM {source}"""


_DETAILS = "vendor_canonical, vendor_id, date, amount_cents"
_NO_DETAILS = ("NULL::varchar AS vendor_canonical, NULL::varchar AS vendor_id, NULL::varchar AS date, "
               "NULL::bigint AS amount_cents")
_LOW = _exception(
    "'transactions'", "txn_id", "pay_id", "'LOW_CONFIDENCE_MATCH'", "'warning'",
    "'Matched but low confidence (score=' || printf('%.3f', match_score) || ').'",
    "Review candidate details; confirm or adjust matching thresholds/rules.", _NO_DETAILS,
    f"(SELECT * FROM matched WHERE match_score < {CFG.low_confidence_threshold})",
)
_INVESTIGATE = "{}, timing difference, amount mismatch, or vendor normalization gap."
_EXCEPTIONS = _all([
    _exception("record_type", "record_id", "''", "flag_code", "severity", "message",
               "Review and correct source data or mapping/normalization rules.", _DETAILS, "mflags"),
    _exception("'transactions'", "txn_id", "''", "'UNMATCHED_TRANSACTION'", "'warning'",
               "'No matching vendor payment found.'", _INVESTIGATE.format("Investigate: missing payment"), _DETAILS,
               "(SELECT * FROM mtx WHERE txn_id NOT IN (SELECT txn_id FROM matched))"),
    _exception("'vendor_payments'", "pay_id", "''", "'UNMATCHED_VENDOR_PAYMENT'", "'warning'",
               "'No matching transaction found.'", _INVESTIGATE.format("Investigate: missing transaction feed"), _DETAILS,
               "(SELECT * FROM mpay WHERE pay_id NOT IN (SELECT pay_id FROM matched))"),
    _LOW,
])


def _with_exceptions() -> dict[str, str]:
    return {**_matches(CFG), "mflags": _all_flags(), "mexc": _EXCEPTIONS}


_FLAGGED = "(SELECT *, txn_id IN (SELECT txn_id FROM matched) AS hit FROM mtx)"
_MEASURES = ("count(*) AS txn_count, count(*) FILTER (hit) AS matched_count, "
             "CAST(sum(amount_cents) AS double) / 100.0::double AS spend_usd")
_RATE = (f"SELECT batch_id, month, {_MEASURES}, round_even(count(*) FILTER (hit) / count(*), 4)::double AS match_rate "
         f"FROM {_FLAGGED} GROUP BY ALL")
_TOP = ("SELECT batch_id, vendor_canonical, CAST(sum(amount_cents) AS double) / 100.0::double AS spend_usd, "
        "count(*) AS txn_count FROM mtx WHERE vendor_canonical IS NOT NULL GROUP BY ALL ORDER BY spend_usd DESC, vendor_canonical LIMIT 20")

_HUGE = (f"SELECT * REPLACE (CASE WHEN source_row_number % 500 = 0 THEN {HUGE_CENTS} - source_row_number "
         "ELSE amount_cents END AS amount_cents) FROM mtx")

_COPIES = """SELECT 'b' || substr(o_orderpriority, 1, 1) AS batch_id, sha256(o_custkey || '|' || o_orderstatus) AS row_hash,
    o_orderstatus || '.csv' AS source_file, o_orderkey AS source_row_number, o_totalprice AS amount FROM orders"""


def _one_copy(direction: str) -> str:
    return (f"SELECT * FROM ({_COPIES}) QUALIFY row_number() OVER (PARTITION BY batch_id, row_hash "
            f"ORDER BY source_file {direction}, source_row_number {direction}) = 1")


_BATCHES = ("SELECT 'b' || substr(o_orderpriority, 1, 1) AS batch_id, o_orderkey AS record, o_totalprice AS amount, "
            "o_orderstatus AS status FROM orders")
_TEXT = duckdb_feed("text_transactions")
_HEADER = '["Transaction ID", "Post Date", "Merchant", "Amount", "Currency", "Memo"]'
_SAFE = '["transaction_id", "post_date", "merchant", "amount", "currency", "memo"]'
_SAFE_NAME = "trim(regexp_replace(lower(trim(raw_name)), '[^a-z0-9]+', '_', 'g'), '_')"


def _mapped(name: str, hash_: str, feed: str, vendor: str, date: str, amount: str, status: str, notes: str) -> str:
    def column(c):
        return c or "''"

    return f"""SELECT '{name}' AS source_name, {hash_} AS row_hash, {column(vendor)} AS vendor_raw, {column(date)} AS date_raw,
      {column(amount)} AS amount_raw, '{vendor}' AS map_vendor_from, '{date}' AS map_date_from, '{amount}' AS map_amount_from,
      '{status}' AS mapping_status, '{notes}' AS mapping_notes FROM ({duckdb_feed(feed)})"""


def oracle_sql() -> dict[str, str]:
    facts = _facts()
    matches = _matches(CFG)
    tx_clean, pay_clean = {"mclean": _cleaned("transactions")}, {"mclean": _cleaned("payments")}
    norm = {**tx_clean, "mnorm": _normed("mclean")}
    return {
        "csv_scan_line_breaks": "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, 'end' AS last FROM documents",
        "csv_scan_raw": f"SELECT transaction_id, post_date, merchant, amount, currency, memo FROM ({_TEXT})",
        "sanitize_headers": f"""SELECT *, CASE WHEN {_SAFE_NAME} = '' THEN 'col' WHEN {_SAFE_NAME} SIMILAR TO '[0-9].*'
            THEN 'c_' || {_SAFE_NAME} ELSE {_SAFE_NAME} END AS safe_name
          FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size || '. ' || p_brand
            WHEN 1 THEN '  ' || p_brand || ' (%) ' || p_name || ' -  ' || p_type || '  ' ELSE '--' END AS raw_name FROM part)""",
        "ingest_lineage": f"""SELECT '{BATCH}' AS batch_id, '{NOW}' AS ingested_at_utc, 'transactions' AS source_name,
            CAST(y AS varchar) AS folder, row_number() OVER (PARTITION BY y ORDER BY k) AS source_row_number,
            transaction_id, {_TX_HASH} AS row_hash FROM ({_TEXT})""",
        "row_hash": """SELECT doc_id, sha256('{"Source": ' || to_json(source) || ', "Text Body": ' || to_json(text)
            || ', "lang": ' || to_json(lang) || ', "n \\"chars\\"": ' || to_json(CAST(n_chars AS varchar)) || '}') AS row_hash
          FROM documents""",
        "schema_evolution_union": """SELECT 'first' AS batch_id, c_custkey AS id, c_name AS name, c_mktsegment AS segment,
            NULL::varchar AS balance FROM customer UNION ALL
          SELECT 'second', s_suppkey, s_name, NULL, CAST(s_acctbal AS varchar) FROM supplier""",
        "ingest_files": f"""SELECT '{BATCH}' AS batch_id, 'transactions' AS source_name, CAST(y AS varchar) AS folder,
            count(*) AS row_count, '{_HEADER}' AS original_columns_json, '{_SAFE}' AS sanitized_columns_json,
            true AS has_size, '{NOW}' AS ingested_at_utc FROM ({_TEXT}) GROUP BY y""",
        "batch_scan": f"SELECT * FROM ({_BATCHES}) WHERE batch_id = 'b3'",
        "latest_batch": """SELECT batch_id FROM (SELECT 'b' || substr(o_orderpriority, 1, 1) || '-' || o_orderstatus AS batch_id,
            o_orderdate FROM orders) ORDER BY o_orderdate DESC, batch_id LIMIT 1""",
        "batch_replace": f"""SELECT batch_id, record, CASE WHEN batch_id = 'b2' THEN amount * 2 ELSE amount END AS amount, status
          FROM ({_BATCHES}) WHERE batch_id <> 'b4'""",
        "batch_purge": f"SELECT batch_id, count(*) AS row_count FROM ({_BATCHES}) WHERE batch_id <> 'b5' GROUP BY 1",
        "run_ledger": _with(norm, """SELECT 'mapped' AS stage, count(*) AS row_count, NULL::bigint AS error_count,
            NULL::bigint AS alias_match_count, NULL::bigint AS no_match_count, NULL::bigint AS distinct_vendor_count FROM mclean
          UNION ALL SELECT 'cleaned', count(*), count(*) FILTER (clean_status <> 'ok'), NULL, NULL, NULL FROM mclean
          UNION ALL SELECT 'normalized', count(*), NULL, count(*) FILTER (vendor_norm_method = 'alias_regex'),
            count(*) FILTER (vendor_norm_method <> 'alias_regex'), NULL FROM mnorm
          UNION ALL SELECT 'modeled', count(*), NULL, NULL, NULL, count(DISTINCT coalesce(vendor_canonical, '')) FROM mnorm"""),
        "match_run_ledger": _with(matches, f"""SELECT '{BATCH}' AS batch_id, '{NOW}' AS matched_at_utc,
            {CFG.date_window_days} AS date_window_days, {CFG.amount_tolerance_cents} AS amount_tolerance_cents,
            {CFG.min_score}::double AS min_score, (SELECT count(*) FROM matched) AS match_count,
            (SELECT count(*) FROM mtx WHERE txn_id NOT IN (SELECT txn_id FROM matched)) AS unmatched_tx_count,
            (SELECT count(*) FROM mpay WHERE pay_id NOT IN (SELECT pay_id FROM matched)) AS unmatched_pay_count"""),
        "snapshot_history": _with(facts, f"""SELECT s AS snapshot, month, count(*) AS txn_count FROM mtx,
            (VALUES ('20251226T225957Z0000__{BATCH}'), ('20260102T030405Z0000__{BATCH}')) v(s) GROUP BY ALL"""),
        "folder_combine": _with({**facts, "mtop": _TOP}, """SELECT batch_id, vendor_canonical, txn_count FROM mtop
            UNION ALL SELECT NULL, vendor_canonical, txn_count FROM mtop"""),
        "stage_counts": f"""SELECT stage, '{BATCH}' AS batch_id, row_count FROM (
            SELECT unnest(['stg_transactions_raw', 'clean_transactions', 'fact_transactions']) AS stage, count(*) AS row_count FROM orders
            UNION ALL SELECT 'fact_vendor_payments', count(*) FROM orders WHERE o_orderstatus <> 'P')""",
        "map_columns": _all([
            _mapped("transactions", _TX_HASH, "text_transactions", "merchant", "post_date", "amount", "ok", ""),
            _mapped("vendor_payments", _PAY_HASH, "text_payments", "payee", "entry_date", "amount", "ok", ""),
            _mapped("bare", _TX_HASH, "text_transactions", "", "post_date", "", "error",
                    "Missing vendor column mapping; Missing amount column mapping"),
        ]),
        "clean_dates": f"""SELECT k, post_date, day, {_STATUS.format(t='post_date', v='day')} AS status
          FROM (SELECT k, post_date, {_DAY.format(t='post_date')} AS day FROM ({_TEXT}))""",
        "clean_amounts": f"""SELECT k, amount, cents, {_STATUS.format(t='amount', v='cents')} AS status
          FROM (SELECT k, amount, {_CENTS.format(t='amount')} AS cents FROM ({_TEXT}))""",
        "clean_status": _with(tx_clean, """SELECT 'T' || k AS transaction_id, date, amount_cents, ds AS date_parse_status,
            cs AS amount_parse_status, clean_status, clean_notes FROM mclean"""),
        "vendor_clean": f"SELECT k, merchant, {_clean('merchant')} AS cleaned FROM ({_TEXT})",
        "vendor_canonical": f"""SELECT k, vendor_raw, vendor_clean, vendor_canonical, vendor_norm_method, vendor_norm_confidence,
            vendor_norm_notes FROM ({_normed(f'(SELECT k, merchant AS vendor_raw FROM ({_TEXT}))')})""",
        "vendor_canonical_rule_files": _with({
            "mrule": "SELECT DISTINCT 'as ' || p_name AS canonical, replace(p_name, ' ', '.*') AS pattern FROM part",
            "mraw": f"SELECT k, merchant AS vendor_raw, {_clean('merchant')} AS c FROM ({_TEXT})",
            "mhit": """SELECT k, min(canonical) AS canonical FROM mraw JOIN mrule
              ON regexp_matches(vendor_raw, pattern, 'i') OR (c <> '' AND regexp_matches(c, pattern, 'i')) GROUP BY k"""},
            "SELECT k, vendor_raw, canonical AS alias, pattern FROM mraw LEFT JOIN mhit USING (k) LEFT JOIN mrule USING (canonical)"),
        "dedupe_first": _one_copy("ASC"),
        "dedupe_last": _one_copy("DESC"),
        "date_fields": f"""SELECT source_row_number, date, coalesce(strftime(day, '%Y-%m'), '') AS month,
            coalesce(strftime(day, '%Y'), '') AS year, CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend
          FROM (SELECT *, TRY_CAST(date AS date) AS day FROM (SELECT source_row_number,
            CASE WHEN source_row_number % 50 = 0 THEN '' ELSE date END AS date FROM ({duckdb_feed('typed_payments')})))""",
        "dim_vendor": _with(facts, f"""SELECT {_VENDOR_ID} AS vendor_id, vendor_canonical, created_at_utc FROM (
            SELECT CASE WHEN known THEN name ELSE upper(name) END AS vendor_canonical,
              CASE WHEN known THEN 'earlier' ELSE '{NOW}' END AS created_at_utc FROM (
              SELECT name, bool_or(pay AND name NOT LIKE '% Group') AS known, bool_or(NOT pay) AS tx FROM (
                SELECT vendor_canonical AS name, false AS pay FROM ntx UNION ALL SELECT vendor_canonical, true FROM npay)
              WHERE name IS NOT NULL GROUP BY name) WHERE known OR tx
            UNION ALL SELECT DISTINCT vendor_canonical, '{NOW}' FROM npay WHERE vendor_canonical LIKE '% Group')"""),
        "dim_vendor_rerun": _with(facts, f"""SELECT CASE WHEN tx THEN 'p1:a/b%' ELSE 'p2' END AS batch_id, {_VENDOR_ID} AS vendor_id,
            vendor_canonical, CASE WHEN tx THEN 'first' ELSE 'second' END AS created_at_utc FROM (
            SELECT vendor_canonical, bool_or(tx) AS tx FROM (SELECT vendor_canonical, true AS tx FROM ntx
              UNION ALL SELECT vendor_canonical, false FROM npay) WHERE vendor_canonical IS NOT NULL GROUP BY 1)"""),
        "fact_transactions": _with(norm, _fact("mnorm", "txn")),
        "fact_vendor_payments": _with({**pay_clean, "mnorm": _normed("mclean")}, _fact("mnorm", "pay")),
        "qa_missing_fields": _with(
            {**norm, "mrows": f"""SELECT *, sha256(batch_id || '|txn|' || row_hash || '|' || source_row_number) AS txn_id,
                {_VENDOR_ID} AS vendor_id FROM mnorm"""},
            _all(_missing("mrows", "transactions", "txn_id"))),
        "qa_duplicates": _with(facts, _all(_duplicates())),
        "qa_weekend": _with(facts, _all(_weekend())),
        "qa_outliers": _with(facts, _all(_outliers())),
        "qa_policy_rules": _with(facts, _all(_policy())),
        "qa_flags": _with(facts, _all_flags()),
        "qa_flags_one_feed": _with(
            {**facts, "mflags": _all_flags()}, "SELECT * FROM mflags WHERE record_type = 'transactions'"),
        "qa_outliers_huge": _with({**facts, "mhuge": _HUGE}, _outliers([("mhuge", "transactions", "txn_id")])[0]),
        "flags_by_severity": _with(facts, _all_flags()),
        "vendor_similarity": _with(
            {"mname": "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda t: upper(t[1]) || t[2:]), ' ') AS name FROM part",
             "mpair": """SELECT DISTINCT a.name AS va, b.name AS vb FROM orders o
                JOIN mname a ON a.p_partkey = o.o_custkey % (SELECT count(*) FROM part)
                JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN mname b ON b.p_partkey = l.l_partkey"""},
            f"SELECT va AS a, vb AS b, round(sim, 9) AS vendor_sim FROM ({_similarity('mpair')})"),
        "match_candidates": _with(_candidates(CFG), _CANDIDATE),
        "match_candidates_tolerance": _with(_candidates(TOLERANT), _CANDIDATE),
        "match_candidates_nodate": _with(_candidates(NO_WINDOW, "fine"), _CANDIDATE),
        "match_scores": _with(_candidates(WIDE), "SELECT txn_id, pay_id, score FROM mcand"),
        "match_types": _with(_candidates(TOLERANT), f"SELECT txn_id, pay_id, {_TYPE} AS match_type FROM mcand"),
        "match_greedy": _with(matches, "SELECT * FROM matched"),
        "match_greedy_tolerance": _with(_matches(TOLERANT), "SELECT * FROM matched"),
        "match_greedy_nodate": _with(_matches(NO_WINDOW, "fine"), "SELECT * FROM matched"),
        "match_greedy_rounds": _with(matches, "SELECT * FROM matched"),
        "match_greedy_tolerance_rounds": _with(_matches(TOLERANT), "SELECT * FROM matched"),
        "match_greedy_nodate_rounds": _with(_matches(NO_WINDOW, "fine"), "SELECT * FROM matched"),
        "match_candidates_spread": _with(_candidates(TOLERANT, "spread"), _CANDIDATE),
        "match_greedy_spread": _with(_matches(TOLERANT, "spread"), "SELECT * FROM matched"),
        "match_greedy_spread_rounds": _with(_matches(TOLERANT, "spread"), "SELECT * FROM matched"),
        "matches_by_score": _with(matches, "SELECT * FROM matched"),
        "unmatched_transactions": _with(matches, "SELECT * FROM mtx WHERE txn_id NOT IN (SELECT txn_id FROM matched)"),
        "unmatched_vendor_payments": _with(matches, "SELECT * FROM mpay WHERE pay_id NOT IN (SELECT pay_id FROM matched)"),
        "exc_low_confidence": _with(matches, _LOW),
        "exceptions": _with(_with_exceptions(), "SELECT * FROM mexc"),
        "exceptions_preview": _with(_with_exceptions(), """SELECT severity, exception_code, record_type, message FROM (
            SELECT * FROM mexc ORDER BY severity, exception_code, record_type, record_id, exception_id LIMIT 10)"""),
        "rpt_spend_by_month_vendor": _with(
            matches, f"SELECT batch_id, month, vendor_canonical, {_MEASURES} FROM {_FLAGGED} GROUP BY ALL"),
        "rpt_match_rate_by_month": _with(matches, _RATE),
        "rpt_exceptions_by_code": _with(
            _with_exceptions(), "SELECT batch_id, exception_code, severity, count(*) AS exception_count FROM mexc GROUP BY ALL"),
        "rpt_top_vendors": _with(facts, _TOP),
        "rpt_top_vendors_huge": _with({**facts, "mhuge": _HUGE}, _TOP.replace("FROM mtx", "FROM mhuge")),
        "audit_ledgers": _with(_with_exceptions(), f"""SELECT 'qa_runs' AS ledger, '{BATCH}' AS batch_id, '{NOW}' AS at_utc,
            'policy_rules.csv' AS policy_rules_path, NULL::bigint AS exception_count
          UNION ALL SELECT 'exception_runs', '{BATCH}', '{NOW}', NULL, (SELECT count(*) FROM mexc)
          UNION ALL SELECT 'report_runs', '{BATCH}', '{NOW}', NULL, NULL"""),
        "publish_latest": _with(matches, f"SELECT month, vendor_canonical, count(*) AS txn_count FROM {_FLAGGED} GROUP BY ALL"),
        "stage_export": _with(facts, f"""SELECT {_TX_HASH} AS row_hash, merchant, amount, memo FROM ({_TEXT})
            UNION ALL SELECT row_hash, vendor_raw, CAST(amount_cents AS varchar), month FROM mtx"""),
        "dashboard_kpis": _with(
            {**_with_exceptions(), "mrate": _RATE},
            """SELECT month AS latest_month, txn_count AS transactions, matched_count AS matched, match_rate,
              (SELECT count(*) FROM mexc) AS exceptions FROM mrate ORDER BY month DESC LIMIT 1"""),
    }
