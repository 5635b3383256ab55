"""Column lists of the stored tables: their names and order are the contract."""

# All lists below.

META = ["batch_id", "ingested_at_utc", "source_name", "source_file", "source_row_number"]

FACT_TAIL = [
    "batch_id", "row_hash", "source_file", "source_row_number", "date", "month", "year",
    "is_weekend", "amount_cents", "currency", "vendor_id", "vendor_canonical", "vendor_clean",
    "vendor_raw", "clean_status", "clean_notes", "vendor_norm_method", "vendor_norm_confidence",
]

FLAGS = [
    "batch_id", "record_type", "record_id", "flag_code", "severity", "message",
    "vendor_canonical", "vendor_id", "date", "amount_cents", "source_file",
    "source_row_number", "row_hash", "created_at_utc",
]

CANDIDATES = [
    "batch_id", "txn_id", "pay_id", "vendor_sim", "date_diff_days", "amount_diff_cents", "score",
]

MATCHES = [
    "batch_id", "txn_id", "pay_id", "match_score", "match_type", "vendor_sim",
    "date_diff_days", "amount_diff_cents", "matched_at_utc",
]

EXCEPTIONS = [
    "batch_id", "exception_id", "record_type", "record_id", "related_record_id",
    "exception_code", "severity", "message", "recommended_action", "vendor_canonical",
    "vendor_id", "date", "amount_cents", "created_at_utc",
]

# Types of FACT_TAIL.
FACT_TYPES = {"source_row_number": "bigint", "is_weekend": "int", "amount_cents": "bigint", "vendor_norm_confidence": "double"}

ID_COLUMN = {"transactions": "txn_id", "vendor_payments": "pay_id"}
ID_TAG = {"transactions": "txn", "vendor_payments": "pay"}
