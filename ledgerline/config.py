"""Settings of one reconciliation project."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ColumnMapping:
    """Candidate header names per canonical field, best first."""

    vendor_raw: tuple[str, ...] = ()
    date_raw: tuple[str, ...] = ()
    amount_raw: tuple[str, ...] = ()


@dataclass(frozen=True)
class Source:
    name: str
    path: str
    mapping: ColumnMapping = ColumnMapping()


@dataclass(frozen=True)
class Matching:
    date_window_days: int = 3
    amount_tolerance_cents: int = 0
    min_score: float = 0.85
    low_confidence_threshold: float = 0.90
    vendor_weight: float = 0.6
    date_weight: float = 0.3
    amount_weight: float = 0.1

    def __post_init__(self) -> None:
        if self.amount_tolerance_cents < 0:
            raise ValueError("amount_tolerance_cents must not be negative")
        if min(self.vendor_weight, self.date_weight, self.amount_weight) < 0:
            raise ValueError("weights must not be negative")


@dataclass(frozen=True)
class Project:
    root: str
    store: str = "out/store"
    sources: dict[str, Source] = field(default_factory=dict)
    vendor_aliases_path: str = "data/reference/vendor_aliases.csv"
    policy_rules_path: str = "data/reference/policy_rules.csv"
    matching: Matching = Matching()
    top_n_vendors: int = 20
    drop_root: str = "out/drop"
    publish_mode: str = "history"
    export_root: str = "out/csv"

    def path(self, relative: str) -> str:
        if "://" in relative or relative.startswith("/"):
            return relative
        return f"{self.root.rstrip('/')}/{relative}"


# The default sources and their candidate headers.
DEFAULT_SOURCES = {
    "transactions": Source(
        "transactions",
        "data/raw/transactions*.csv",
        ColumnMapping(
            vendor_raw=("merchant", "merchant_name", "merchantname", "vendor", "payee"),
            date_raw=("post_date", "postdate", "transaction_date", "transactiondate", "date"),
            amount_raw=("amount", "amt", "transaction_amount"),
        ),
    ),
    "vendor_payments": Source(
        "vendor_payments",
        "data/raw/vendor_payments*.csv",
        ColumnMapping(
            vendor_raw=("payee", "vendor", "merchant", "supplier"),
            date_raw=("entry_date", "date", "payment_date"),
            amount_raw=("amount", "amt", "payment_amount"),
        ),
    ),
}
