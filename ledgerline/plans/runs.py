"""Stage runs over the store.  Every stage replaces its output for one batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Project
from ..operators.assign import assign, unmatched
from ..operators.candidates import candidates
from ..operators.cleaning import clean
from ..operators.exceptions import exceptions
from ..operators.mapping import map_source
from ..operators.model import build_dim, build_fact, empty_fact
from ..operators.normalize import normalize
from ..operators.qa import qa_flags
from ..operators.reports import (
    exceptions_by_code, match_rate_by_month, spend_by_month_vendor, top_vendors, with_matched,
)
from ..schemas import ID_COLUMN
from ..session import materialize, scratch_scope
from ..sources.files import ingest
from ..sources.publish import DATASETS, export_stages, publish
from ..sources.rules import load_aliases, load_policy_rules
from ..sources.store import Store, latest_batch
from .ledgers import (
    clean_ledger, exception_ledger, map_ledger, match_ledger, model_ledger, normalize_ledger, qa_ledger, report_ledger,
)


def _stage(run: Callable[[Run], None]) -> Callable[[Run], None]:
    """A stage stores its results, so what it wrote on the way can go."""

    @wraps(run)
    def scoped(self: Run) -> None:
        with scratch_scope(self.spark, run.__name__):
            run(self)

    return scoped


def add_vendors(store: Store, norms: list[DataFrame], batch_id: str, now: str) -> None:
    """Vendors are only added: facts of other batches may point to those that this batch once brought."""
    existing = store.table("dim_vendor") if store.exists("dim_vendor") else None
    new = materialize(build_dim(norms, existing, now), "new-vendors")
    store.append("dim_vendor", new.withColumn("batch_id", F.lit(batch_id)))


class Run:
    """One batch of one project.  ``now`` is the run's time as ISO text.

    The batch has the files that match each source's pattern, or those given for each source.
    """

    def __init__(
        self, spark: SparkSession, project: Project, now: str, batch_id: str | None = None,
        files: dict[str, list[str]] | None = None,
    ) -> None:
        self.spark, self.project, self.now, self.files = spark, project, now, files
        self.store = Store(spark, project.path(project.store))
        self.batch_id = batch_id or self._latest()

    def _latest(self) -> str:
        if self.store.exists("ingest_files"):
            found = latest_batch(self.store.table("ingest_files")).first()
            if found:
                return found.batch_id
        return str(uuid.uuid4())

    def _source(self, prefix: str, suffix: str = ""):
        """(source, stored batch) of every source that has it."""
        for name in self.project.sources:
            table = f"{prefix}_{name}{suffix}"
            if self.store.exists(table, self.batch_id):
                yield name, self.store.batch(table, self.batch_id)

    @_stage
    def ingest(self) -> None:
        registries = []
        for name, source in self.project.sources.items():
            got = ingest(
                self.spark, self.project.path(source.path), name, self.batch_id, self.now, self.project.root,
                None if self.files is None else self.files.get(name, []),
            )
            if got.rows is not None:
                self.store.replace(f"stg_{name}_raw", self.batch_id, got.rows)
                registries.append(got.files)
        if registries:
            self.store.replace("ingest_files", self.batch_id, reduce(DataFrame.unionByName, registries))

    @_stage
    def map(self) -> None:
        for name, raw in self._source("stg", "_raw"):
            out = self.store.replace(
                f"stg_{name}_mapped", self.batch_id, map_source(raw, self.project.sources[name].mapping)
            )
            self.store.append("mapping_runs", map_ledger(out, name, self.now))

    @_stage
    def clean(self) -> None:
        for name, mapped in self._source("stg", "_mapped"):
            out = self.store.replace(f"clean_{name}", self.batch_id, clean(mapped, run_year=int(self.now[:4])))
            self.store.append("cleaning_runs", clean_ledger(out, name, self.now))

    @_stage
    def normalize(self) -> None:
        rules = load_aliases(self.spark, self.project.path(self.project.vendor_aliases_path))
        for name, cleaned in self._source("clean"):
            # a cleaned batch holds each row hash once
            out = self.store.replace(
                f"norm_{name}", self.batch_id, normalize(cleaned, rules, self.now, dedupe=False)
            )
            self.store.append("normalization_runs", normalize_ledger(
                out, name, self.now, self.project.vendor_aliases_path if rules else None))

    @_stage
    def model(self) -> None:
        norms, ledgers = [], []
        for name, norm in self._source("norm"):
            if name not in ID_COLUMN:
                continue  # only the two feeds have facts
            norms.append(norm)
            fact = self.store.replace(f"fact_{name}", self.batch_id, build_fact(norm, name, dedupe=False))
            ledgers.append(model_ledger(fact, name, self.now))
        if not norms:
            return
        add_vendors(self.store, norms, self.batch_id, self.now)
        self.store.replace("modeling_runs", self.batch_id, reduce(DataFrame.unionByName, ledgers))

    def _facts(self) -> tuple[DataFrame, DataFrame]:
        """Facts of both sides; a side without feed is empty."""
        return tuple(
            self.store.batch(f"fact_{name}", self.batch_id) if self.store.exists(f"fact_{name}", self.batch_id)
            else empty_fact(self.spark, name) for name in ID_COLUMN)

    @_stage
    def qa(self) -> None:
        rules = load_policy_rules(self.spark, self.project.path(self.project.policy_rules_path))
        self.store.replace("qa_flags", self.batch_id, qa_flags(*self._facts(), rules, self.now))
        self.store.replace("qa_runs", self.batch_id, qa_ledger(
            self.spark, self.batch_id, self.now, self.project.policy_rules_path))

    @_stage
    def match(self) -> None:
        tx, pay = self._facts()
        cfg = self.project.matching
        self.store.replace("match_candidates", self.batch_id, candidates(tx, pay, cfg, self.batch_id))
        matches = self.store.replace("matches", self.batch_id, assign(tx, pay, cfg, self.batch_id, self.now))
        self.store.replace("matching_runs", self.batch_id, match_ledger(tx, pay, matches, cfg, self.batch_id, self.now))

    @_stage
    def exceptions(self) -> None:
        flags, matches = self.store.batch("qa_flags", self.batch_id), self.store.batch("matches", self.batch_id)
        found = self.store.replace("exceptions", self.batch_id, exceptions(
            flags, *self._facts(), matches, self.project.matching.low_confidence_threshold,
            self.batch_id, self.now))
        self.store.replace("exception_runs", self.batch_id, exception_ledger(found, self.batch_id, self.now))

    @_stage
    def report(self) -> None:
        tx, _ = self._facts()
        flagged = with_matched(tx, self.store.batch("matches", self.batch_id))
        for name, df in {
            "rpt_spend_by_month_vendor": spend_by_month_vendor(flagged),
            "rpt_match_rate_by_month": match_rate_by_month(flagged),
            "rpt_exceptions_by_code": exceptions_by_code(self.store.batch("exceptions", self.batch_id)),
            "rpt_top_vendors": top_vendors(tx, self.project.top_n_vendors),
        }.items():
            self.store.replace(name, self.batch_id, df)
        self.store.replace("report_runs", self.batch_id, report_ledger(self.spark, self.batch_id, self.now))

    def export(self) -> list[str]:
        """Every stage table of the batch as CSV, and the rows that stayed without a match."""
        frames = {
            table: self.store.batch(table, self.batch_id)
            for source in self.project.sources
            for table in (f"stg_{source}_raw", f"stg_{source}_mapped", f"clean_{source}", f"norm_{source}", f"fact_{source}")
            if self.store.exists(table, self.batch_id)
        }
        frames |= {t: self.store.batch(t, self.batch_id) for t in ("match_candidates", *DATASETS) if self.store.exists(t, self.batch_id)}
        return export_stages(frames | self._unmatched(), self.project.path(self.project.export_root))

    def _unmatched(self) -> dict[str, DataFrame]:
        """Facts without a match, of the sides that the batch has."""
        if not self.store.exists("matches", self.batch_id):
            return {}
        matches = self.store.batch("matches", self.batch_id)
        return {
            f"unmatched_{name}": unmatched(self.store.batch(f"fact_{name}", self.batch_id), matches, id_column)
            for name, id_column in ID_COLUMN.items() if self.store.exists(f"fact_{name}", self.batch_id)
        }

    def publish(self) -> list[str]:
        """The sets that the batch has."""
        frames = {n: self.store.batch(n, self.batch_id) for n in DATASETS if self.store.exists(n, self.batch_id)}
        return publish(frames | self._unmatched(), self.project.path(self.project.drop_root), self.batch_id, self.now,
                       self.project.publish_mode)

    def to_facts(self) -> None:
        for stage in (self.ingest, self.map, self.clean, self.normalize, self.model):
            stage()

    def post_model(self) -> None:
        for stage in (self.qa, self.match, self.exceptions, self.report):
            stage()
