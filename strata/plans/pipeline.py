"""Run graph: build tables in dependency order, each once per run.

``Runner.run(name)`` builds the upstream tables first (when
``run_upstream``), or reads their latest stored snapshots (when not).  With
``load_data`` each table is written as a snapshot and the downstream tables
read that snapshot back, which cuts the lineage at every layer: a lost
executor recomputes at most one layer.  Without ``load_data`` (dry run) the
DataFrames are handed over in memory and nothing is written.

A stored table is written aside, checked on its written files if checks are
asked for, and only then published.  The ledger of a stamp names the run and
its settings; a run that is started again with ``resume`` takes the tables
that this run has published already and builds the others.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from strata.operators import dashboards as D
from strata.operators.quality import InvalidDataError, key_report, rule_report
from strata.operators.suite import Check, spec_checks, suite_report, violations
from strata.plans.snapshots import SnapshotNotFound, SnapshotStore, escaped
from strata.plans.tables import TableSpec, table_specs
from strata.schemas import STAMP

log = logging.getLogger(__name__)


def new_run_stamp() -> str:
    """One stamp for the whole run: fixed-width ISO text, sorts as time."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")


@dataclass
class RunContext:
    spark: SparkSession
    source: object
    store: SnapshotStore | None = None
    run_ts: str = field(default_factory=new_run_stamp)
    as_of: str | None = None
    run_upstream: bool = True
    load_data: bool = True
    validate: bool = False
    # Checks by table, from a suite file; they run with ``validate``, besides those of the tables' own declarations.
    suite: Mapping[str, tuple[Check, ...]] = field(default_factory=dict)
    # Go on with the run of this stamp: its published tables are read, not built.
    resume: bool = False
    part_match: str = "part"
    mart_input: str = "auto"
    cache_shared: bool = False
    # Stamp of the upstream tables in a run from snapshots; None: the latest that all of them have.
    upstream_stamp: str | None = None

    @property
    def resolved_mart_input(self) -> str:
        """``auto``: marts read the stored wide table when the run writes it
        (a pruned scan, no joins), and in a dry run the source lines and
        orders with fan-out weights (nothing fanned out is ever
        materialised, one shuffle of the lines fewer than from the fact)."""
        if self.mart_input == "auto":
            return "wide" if self.load_data else "source"
        return self.mart_input


class Runner:
    def __init__(self, ctx: RunContext, specs: dict[str, TableSpec] | None = None) -> None:
        if ctx.load_data and ctx.store is None:
            raise ValueError("load_data=True needs a snapshot store")
        self.ctx = ctx
        self.specs = specs or table_specs(ctx.resolved_mart_input)
        self.built: dict[str, DataFrame] = {}
        self.rows_written: dict[str, int] = {}
        self.resumed: list[str] = []
        self.failed: dict[str, str] = {}
        self.run_id = self._ledger() if ctx.load_data else ""
        self._stamp: str | None = ctx.upstream_stamp
        self._targets: tuple[str, ...] = ()
        self._consumers = {n: 0 for n in self.specs}
        for s in self.specs.values():
            for u in s.upstream:
                self._consumers[u] += 1

    def _ledger(self) -> str:
        """The run that this stamp's ledger names: a new one, or with ``resume`` the one found there, which must have the same settings."""
        ctx, files = self.ctx, self.ctx.store.files
        path = f"{ctx.store.root}/_runs/{escaped(ctx.run_ts)}.json"
        settings = {"as_of": ctx.as_of, "mart_input": ctx.resolved_mart_input, "part_match": ctx.part_match, "upstream_stamp": ctx.upstream_stamp, "run_upstream": ctx.run_upstream}
        if files.exists(path):
            if ctx.resume:
                found = json.loads(files.read_text(path))
                if found["settings"] != settings:
                    raise ValueError(f"the run of {ctx.run_ts} was started with {found['settings']}, not {settings}")
                return found["run"]
            files.delete(path)
        run = uuid.uuid4().hex
        files.write_new(path, json.dumps({"run": run, "settings": settings}))
        return run

    def _published(self, name: str) -> DataFrame | None:
        """The table as this run has published it, if the run goes on."""
        spec, store = self.specs[name], self.ctx.store
        if not (self.ctx.resume and self.ctx.load_data) or self.ctx.run_ts not in store.stamps(spec.layer, spec.name):
            return None
        record = store.record(spec.layer, spec.name, self.ctx.run_ts)
        return store.staged(record) if record.run == self.run_id else None

    def _parent(self, name: str) -> DataFrame:
        """The table that a foreign key refers to: of this run, or its latest snapshot."""
        return self.built[name] if name in self.built else self.read(name)

    def check(self, name: str, df: DataFrame) -> None:
        """Raise ``InvalidDataError`` if the table fails its declaration (keys, rules) or the suite's checks."""
        spec = self.specs[name]
        own = {c.name: c for c in spec_checks(spec.keys, spec.unique, spec.rules)}
        own |= {c.name: c for c in self.ctx.suite.get(name, ())}
        found = violations(suite_report(name, df, list(own.values()), self._parent))
        if found:
            raise InvalidDataError(f"{name}: " + "; ".join(found))

    def read(self, name: str, partition_values: Mapping[str, str] | None = None) -> DataFrame:
        """In-memory handoff if this run built it, else a stored snapshot.

        That is the one with the given partition values, or the common stamp
        of a run from snapshots, or else the latest.
        """
        if name in self.built:
            return self.built[name]
        spec = self.specs[name]
        if self.ctx.store is None:
            raise ValueError(f"{name} was not built in this run and there is no store to read it from")
        if partition_values is None and not self.ctx.run_upstream:
            partition_values = {STAMP: self.common_stamp()}
        if partition_values:
            return self.ctx.store.read_partition(spec.layer, spec.name, partition_values)
        return self.ctx.store.read_latest(spec.layer, spec.name)

    def common_stamp(self) -> str:
        """The latest stamp that all upstream tables of this run have: a half-finished run is not mixed in."""
        if self._stamp is None:
            wanted = sorted({u for n in self._targets for u in self.specs[n].upstream} - set(self._targets))
            sets = [set(self.ctx.store.stamps(self.specs[u].layer, u)) for u in wanted]
            common = set.intersection(*sets) if sets else set()
            if not common:
                raise SnapshotNotFound(f"no common snapshot of {', '.join(wanted)}")
            self._stamp = max(common)
        return self._stamp

    def aim(self, *names: str) -> None:
        """Say beforehand which tables this run is for, so that all of them read upstream tables of one stamp."""
        self._targets = (*self._targets, *names)

    def run(self, name: str, _path: tuple[str, ...] = ()) -> DataFrame:
        if name in self.built:
            return self.built[name]
        if name in self.failed:
            raise ValueError(f"{name} has failed: {self.failed[name]}")
        if name in _path:
            raise ValueError(f"dependency cycle: {' -> '.join((*_path, name))}")
        spec = self.specs[name]
        if not _path and name not in self._targets:
            self._targets = (*self._targets, name)
        if (out := self._published(name)) is not None:
            self.resumed.append(name)
            self.built[name] = out
            return out
        inputs = {}
        for up in spec.upstream:
            inputs[up] = self.run(up, (*_path, name)) if self.ctx.run_upstream else self.read(up)
        log.info("building %s.%s", spec.layer, spec.name)
        df = spec.build(self.ctx, inputs)
        if self.ctx.load_data:
            out = self._store(spec, df)
        else:
            out = df
            if self.ctx.validate:
                self.check(name, df)
            if self.ctx.cache_shared and self._consumers.get(name, 0) > 1:
                out = out.persist(StorageLevel.MEMORY_AND_DISK)
        self.built[name] = out
        return out

    def _store(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        """Write, check, publish.  The checks read the written files, so the table is built once; a table that fails is deleted unseen."""
        t0 = time.perf_counter()
        store, sc = self.ctx.store, self.ctx.spark.sparkContext
        sc.setJobDescription(f"write {spec.layer}.{spec.name} @ {self.ctx.run_ts}")
        try:
            record = store.stage(df, spec.layer, spec.name, self.ctx.run_ts, spec.data_format, run=self.run_id)
            out = store.staged(record)
            try:
                if spec.layer == "bronze" and hasattr(self.ctx.source, "settle"):
                    self.ctx.source.settle(spec.name)
                if self.ctx.validate:
                    sc.setJobDescription(f"check {spec.layer}.{spec.name} @ {self.ctx.run_ts}")
                    self.check(spec.name, out)
            except ValueError:  # rejected lines, failed checks
                store.discard(record)
                raise
            store.publish(record)
        finally:
            sc.setJobDescription(None)
        self.rows_written[spec.name] = record.rows
        log.info("wrote %s.%s: %d rows in %.2fs", spec.layer, spec.name, record.rows, time.perf_counter() - t0)
        return out

    def run_all(self, names: Iterable[str] | None = None, keep_going: bool = False) -> dict[str, DataFrame]:
        """Build the tables.  With ``keep_going`` a table that fails is logged, and ``failed`` has it and what needs it; the others are built."""
        names = list(names or self.specs)
        self.aim(*names)
        for n in names:
            try:
                self.run(n)
            except (PySparkException, OSError, ValueError) as e:
                if not keep_going:
                    raise
                self.failed[n] = str(e).splitlines()[0]
                log.warning("%s failed: %s", n, self.failed[n])
        return dict(self.built)

    def key_report(self) -> DataFrame:
        """Key summary over every table built in this run."""
        return key_report({n: (df, self.specs[n].keys) for n, df in self.built.items()})

    def rule_report(self) -> DataFrame:
        """Column-rule summary over every table built in this run that declares rules."""
        return rule_report({n: (df, self.specs[n].rules) for n, df in self.built.items()})


def run_pipeline(ctx: RunContext, finance_export: str | None = None,
                 marketing_export: str | None = None) -> dict[str, DataFrame]:
    """Finance mart and dashboard, then marketing mart and dashboard.

    All 14 tables are built once (the wide table included) and both
    dashboards are exported and registered as views.  From snapshots
    (``run_upstream=False``) only the marts and dashboards are built, on
    upstream tables of one common stamp.
    """
    runner = Runner(ctx)
    runner.aim("finance_metrics", "marketing_metrics")
    out = {}
    out["finance_metrics"] = runner.run("finance_metrics")
    out[D.FINANCE_VIEW] = D.publish(out["finance_metrics"], D.FINANCE_LABELS, D.FINANCE_VIEW, finance_export)
    out["marketing_metrics"] = runner.run("marketing_metrics")
    out[D.MARKETING_VIEW] = D.publish(out["marketing_metrics"], D.MARKETING_LABELS, D.MARKETING_VIEW,
                                      marketing_export)
    if ctx.run_upstream:
        runner.run_all()
    out.update(runner.built)
    return out
