"""All-or-nothing month runs on named tables: write beside, check, switch.

``MonthRunner`` replaces one table after another, so a crash between two stages leaves a month new in
one table and old in the next. ``SwitchedRunner`` writes each run's rows beside the old ones, as
partitions (``_batch``, ``_source_month``) of tables named ``<table>_all``. What readers see are catalog views: every
table's view takes the rows whose month and batch stand in one small view, ``live_batches``. After all
stages and the checks, a single ``CREATE OR REPLACE VIEW live_batches`` switches the run's months in all
tables and marts at once; before it, every reader sees the old state whole, after it the new one.

A run that crashes, or whose checks fail (``must_pass``), leaves partitions that nothing refers to; the next run
uses another batch, and ``vacuum`` drops what is not live. Dimensions stay plain tables: they only grow by
appended members, which no old row refers to. Old rows of a month that the batch empties disappear with the switch.
The batches of the live months are part of the view's text, so their number is the number of months.

The catalog must outlive the session (a metastore) for views to be seen by others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import quality
from tripmart.plans.monthly import MonthRunner
from tripmart.sources import sinks

MONTH_TABLES = ("bronze", "silver", "fact", "gold_partials")
MARTS = ("gold_daily", "gold_location", "gold_shared")
#: month tables that not every run has: sketches if they are kept, the quarantine once a text landing had broken rows
SIDE_TABLES = ("month_sketches", "quarantine")
BATCHED = (*MONTH_TABLES, *MARTS, *SIDE_TABLES)
LIVE = "live_batches"


class ChecksFailed(RuntimeError):
    """The staged months did not pass; nothing was switched."""


class SwitchedRunner(MonthRunner):
    """A ``MonthRunner`` whose runs appear in all tables at once or not at all."""

    def __init__(self, *args, must_pass: tuple[str, ...] = ("N2",), **kwargs):
        super().__init__(*args, **kwargs)
        if not self.t.database:
            raise ValueError("switching needs named tables: Tables(database=...)")
        self.must_pass = must_pass
        self.batch: str | None = None
        self.staged: dict[str, set[str]] = {}
        self.pending: list[tuple] = []
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.t.database}")

    # -- what is live -----------------------------------------------------------
    def _live_view(self) -> str:
        return f"{self.t.database}.{LIVE}"

    def live(self) -> dict[tuple[str, str], str]:
        """(table, month) -> batch of everything that readers see; marts have the month ``*``."""
        if not self.spark.catalog.tableExists(self._live_view()):
            return {}
        return {(r["table_name"], r["month"]): r["batch"] for r in self.spark.table(self._live_view()).collect()}

    def _all(self, name: str) -> str:
        return f"{self.t.path(name)}_all"

    def _rows(self, name: str, batches: dict[str, str]) -> DataFrame:
        """Rows of the months in their batches: literal conditions on partition columns, so other batches are not read."""
        by_batch: dict[str, list[str]] = {}
        for month, batch in batches.items():
            by_batch.setdefault(batch, []).append(month)
        keep = F.lit(False)
        for batch, months in sorted(by_batch.items()):
            keep = keep | ((F.col("_batch") == batch) & F.col("_source_month").isin(sorted(months)))
        rows = self.spark.table(self._all(name)).where(keep)
        return rows.drop("_batch", "_source_month") if name in MARTS else rows.drop("_batch")

    # -- MonthRunner's table access: this run's months from its batch, the others from the live ones --
    def _batches(self, name: str) -> dict[str, str]:
        out = {m: b for (t, m), b in self.live().items() if t == name}
        return out | {m: self.batch for m in self.staged.get(name, ())}

    def _read(self, name: str) -> DataFrame:
        return self._rows(name, self._batches(name)) if name in BATCHED else super()._read(name)

    def _exists(self, name: str) -> bool:
        if name in BATCHED:
            return self.spark.catalog.tableExists(self._all(name)) and bool(self._batches(name))
        return super()._exists(name)

    def _done(self, name: str) -> set[str] | None:
        done = super()._done(name)
        if name not in (*MONTH_TABLES, *SIDE_TABLES):
            return done
        return {m for t, m in self.live() if t == name} & (done or set())  # what the ledger knows but was never switched is built again

    def _loaded(self, name, months, df, cluster=False, landed=None, unresolved=None, before_commit=None):
        df = df.withColumn("_batch", F.lit(self.batch))
        target = self._all(name)
        # within the batch's partition, a retried stage replaces its months
        counts = sinks.write_months(df, target, self.t.fmt, cluster=cluster, months=months, unresolved=unresolved, outer="_batch", added=self.added)
        self.staged.setdefault(name, set()).update(months)
        if before_commit:
            before_commit()
        self._record(name, {m: n for m, (n, _) in counts.items()}, landed, {m: u for m, (_, u) in counts.items()} if unresolved else None)

    def _set_aside(self, months, rows):
        if rows is not None:
            sinks.write_months(rows.withColumn("_batch", F.lit(self.batch)), self._all("quarantine"), self.t.fmt, outer="_batch")
        if self.spark.catalog.tableExists(self._all("quarantine")):  # a batch without rows hides those of an older one
            self.staged.setdefault("quarantine", set()).update(months)

    def _record(self, name, rows, landed=None, unresolved=None):
        """Months enter the ledger after the switch, in the order of the stages."""
        self.pending.append((name, rows, landed, unresolved))

    def _todo(self, name, months):
        """A month that this run has rebuilt at an earlier stage is rebuilt here."""
        before = self.staged.get({"silver": "bronze", "month_sketches": "silver", "fact": "silver", "gold_partials": "fact"}.get(name, ""), set())
        return sorted({*super()._todo(name, [m for m in months if m not in before]), *(before & set(months))})

    def total_rows(self, name: str) -> int:
        own = {m: n for stage, rows, *_ in self.pending if stage == name for m, n in rows.items()}
        entries = self._entries().get(name, {})
        return sum(own.get(m, entries[m].rows if m in entries else 0) for m in self._batches(name))

    def publish(self) -> dict[str, int]:
        rows = {}
        for name, mart in zip(MARTS, self._published()):
            df = mart.withColumns({"_batch": F.lit(self.batch), "_source_month": F.lit("*")})
            rows[name] = sinks.write_months(df, self._all(name), self.t.fmt, cluster=True, months=["*"], outer="_batch")["*"][0]
            self.staged[name] = {"*"}
        return rows

    # -- the run ----------------------------------------------------------------
    def run(self, months: list[str]) -> DataFrame:
        """All stages beside the live state, the checks, then the switch; returns the quality report."""
        self.batch, self.staged, self.pending = uuid.uuid4().hex[:12], {}, []
        report = super().run(months).checkpoint(eager=True)  # bounded: twelve rows a month
        failed = report.where(F.col("check_id").isin(*self.must_pass) & (F.col("status") == quality.FAIL)).select("source_month", "check_id").collect()
        if failed:
            raise ChecksFailed(f"not switched: {sorted((r['source_month'], r['check_id']) for r in failed)}")
        self.switch()
        return report

    def switch(self) -> None:
        """Makes the staged months and marts live: views for tables that have none yet show nothing until the one replaced view does."""
        live = self.live() | {(t, m): self.batch for t, months in self.staged.items() for m in months}
        if not self.spark.catalog.tableExists(self._live_view()):
            self._replace_live({})
        for name in self.staged:
            hidden = ("_batch", "_source_month") if name in MARTS else ("_batch",)
            shown = [c for c in self.spark.table(self._all(name)).columns if c not in hidden]
            if not self.spark.catalog.tableExists(self.t.path(name)) or self.spark.table(self.t.path(name)).columns != shown:
                columns = ", ".join(f"t.`{c}`" for c in shown)
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {self.t.path(name)} AS SELECT {columns} FROM {self._all(name)} t LEFT SEMI JOIN {self._live_view()} l "
                    f"ON l.table_name = '{name}' AND l.month = t._source_month AND l.batch = t._batch"
                )
        self._replace_live(live)  # the switch
        recorded, self.staged = self.pending, {}
        for entry in recorded:
            super()._record(*entry)
        self.pending = []

    def _replace_live(self, live: dict[tuple[str, str], str]) -> None:
        rows = ", ".join(f"('{t}', '{m}', '{b}')" for (t, m), b in sorted(live.items())) or "('', '', '')"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._live_view()} AS SELECT * FROM VALUES {rows} AS live(table_name, month, batch)")

    def vacuum(self) -> int:
        """Drops partitions of batches that are not live (of crashed, refused or replaced runs); returns how many."""
        live, gone = set(self.live().items()), 0
        for name in BATCHED:
            if not self.spark.catalog.tableExists(self._all(name)):
                continue
            for r in self.spark.sql(f"SHOW PARTITIONS {self._all(name)}").collect():
                part = dict(x.split("=", 1) for x in r[0].replace("%2A", "*").split("/"))
                if ((name, part["_source_month"]), part["_batch"]) not in live:
                    self.spark.sql(f"ALTER TABLE {self._all(name)} DROP IF EXISTS PARTITION (_batch='{part['_batch']}', _source_month='{part['_source_month']}')")
                    gone += 1
        return gone
