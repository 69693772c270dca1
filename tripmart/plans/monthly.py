"""Month runs: Bronze -> Silver -> dimensions -> fact -> mart partials -> checks (O1-O3).

Unlike the reference (one month per call, 29 sequential actions), a run takes a
LIST of months and processes all of them in one pass per stage: the number of
jobs does not depend on the number of months. Every stage replaces exactly its
months (dynamic partition overwrite; a month that brings no rows loses its old
ones), so re-running is idempotent, and ``load_mode="skip"`` reproduces the
reference's "month exists -> skip" guards: a month is skipped only if it has
rows, its landing files are those that were loaded (X16), and the stage before has
not rebuilt it since. Dimensions only ever grow by appended deltas; existing keys never
change. Months whose fact rows lack keys that a grown dimension now has are rebuilt (X12).

Rows are counted while they are written and kept in the ledger per month, together with the
fingerprint of the landing files and the number of unresolved keys; whole-table control totals are sums of these
(N10, N11), so a run reads nothing of the months that it does not load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.config import Settings, Tables
from tripmart.operators import dims, identity, marts, quality, sketches
from tripmart.operators.fact import build_fact, trip_key
from tripmart.operators.silver import to_silver
from tripmart.session import shared_dir
from tripmart.sources import quarantine, readers, sinks

PARTIAL_GRAIN = marts.PARTIAL_GRAIN
#: the stage that a stage reads
SOURCE = {"silver": "bronze", "month_sketches": "silver", "dimensions": "silver", "fact": "silver", "gold_partials": "fact"}
DIMENSIONS = ("dim_location", "dim_provider", "dim_date", "dim_dispatch")


def _bronze_columns(source: T.StructType) -> list[Column]:
    """Bronze of a landing scan that has ``month`` and ``_source_file``."""
    return [*[F.col(f.name).cast(f.dataType) for f in source.fields], F.col("month").alias("_source_month"),
            F.col("_source_file"), F.current_timestamp().alias("_ingested_at")]


@dataclass(frozen=True)
class Entry:
    """The latest ledger row of a stage and month."""

    status: str
    rows: int
    finished_at: dt.datetime
    fingerprint: str | None
    unresolved: int | None


@dataclass(frozen=True)
class StageResult:
    month: str
    stage: str
    status: str  # loaded | empty | skipped | updated | unchanged
    rows: int


class MonthRunner:
    def __init__(self, spark: SparkSession, tables: Tables, raw_base: str, settings: Settings = Settings(),
                 lookup_csv: str | None = None):
        self.spark, self.t, self.raw, self.s = spark, tables, raw_base, settings
        shared_dir(spark)
        self.lookup_csv = lookup_csv
        changes = settings.schema_changes
        self.source, self.added, self.wide = schemas.evolve(schemas.TRIP_SOURCE, changes), schemas.added(changes), schemas.widened(changes)
        self.results: list[StageResult] = []
        self._ledger: dict[str, dict[str, Entry]] | None = None
        self._schemas: dict[str, T.StructType] = {}

    # -- helpers --------------------------------------------------------------
    def _read(self, name: str) -> DataFrame:
        """A table; its schema is looked up once per runner, not once per read."""
        path = self.t.path(name)
        if not readers.is_path(path) or self.t.fmt == "delta":
            return readers.read_table(self.spark, path, self.t.fmt)
        if name not in self._schemas:
            self._schemas[name] = self._carried(name, readers.read_table(self.spark, path, self.t.fmt).schema)
        return self.spark.read.format(self.t.fmt).schema(self._schemas[name]).load(path)

    def _carried(self, name: str, schema: T.StructType) -> T.StructType:
        """Month tables are read with the declared schema changes, whichever file the schema comes from. Copied keys are
        as wide as the ids they copy, in the fact and in the partials that group by them."""
        if name not in ("bronze", "silver", "fact", "gold_partials"):
            return schema
        keys = {"PULocationID": "pickup_location_key", "DOLocationID": "dropoff_location_key"} if self.s.fact_key_mode == "copy" else {}
        wide = self.wide if name in ("bronze", "silver") else {keys[c]: t for c, t in self.wide.items() if c in keys}
        return schemas.carried(schema, {} if name == "gold_partials" else self.added, wide)

    def _exists(self, name: str) -> bool:
        if name in self._schemas:
            return True
        path = self.t.path(name)
        if not readers.is_path(path) or self.t.fmt == "delta":
            return readers.table_exists(self.spark, path, self.t.fmt)
        if not readers.folder_exists(self.spark, path):
            return False
        try:
            self._read(name)
            return True
        except AnalysisException as e:
            if e.getCondition() in readers.ABSENT:
                return False
            raise

    def _entries(self) -> dict[str, dict[str, Entry]]:
        """The latest entry of every stage and month, from the run ledger (one small read per runner)."""
        if self._ledger is None:
            self._ledger = {}
            if readers.table_exists(self.spark, self.t.path("runs"), self.t.fmt):
                runs = self.spark.read.format(self.t.fmt).schema(sinks.LEDGER).load(self.t.path("runs")) if readers.is_path(self.t.path("runs")) and self.t.fmt != "delta" else self._read("runs")
                have = [c.split()[0] for c in sinks.LEDGER.split(", ")][2:]
                row = F.struct("finished_at", *[c if c in runs.columns else F.lit(None).alias(c) for c in have if c != "finished_at"])
                for r in runs.groupBy("stage", "month").agg(F.max(row).alias("e")).collect():
                    e = r["e"]
                    self._ledger.setdefault(r["stage"], {})[r["month"]] = Entry(e["status"], e["rows"], e["finished_at"], e["fingerprint"], e["unresolved"])
        return self._ledger

    def _done(self, name: str) -> set[str] | None:
        """Months with rows that the stage has committed since the stage before it did; None: the ledger does not know the stage."""
        entries = self._entries().get(name)
        if entries is None:
            return None
        before = self._entries().get(SOURCE.get(name, ""), {})
        fresh = lambda m, e: m not in before or before[m].finished_at <= e.finished_at
        return {m for m, e in entries.items() if e.status == "loaded" and fresh(m, e)}

    def _todo(self, name: str, months: list[str]) -> list[str]:
        """Months still to (re)build for a stage.

        ``replace``: all of them. ``skip`` (the reference's guard): months the ledger
        records as committed with rows are skipped. A month whose write failed half-way,
        that had no rows, or that the stage before has rebuilt since, is not among them and is
        built (the write replaces the partition whole). A stage that the ledger does not know (a table
        written by other tools) is probed for months with rows.
        """
        if self.s.load_mode == "replace":
            return list(months)
        done = self._done(name)
        if done is None:
            done = sinks.months_present(self.spark, self.t.path(name), months, self.t.fmt)
        for m in sorted(done & set(months)):
            self.results.append(StageResult(m, name, "skipped", 0))
        return [m for m in months if m not in done]

    def _loaded(self, name: str, months: list[str], df: DataFrame, cluster: bool = False, landed: dict[str, str] | None = None,
                unresolved: str | None = None, before_commit: Callable[[], None] | None = None) -> None:
        """Writes a stage's months and records each with its own row count; months without rows are emptied.
        ``before_commit`` runs between the write and the record."""
        path = self.t.path(name)
        new = readers.is_path(path) and name not in self._schemas and not readers.folder_exists(self.spark, path)
        # Bronze/Silver/fact read month-partitioned inputs: already clustered, no extra shuffle.
        counts = sinks.write_months(df, self.t.path(name), self.t.fmt, cluster=cluster, months=months, unresolved=unresolved, added=self.added)
        gone = {m for m, (n, _) in counts.items() if not n}
        if new and len(gone) < len(counts):  # the schema of a table just made is known
            own = [f for f in df.schema.fields if f.name not in (unresolved, "_source_month")]
            self._schemas[name] = T.StructType([*own, T.StructField("_source_month", T.StringType())])
        if gone and self._exists(name):  # without any rows there may be no table yet
            sinks.drop_months(self.spark, self.t.path(name), gone)
        if before_commit:
            before_commit()
        self._record(name, {m: n for m, (n, _) in counts.items()}, landed, {m: u for m, (_, u) in counts.items()} if unresolved else None)

    def _record(self, name: str, rows: dict[str, int], landed: dict[str, str] | None = None, unresolved: dict[str, int] | None = None) -> None:
        """Committed: every month goes into the ledger right away."""
        done = [(m, name, "loaded" if n else "empty", n, (landed or {}).get(m), (unresolved or {}).get(m)) for m, n in sorted(rows.items())]
        self._entries()
        now = sinks.ledger_append(self.spark, self.t.path("runs"), done, self.t.fmt)
        for m, _, status, n, fp, un in done:
            self._ledger.setdefault(name, {})[m] = Entry(status, n, now, fp, un)
            self.results.append(StageResult(m, name, status, n))

    def _grown(self, name: str, label: str, n: int, first: bool = False) -> StageResult:
        """A dimension's growth: the ledger keeps when it last grew."""
        if n:
            self._entries()
            now = sinks.ledger_append(self.spark, self.t.path("runs"), [("*", name, "grown", n, None, None)], self.t.fmt)
            self._ledger.setdefault(name, {})["*"] = Entry("grown", n, now, None, None)
        return StageResult(label, name, "loaded" if first else "updated" if n else "unchanged", n)

    def compact_ledger(self) -> int:
        """Rewrite the append-only ledger as one file; returns its rows.

        A reliable checkpoint (shared folder) snapshots the rows first, so the
        overwrite no longer reads the path it replaces. Should the rewrite fail,
        skip mode falls back to probing the tables' data, which stays correct.
        """
        path = self.t.path("runs")
        if not readers.table_exists(self.spark, path, self.t.fmt):
            return 0
        shared_dir(self.spark)
        snap = self._read("runs").checkpoint(eager=True)
        n = sinks.rebuild(snap.coalesce(1), path, self.t.fmt)  # stage x month rows: tiny
        self._ledger = None
        return n

    def changed_landings(self, months: list[str]) -> list[str]:
        """Loaded months whose landing files are no longer those that were loaded (re-issued, added or removed).

        Only months whose fingerprint the ledger has are compared; a landing folder that is gone altogether does not
        take the loaded month away.
        """
        loaded = {m: e.fingerprint for m, e in self._entries().get("bronze", {}).items() if m in set(months) and e.status == "loaded" and e.fingerprint}
        now = readers.fingerprints(self.spark, self.raw, list(loaded)) if loaded and self.raw else {}
        return sorted(m for m, digest in now.items() if digest != loaded[m])

    # -- stages ---------------------------------------------------------------
    def bronze(self, months: list[str]) -> list[str]:
        todo = self._todo("bronze", months)
        reissued = set(self.changed_landings(months)) - set(todo)
        if reissued:
            todo = [m for m in months if m in reissued or m in todo]
            self.results = [r for r in self.results if not (r.stage == "bronze" and r.status == "skipped" and r.month in reissued)]
        if not todo:
            return todo
        if self.s.landing_format == "csv":
            self._bronze_from_text(todo)
            return todo
        self._check_drift(todo)
        seen = readers.fingerprints(self.spark, self.raw, todo)  # before the read: what lands meanwhile counts as a change next time
        raw = readers.read_months(self.spark, self.raw, todo, schema=self.source)
        b = raw.withColumn("_source_file", F.col("_metadata.file_path")).select(*_bronze_columns(self.source))
        self._loaded("bronze", todo, b, landed=seen)
        return todo

    def _versions(self, months: list[str]) -> list[tuple[T.StructType, list[str]]]:
        """The months by the schema that is declared for them: as many groups as changes begin among them, and one."""
        begun = sorted({c.since for c in self.s.schema_changes})
        groups: dict[int, list[str]] = {}
        for m in sorted(set(months)):
            groups.setdefault(sum(since <= m for since in begun), []).append(m)
        return [(schemas.evolve(schemas.TRIP_SOURCE, self.s.schema_changes, some[0]), some) for some in groups.values()]

    def _check_drift(self, months: list[str]) -> None:
        # Names AND types of every landed file (merged footers), before any data is read
        for declared, some in self._versions(months):
            self._check_version(declared, some)

    def _check_version(self, declared: T.StructType, months: list[str]) -> None:
        try:
            landed = readers.read_months(self.spark, self.raw, months, schema=None, merge_schema=True).schema
        except readers.MonthsNotLandedError:
            raise
        except Exception as e:  # noqa: BLE001 - files of the batch disagree on a column's type
            if "CANNOT_MERGE" not in str(e):
                raise
            raise schemas.SchemaDriftError([("*", "conflict", None, str(e).split("JVM stacktrace")[0].strip())]) from e
        diffs = schemas.drift(declared, T.StructType([f for f in landed.fields if f.name != "month"]))
        if diffs:
            raise schemas.SchemaDriftError(diffs)

    def _bronze_from_text(self, months: list[str]) -> None:
        """Months that land as CSV: rows that fit go to Bronze, the others with line and reasons to the quarantine.

        The broken rows are counted while Bronze is written; the files are scanned again only if there are any. A
        month is committed once both tables hold it, so a run that dies in between does both again.
        """
        seen = readers.fingerprints(self.spark, self.raw, months)
        absent = sorted(set(months) - seen.keys())
        if absent:
            raise readers.MonthsNotLandedError(f"no landing folder for {absent}")
        screened = []  # one scan per declared schema
        for declared, some in self._versions(months):
            rows = quarantine.read_months_kept(self.spark, self.raw, some, declared, self.s.landing_header)
            required = tuple(c for c in self.s.required_columns if c in declared.names)
            screened.append((quarantine.screened(rows.withColumn("_source_file", F.col("_metadata.file_path")), declared, required), declared))
        counted = Observation("rows_broken")
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows for rows, _ in screened])
        kept = quarantine.good(whole.observe(counted, F.count_if(F.size(quarantine.REASONS) > 0).alias("broken")))

        def set_aside() -> None:
            aside = [quarantine.broken(rows, declared).select(*quarantine.QUARANTINE_COLUMNS) for rows, declared in screened]
            self._set_aside(months, reduce(DataFrame.unionByName, aside) if counted.get["broken"] else None)

        self._loaded("bronze", months, kept.select(*_bronze_columns(self.source)), landed=seen, before_commit=set_aside)

    def _set_aside(self, months: list[str], rows: DataFrame | None) -> None:
        """Replaces the months' quarantined rows; None: there are none."""
        path = self.t.path("quarantine")
        found = sinks.write_months(rows, path, self.t.fmt, months=months) if rows is not None else {}
        gone = {m for m in months if not found.get(m, (0, 0))[0]}
        sinks.drop_months(self.spark, path, gone & set(sinks.month_folders(self.spark, path)))

    def silver(self, months: list[str]) -> list[str]:
        todo = self._todo("silver", months)
        if todo:
            b = self._read("bronze").where(F.col("_source_month").isin(todo))
            self._loaded("silver", todo, to_silver(b, tuple(self.added)))
        return todo

    def month_sketches(self, months: list[str]) -> list[str]:
        """Quantile sketches of the months that are new or were rebuilt; the others keep theirs."""
        todo = self._todo("month_sketches", months)
        if todo:
            silver = self._read("silver").where(F.col("_source_month").isin(todo))
            self._loaded("month_sketches", todo, sketches.month_sketches(silver), cluster=True)
        return todo

    def quantiles(self, probs: list[float], months: list[str] | None = None) -> DataFrame:
        """Quantiles over all sketched months (or some) from their sketches: no trip is read."""
        held = self._read("month_sketches")
        return sketches.quantiles(sketches.merged(held.where(F.col("_source_month").isin(list(months))) if months else held), probs)

    def repeated_trips(self, months: list[str]) -> DataFrame:
        """When N3 finds repeated keys, which of them are duplicates and which collisions."""
        silver = self._read("silver").where(F.col("_source_month").isin(list(months))).select(*schemas.TRIP_KEY_COLUMNS)
        return identity.report(silver.withColumn("trip_key", trip_key(self.wide)))

    def dimensions(self, months: list[str]) -> None:
        """Every dimension grows by an appended delta; existing keys never change.

        One scan of the months that the dimensions have not taken in yet gives the members of all of them.
        """
        todo = months
        if self.s.load_mode == "skip" and all(self._exists(d) for d in ("dim_dispatch", "dim_provider", "dim_date")):
            taken = self._done("dimensions") or set()
            todo = [m for m in months if m not in taken]
        label = ",".join(sorted(todo))
        silver = self._read("silver").where(F.col("_source_month").isin(todo))
        members = dims.member_values(silver).checkpoint(eager=True)  # bounded by the dimensions
        bases, codes, dates = (dims.as_trips(members, k) for k in ("base", "provider", "date"))

        def dispatch() -> StageResult:
            if self._exists("dim_dispatch"):  # append only new members
                n = sinks.append(dims.dispatch_delta(bases, self._read("dim_dispatch"), self.s.dispatch_key_mode),
                                 self.t.path("dim_dispatch"), self.t.fmt)
                return self._grown("dim_dispatch", label, n)
            n = sinks.rebuild(dims.dim_dispatch(bases, self.s.dispatch_key_mode), self.t.path("dim_dispatch"),
                              self.t.fmt)
            return self._grown("dim_dispatch", label, n, first=True)

        def provider() -> StageResult:
            if self._exists("dim_provider"):
                n = sinks.append(dims.new_providers(codes, self._read("dim_provider"), self.s.provider_names),
                                 self.t.path("dim_provider"), self.t.fmt)
                return self._grown("dim_provider", label, n)
            n = sinks.rebuild(dims.dim_provider(codes, self.s.provider_names), self.t.path("dim_provider"), self.t.fmt)
            return self._grown("dim_provider", label, n, first=True)

        def calendar() -> StageResult:
            if self._exists("dim_date"):  # gap-free extension over existing and new dates
                n = sinks.append(dims.dim_date_extension(dates, self._read("dim_date")), self.t.path("dim_date"),
                                 self.t.fmt)
                return self._grown("dim_date", label, n)
            n = sinks.rebuild(dims.dim_date_for(dates), self.t.path("dim_date"), self.t.fmt)
            return self._grown("dim_date", label, n, first=True)

        def location() -> StageResult | None:
            if not self.lookup_csv:
                return None
            if self._exists("dim_location"):  # zones that a new lookup file brings are appended
                held = self._entries().get("zone_lookup", {}).get("*")
                if held is not None and held.fingerprint == readers.fingerprint(self.spark, self.lookup_csv):
                    return None
                zones = dims.dim_location(readers.read_lookup_csv(self.spark, self.lookup_csv))
                n = sinks.append(dims.new_locations(zones, self._read("dim_location")), self.t.path("dim_location"), self.t.fmt)
                taken_in()
                return self._grown("dim_location", "*", n)
            n = sinks.rebuild(dims.dim_location(readers.read_lookup_csv(self.spark, self.lookup_csv)), self.t.path("dim_location"), self.t.fmt)
            taken_in()
            return self._grown("dim_location", "*", n, first=True)

        def taken_in() -> None:
            digest = readers.fingerprint(self.spark, self.lookup_csv)
            now = sinks.ledger_append(self.spark, self.t.path("runs"), [("*", "zone_lookup", "taken", 0, digest, None)], self.t.fmt)
            self._entries().setdefault("zone_lookup", {})["*"] = Entry("taken", 0, now, digest, None)

        for step in (location, *((dispatch, provider, calendar) if todo else ())):
            res = step()
            if res is not None:
                self.results.append(res)
        if todo:
            rows = self._entries().get("silver", {})
            known = {m: rows[m].rows for m in todo if m in rows}
            rest = [m for m in todo if m not in known]
            self._record("dimensions", known | (sinks.month_rows(silver, rest) if rest else {}))

    def fact(self, months: list[str], late: list[str] = ()) -> list[str]:
        """The fact's months still to build, and ``late`` ones in any case."""
        todo = self._todo("fact", [m for m in months if m not in set(late)])
        todo = sorted({*todo, *late})
        if todo:
            silver = self._read("silver").where(F.col("_source_month").isin(todo))
            given = (None, None, None) if self.s.fact_key_mode == "copy" else (self._read("dim_provider"), self._read("dim_location"), self._read("dim_dispatch"))
            f = build_fact(silver, *given, self.s, unresolved="__unresolved")
            self._loaded("fact", todo, f, unresolved="__unresolved")
        return todo

    def late_months(self) -> list[str]:
        """Months of the fact with unresolved keys that members which came later resolve.

        Only months that the ledger has unresolved keys of, built before a dimension last grew, are looked
        at: of these, keys that resolve now are compared with keys that the fact holds. Usually none, and no job runs.
        """
        grown = [e["*"].finished_at for d, e in self._entries().items() if d in DIMENSIONS and "*" in e]
        if not grown or self.s.fact_key_mode == "copy":
            return []
        some = sorted(m for m, e in self._entries().get("fact", {}).items() if e.status == "loaded" and e.unresolved and e.finished_at < max(grown))
        if not some:
            return []
        silver = self._read("silver").where(F.col("_source_month").isin(some))
        left = "__unresolved"
        now = build_fact(silver, self._read("dim_provider"), self._read("dim_location"), self._read("dim_dispatch"), self.s, columns=["_source_month"], unresolved=left)
        still = {r[0]: int(r[1]) for r in now.groupBy("_source_month").agg(F.sum(left)).collect()}
        return [m for m in some if still.get(m, 0) < self._entries()["fact"][m].unresolved]

    def resolve_late_members(self) -> list[str]:
        """Rebuilds the fact and the mart partials of just the months that ``late_months`` finds."""
        late = self.late_months()
        if late:
            self.fact([], late)
            self.mart_partials(late)
        return late

    def mart_partials(self, months: list[str]) -> None:
        """L1/L3/L5 as ONE month-partial table (one fact scan, one write); marts roll up from it."""
        todo = self._todo("gold_partials", months)
        if todo:
            f = self._read("fact").where(F.col("_source_month").isin(todo))
            # aggregate output is hash-partitioned across months: cluster it
            self._loaded("gold_partials", todo, marts.partials(f, PARTIAL_GRAIN, self.s.duration_col), cluster=True)

    # -- published marts: roll-ups of the partials, also written as tables -----
    def publish(self) -> dict[str, int]:
        """(re)writes the three mart tables from the partials (bounded by days x providers x zones)."""
        rows = {}
        for name, mart in zip(("gold_daily", "gold_location", "gold_shared"), self._published()):
            rows[name] = sinks.rebuild(mart, self.t.path(name), self.t.fmt)
            if readers.is_path(self.t.path(name)):
                self._schemas[name] = mart.schema
            self.results.append(StageResult("*", name, "loaded", rows[name]))
        return rows

    def _published(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return marts.published(self._read("gold_partials"), self._read("dim_date"), self._read("dim_provider"),
                               self._read("dim_location"))

    def gold_daily(self) -> DataFrame:
        return self._published()[0]

    def gold_location(self) -> DataFrame:
        return self._published()[1]

    def gold_shared(self) -> DataFrame:
        return self._published()[2]

    def checks(self, months: list[str]) -> DataFrame:
        silver = self._read("silver").where(F.col("_source_month").isin(list(months)))
        fact = self._read("fact").where(F.col("_source_month").isin(list(months)))
        written = {n: self._read(n) for n in ("gold_daily", "gold_location", "gold_shared") if self._exists(n)}
        loc_t, shared_t = quality.mart_totals(written.get("gold_location", self.gold_location()),
                                              written.get("gold_shared", self.gold_shared()))
        # N10/N11 compare with ALL fact rows, not only this batch's months.
        rows = quality.report(silver, fact, written.get("gold_daily", self.gold_daily()), loc_t, shared_t, total_fact_rows=self.total_rows("fact"),
                              months=list(months))
        return quality.with_overall(rows)

    def total_rows(self, name: str) -> int:
        """Control total of a month table: the ledger's rows per month add up; only months that it does not know are counted."""
        entries = {m: e for m, e in self._entries().get(name, {}).items() if e.status == "loaded"}
        unknown = [m for m in sinks.month_folders(self.spark, self.t.path(name)) if m not in entries]
        extra = sinks.month_rows(self._read(name), unknown) if unknown else {}
        return sum(e.rows for e in entries.values()) + sum(extra.values())

    def spill(self) -> DataFrame:
        """Which dates' trips lie in files of other months, from the stored partials."""
        return quality.spill_rows(self._read("gold_partials"), self._read("dim_date"))

    def run(self, months: list[str]) -> DataFrame:
        """O1/O2: all stages in order for a batch of months; returns the quality report."""
        months = sorted(set(months))
        self.bronze(months)
        self.silver(months)
        if self.s.keep_sketches:
            self.month_sketches(months)
        self.dimensions(months)
        late = self.late_months()
        self.fact(months, late)
        self.mart_partials(sorted({*months, *late}))
        self.publish()
        return self.checks(months)

    def results_frame(self) -> DataFrame:
        return self.spark.createDataFrame([(r.month, r.stage, r.status, r.rows) for r in self.results],
                                          "month string, stage string, status string, rows long")


def landing_months(spark: SparkSession, raw_base: str) -> list[str]:
    """Months that have a folder in the landing zone: a listing of one directory, no file is opened."""
    fs, path = readers.file_system(spark, f"{raw_base}/raw")
    names = (f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory())
    return sorted(n.removeprefix("month=") for n in names if n.startswith("month="))
