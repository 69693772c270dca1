"""Table names, thresholds, code maps and load modes.

Everything that the reference hard-codes lives here as parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Provider licence codes and names, in the reference's order; any other code
# maps to "Unknown".
PROVIDER_NAMES = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}
UNKNOWN_PROVIDER = "Unknown"
# Quality flag values and overall status labels.
ISSUE = "ISSUE"
OK = "OK"
STATUS_BOTH = "TIMESTAMP_AND_FINANCIAL_ISSUE"
STATUS_TIMESTAMP = "TIMESTAMP_ISSUE"
STATUS_FINANCIAL = "FINANCIAL_ISSUE"
STATUS_TRIP_TIME = "TRIP_TIME_ISSUE"
STATUS_GOOD = "GOOD"
# Allowed gap between reported and computed trip time, in seconds.
TRIP_TIME_TOLERANCE_S = 3
# Extreme-value thresholds of the profiling notebook.
EXTREME_MILES = 500
EXTREME_DURATION_S = 21600
# Calendar window of the reference's date dimension.
DIM_DATE_START = "2026-01-01"
DIM_DATE_END = "2026-05-31"
# Lineage columns added at ingest.
LINEAGE_COLUMNS = ("_source_month", "_source_file", "_ingested_at")
# Row cap of the reference's anomaly extracts / top lists.
EXTRACT_ROWS = 20
# Names of the data-quality checks, in check order.
CHECK_NAMES = {
    "N1": "Silver row count",
    "N2": "Silver → Fact row reconciliation",
    "N3": "Duplicate trip key check",
    "N4": "Provider key coverage",
    "N5": "Location key coverage",
    "N6": "Dispatching key coverage",
    "N7": "Timestamp quality check",
    "N8": "Financial quality check",
    "N9": "Daily Provider Gold reconciliation",
    "N10": "Location Gold reconciliation",
    "N11": "Shared Ride Gold reconciliation",
    "N12": "Data quality result",
}
# ---------------------------------------------------------------------------

# Dates outside this span come from broken timestamps: such trips are flagged and have no date key, and the
# calendar, one row per day of the data's span, cannot outgrow it.
CALENDAR_FIRST = "1900-01-01"
CALENDAR_LAST = "2099-12-31"


@dataclass(frozen=True)
class Tables:
    """Names of every persisted table: paths under ``root``, or tables of ``database`` if one is given."""

    root: str = ""
    fmt: str = "parquet"
    bronze: str = "bronze_trips"
    silver: str = "silver_trips"
    dim_dispatch: str = "dim_dispatch"
    dim_provider: str = "dim_provider"
    dim_location: str = "dim_location"
    dim_date: str = "dim_date"
    fact: str = "fact_trip"
    gold_partials: str = "gold_month_partials"
    gold_daily: str = "gold_daily_provider"
    gold_location: str = "gold_location"
    gold_shared: str = "gold_shared_ride"
    runs: str = "run_ledger"
    quarantine: str = "quarantine_trips"
    database: str | None = None

    def path(self, name: str) -> str:
        own = getattr(self, name, name)
        return f"{self.database}.{own}" if self.database else f"{self.root.rstrip('/')}/{own}"


@dataclass(frozen=True)
class SchemaChange:
    """A declared change of the landed files from month ``since`` on (always, if empty): a nullable column that is
    new, or a column of the source with a wider type."""

    column: str
    type: T.DataType
    since: str = ""


@dataclass(frozen=True)
class Settings:
    """Behaviour switches the reference fixed in code."""

    load_mode: str = "skip"  # "skip": a present month is left alone; "replace": rewrite it
    dispatch_key_mode: str = "natural"  # "natural" (base_num) or "surrogate" (int row number)
    fact_key_mode: str = "lookup"  # "lookup" (dimension joins) or "copy" (raw ids as keys)
    duration_col: str = "trip_time"  # marts: library uses trip_time, notebooks the computed time
    extreme_miles: float = EXTREME_MILES
    extreme_duration_s: int = EXTREME_DURATION_S
    wide_trip_key: bool = False  # add trip_key_ext: a second, independent 64-bit hash (128-bit identity)
    broadcast_limit_rows: int = 1_000_000  # dimension sides above this are shuffled (AQE may still broadcast)
    landing_format: str = "parquet"  # "csv": months land as text, rows that do not fit go to the quarantine table
    landing_header: bool = True  # of text landings: the first line of every file names the columns
    keep_sketches: bool = False  # month runs also keep quantile sketches per month and measure
    schema_changes: tuple[SchemaChange, ...] = ()  # additive changes that are carried from Bronze to the fact; all others are refused
    required_columns: tuple[str, ...] = ()  # of text landings: a row without one of these is quarantined
    provider_names: dict = field(default_factory=lambda: dict(PROVIDER_NAMES))
