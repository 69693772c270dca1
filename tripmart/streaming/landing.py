"""Landing-folder ingestion as a Structured Streaming query.

The monthly batch is the reference's incremental unit; here a file stream over
the landing root discovers newly landed files (``Trigger.AvailableNow``: all
that is there, then stop — schedulable like a batch job) and ``foreachBatch``
hands the affected MONTHS to the same stages as the batch runner in
``replace`` mode. Each micro-batch therefore re-derives whole months from the
landing folder with dynamic partition overwrite: a replayed micro-batch after
a failure, or a month whose files arrive over several batches, converges to
the same tables (exactly-once results from idempotent writes). The stream's
own rows are only used for the list of months, bounded by the calendar.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import Settings, Tables
from tripmart.plans.monthly import MonthRunner
from tripmart.schemas import TRIP_SOURCE
from tripmart.session import shared_dir
from tripmart.sources import sinks


def landing_stream(spark: SparkSession, raw_base: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of ``{raw_base}/raw/month=yyyy-MM/*.parquet`` with the declared schema."""
    schema = T.StructType(TRIP_SOURCE.fields + [T.StructField("month", T.StringType())])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{raw_base}/raw")


def default_checkpoint(spark: SparkSession, raw_base: str, tables: Tables) -> str:
    """A folder of its own for each pair of landing folder and tables, the same in every process."""
    pair = f"{raw_base.rstrip('/')}\n{tables.path('bronze')}"
    return f"{shared_dir(spark).rstrip('/')}/tripmart-streams/{hashlib.sha256(pair.encode()).hexdigest()[:32]}"


def run_landing_stream(spark: SparkSession, raw_base: str, tables: Tables, lookup_csv: str | None = None,
                       settings: Settings | None = None, checkpoint: str | None = None,
                       max_files_per_trigger: int | None = None) -> int:
    """Process everything newly landed, then stop. Returns the number of micro-batches run."""
    settings = settings or Settings(load_mode="replace")
    ckpt = checkpoint or default_checkpoint(spark, raw_base, tables)
    batches = []

    def on_batch(df: DataFrame, batch_id: int) -> None:
        months = sorted(r[0] for r in df.select("month").distinct().collect())
        if not months:
            return
        runner = MonthRunner(df.sparkSession, tables, raw_base, settings, lookup_csv=lookup_csv)
        report = runner.run(months)
        # one partition per micro-batch: a replayed batch replaces its rows
        sinks.write_months(report.withColumn("batch_id", F.lit(batch_id).cast("long")), tables.path("dq_reports"),
                           tables.fmt, part_col="batch_id")
        batches.append(batch_id)

    q = (
        landing_stream(spark, raw_base, max_files_per_trigger)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return len(batches)
