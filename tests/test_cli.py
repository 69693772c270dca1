"""spark-submit entry point: runs landed months and prints the report."""

from tripmart import cli
from tripmart.session import scratch_root
from tripmart.sources.fixture import land_months, location_lookup

from .conftest import SF_SMALL


def test_cli_runs_two_months(spark, capsys):
    raw = scratch_root(spark, "cli_raw")
    land_months(spark, SF_SMALL, raw)
    lookup = f"{raw}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    cli.main(["--raw", raw, "--root", scratch_root(spark, "cli_lake"), "--lookup", lookup,
              "--months", "1995-01", "1995-02"])
    out = capsys.readouterr().out
    assert "Silver row count" in out and "1995-02" in out and "Data quality result" in out
