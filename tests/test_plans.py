"""Physical-plan shape: the properties the design relies on at scale."""

import contextlib
import io

import pytest

from tripmart.operators import marts
from tripmart.plans.catalog import Inputs
from tripmart.sources import readers

from .conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_SMALL)


def test_fact_build_never_shuffles_the_fact_side(inputs):
    p = plan(inputs.fact)
    assert "SortMergeJoin" not in p
    assert p.count("BroadcastHashJoin") >= 5
    # the only exchanges are the broadcasts and the small distinct aggregates that build dimensions
    for line in p.splitlines():
        if "Exchange" in line and "Broadcast" not in line and "hashpartitioning" in line:
            assert "hvfhs_license_num" in line or "base_num" in line


def test_month_slice_is_a_partition_filter(inputs):
    p = plan(readers.month_slice(inputs.silver_by_month, "1995-01"))
    assert "PartitionFilters: [isnotnull(_source_month" in p and "1995-01" in p


def _columns(p: str) -> list[set[str]]:
    """Columns of each scan of the plan."""
    found = [line.split("struct<", 1)[1].rstrip(">") for line in p.splitlines() if line.startswith("ReadSchema: struct<")]
    return [{c.split(":")[0] for c in s.split(",") if ":" in c} - {"_tmp_metadata_row_index"} for s in found]


def test_counts_by_provider_read_and_look_up_nothing_else(inputs):
    from tripmart.operators import profile

    p = plan(profile.group_count(inputs.fact_of("provider"), ["provider_key"]))
    scans = [c for c in _columns(p) if c]
    assert {"l_orderkey", "l_suppkey"} in scans and {"o_orderkey"} in scans
    assert p.count("BroadcastHashJoin LeftOuter") + p.count("BroadcastHashJoin [LeftOuter") <= 2
    assert "PULocationID" not in p and "base_num" not in p


def test_daily_mart_reads_only_needed_columns(inputs):
    p = plan(marts.daily_provider(marts.partials(inputs.fact_of("provider"), marts.DAILY_GRAIN), inputs.dim_date, inputs.dim_provider))
    scans = [c for c in _columns(p) if "l_extendedprice" in c]
    assert scans, p
    assert all(not {"l_comment", "l_shipdate", "l_commitdate", "l_shipinstruct"} & c for c in scans)
    assert "dispatching_base_num" not in p


def test_checks_write_only_the_columns_they_read(spark):
    from tripmart.plans.catalog import Inputs, _check_silver

    written = _check_silver(Inputs(spark, SF_SMALL)).columns
    assert len(written) < 25 and not {"tolls", "bcf", "sales_tax", "wav_match", "_source_file"} & set(written)


def test_marts_aggregate_before_name_joins(inputs):
    p = plan(marts.location(inputs.fact, inputs.dim_location))
    # the final aggregate sits below the join that adds zone names
    head = p.split("\n\n")[0]
    assert head.index("HashAggregate") > head.index("Join")


def test_surrogate_keys_avoid_single_partition_window(inputs):
    from tripmart.operators import dims

    p = plan(dims.dim_dispatch(inputs.silver_table, "surrogate"))
    assert "SinglePartition" not in p.split("BroadcastExchange")[0]
    assert p.count("Scan ExistingRDD") >= 2 and "rangepartitioning" not in p  # both branches read one checkpointed partitioning


def test_cluster_settings_scale_with_input():
    from tripmart.session import cluster_settings

    small = cluster_settings(10 << 20, cores=8)
    big = cluster_settings(100 << 40, cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
