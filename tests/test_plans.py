"""Plan properties the scale design relies on (checked on the executed plan)."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return entry.queries()


def test_delta_filters_reach_the_scan(spark, qs):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    for name in ("delta_extract_range", "delta_extract_eq", "scan_raw_by_loaddate", "scan_refined_between"):
        p = plan_of(qs[name](spark, SF_SMALL))
        pushed = re.search(r"PushedFilters: \[([^\]]*)", p).group(1)
        assert "GreaterThanOrEqual" in pushed and "LessThan" in pushed, (name, pushed)


def test_profile_is_one_scan_and_one_shuffle(spark, qs):
    p = plan_of(qs["null_profile_lineitem"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1
    assert len(re.findall(r"(?<![A-Za-z])Exchange ", p)) == 1
    assert "l_tax" not in re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)   # constant-null column pruned


def test_no_cartesian_or_python_anywhere(spark, qs):
    for name in ("increment_plan", "dq_plan", "schema_share", "table_sizes", "validate_raw_refined",
                 "jobstat_upsert", "sequence_gaps", "feed_jobstat_check"):
        p = plan_of(qs[name](spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in p, (name, bad)


def test_upsert_does_not_aggregate_the_state(spark, qs):
    p = plan_of(qs["jobstat_upsert"](spark, SF_SMALL))
    assert "LeftAnti" in p
    # only the batch is keep-latest aggregated (one partial + one final sort aggregate)
    assert p.count("SortAggregate") == 2


def test_holidays_broadcast_and_calendar_hash_aggregate(spark, qs):
    p = plan_of(qs["calendar_decision"](spark, SF_SMALL))
    assert "BroadcastExchange" in p and "SortAggregate" not in p
