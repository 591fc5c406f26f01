"""Plan shapes that keep the queries distributed."""

import re

import pytest
from conftest import SMALL

from logassay.operators import calendar, coverage, profile
from logassay.plans import inputs
from logassay.plans.catalog import QUERIES

# Pair-wise joins and anything that leaves the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "FlatMapGroups")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df) -> set[str]:
    return {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)) for c in s.split(",")}


# The verdict queries write scratch tables and are covered by their parts; vector search multiplies
# matrices in Arrow batches.
@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not re.search("verdict|ingest|^vector_", q)))
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not [node for node in FORBIDDEN if node in text]


@pytest.mark.parametrize(
    "build,columns",
    [
        (lambda s: profile.long_tail(inputs.table(s, SMALL, "lineitem"), "l_partkey"), {"l_partkey"}),
        (lambda s: profile.measure_profile(inputs.table(s, SMALL, "lineitem"), "l_tax"), {"l_tax"}),
        (lambda s: coverage.key_subset(inputs.table(s, SMALL, "customer"), "c_custkey",
                                       inputs.table(s, SMALL, "orders"), "o_custkey"), {"c_custkey", "o_custkey"}),
        (lambda s: calendar.date_segments(inputs.table(s, SMALL, "events"), "event_id", ["user_id"]),
         {"event_id", "user_id"}),
        (lambda s: QUERIES["duplicate_pairs_purchases"](s, SMALL), {"l_orderkey", "l_partkey", "o_orderkey", "o_custkey"}),
    ],
    ids=["long_tail", "measure", "subset", "segments", "pairs"],
)
def test_only_needed_columns_are_read(spark, build, columns):
    assert read_columns(build(spark)) == columns


@pytest.mark.parametrize("name", ["ratio_consistency", "date_time_consistency", "over_duration", "zero_denominator",
                                  "epoch_date_consistency", "label_shares", "parse_loss", "null_excess"])
def test_row_checks_shuffle_one_row_per_task(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "hashpartitioning" not in text and text.count("Exchange SinglePartition") == 1
    assert "partial_count" in text


def test_day_conversion_stays_above_the_fold(spark):
    lines = plan(QUERIES["date_segments"](spark, SMALL)).split("\n")
    fold = max(i for i, line in enumerate(lines) if "HashAggregate" in line)
    assert not any("+- Filter" in line for line in lines[fold:])
    assert not any("try_make_timestamp" in line for line in lines[fold:])
    assert sum("Exchange hashpartitioning(day" in line for line in lines) == 1
