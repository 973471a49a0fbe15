"""What the physical plans must look like for large tables."""

import re

import pytest

from checks.mapping import bronze_rows
from checks.queries import all_queries
from tests.conftest import SMALL
from tidemark.operators.baseline import baseline, flagged_hours, flagged_hours_in_one_pass
from tidemark.operators.cleaning import clean
from tidemark.operators.hourly import highest, hourly
from tidemark.operators.quality import observed, quality
from tidemark.operators.sequence import entity_sequence
from tidemark.plans.streams import PAYMENTS, STREAMS


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Bronze of every stream as stored tables."""
    root = tmp_path_factory.mktemp("bronze")
    for name in STREAMS:
        bronze_rows(spark, SMALL, name).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in STREAMS}


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def exchanges(rows):
    return re.findall(r"Exchange (\w+)", plan(rows))


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_dedup_keeps_one_row_per_key_before_its_only_exchange(tables, spec):
    lines = plan(clean(tables[spec.name], spec)).splitlines()
    order = [
        word
        for line in lines
        for word in ("WindowGroupLimit", "Exchange", "FileScan")
        if word in line.split("[")[0]
    ]
    assert order == ["WindowGroupLimit", "Exchange", "WindowGroupLimit", "FileScan"]


def test_filters_reach_the_scan(tables):
    text = clean(tables["payments"], PAYMENTS)._jdf.queryExecution().executedPlan()
    scan = text.toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\.\.\.|PushedFilters: \[(.*)\]", scan).group(0)
    assert "IsNotNull(event_id)" in pushed


def test_gold_reads_the_columns_it_needs(tables):
    gold = highest(hourly(clean(tables["payments"], PAYMENTS), PAYMENTS), PAYMENTS)
    [scan] = re.findall(r"FileScan parquet \[(.*?)\]", plan(gold))
    assert "user_id" not in scan
    assert "TakeOrderedAndProject" in plan(gold)


def test_gold_aggregates_before_its_exchange(tables):
    gold = hourly(clean(tables["payments"], PAYMENTS), PAYMENTS)
    assert exchanges(gold) == ["hashpartitioning", "hashpartitioning"]
    assert "partial_count" in plan(gold)


def test_quality_scans_once(tables):
    text = plan(quality(tables["payments"], PAYMENTS))
    assert text.count("FileScan") == 1
    assert "Window" not in text


def test_a_silver_run_counts_in_its_one_scan(spark, tables):
    rows, _ = observed(tables["payments"], PAYMENTS)
    text = plan(clean(rows, PAYMENTS))
    assert text.count("FileScan") == 1 and "CollectMetrics" in text
    assert exchanges(clean(rows, PAYMENTS)) == ["hashpartitioning"]


def test_sequence_moves_rows_once(spark, tables):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entity_sequence(tables["payments"], "merchant_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    below = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in below[: below.index("Window")]


def test_flagging_in_one_pass_scans_once(tables):
    gold = hourly(clean(tables["payments"], PAYMENTS), PAYMENTS)
    assert plan(flagged_hours_in_one_pass(gold, PAYMENTS)).count("FileScan") == 1


def test_flagging_broadcasts_only_below_the_size_limit(spark, tables):
    gold = hourly(clean(tables["payments"], PAYMENTS), PAYMENTS)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(flagged_hours(gold, baseline(gold, PAYMENTS), PAYMENTS))
        sequence = plan(entity_sequence(tables["payments"], "merchant_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for found in (text, sequence):
        assert "SortMergeJoin" in found
        assert "BroadcastExchange" not in found


def test_no_query_leaves_the_jvm_or_crosses_rows(spark):
    writers = ("layers_", "stream_", "payments_stored_")
    for name, query in all_queries().items():
        if name.startswith(writers):
            continue
        text = plan(query(spark, SMALL))
        for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, (name, bad)
