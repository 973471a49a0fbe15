import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rows import bronze, gold
from tidemark.__main__ import main
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import log_records
from tidemark.operators.hourly import hourly
from tidemark.operators.quality import quality
from tidemark.plans.layers import Lakehouse
from tidemark.plans.streams import PAYMENTS, STREAMS
from tidemark.session import CHECKPOINT_SETTING, scratch_path
from tidemark.sources.tables import read_table, replace_table
from tidemark.sources.topics import append_log_files

CHANGES = [
    {},
    {"event_id": "evt_0"},
    {"timestamp": "2024-05-02T00:30:00+00:00"},
    {"timestamp": "2024-05-03T00:30:00+00:00"},
    {"timestamp": "garbage"},
    {"event_id": None},
]


def filled(spark, root, spec):
    lake = Lakehouse(spark, str(root))
    replace_table(bronze(spark, spec, CHANGES), lake.bronze_path(spec))
    return lake


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_layers_equal_their_operators(spark, tmp_path, spec):
    lake = filled(spark, tmp_path, spec)
    rows = lake.bronze(spec)
    assert lake.refresh_silver(spec).collect() == quality(rows, spec).collect()
    silver = clean(rows, spec)
    assert lake.silver(spec).columns == silver.columns
    assert sorted(lake.silver(spec).collect(), key=str) == sorted(silver.collect(), key=str)
    gold = lake.refresh_gold(spec)
    assert sorted(gold.collect(), key=str) == sorted(hourly(silver, spec).collect(), key=str)


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_layers_of_nothing_are_empty(spark, tmp_path, spec):
    lake = Lakehouse(spark, str(tmp_path))
    replace_table(bronze(spark, spec, []), lake.bronze_path(spec))
    counts = lake.refresh_silver(spec).first()
    assert (counts["total"], counts["after_dedup"], counts["quality_score"]) == (0, 0, None)
    assert lake.refresh_gold(spec).count() == 0
    assert lake.gold(spec).columns == hourly(clean(lake.bronze(spec), spec), spec).columns
    assert lake.silver(spec).count() == 0


def test_refresh_replaces_earlier_content(spark, tmp_path):
    lake = filled(spark, tmp_path, PAYMENTS)
    first = lake.refresh_silver(PAYMENTS).collect()
    assert lake.refresh_silver(PAYMENTS).collect() == first
    replace_table(bronze(spark, PAYMENTS, [{}]), lake.bronze_path(PAYMENTS))
    lake.refresh_silver(PAYMENTS)
    assert lake.silver(PAYMENTS).count() == 1


@pytest.mark.parametrize("feed, line", [("timeline", "COMPLETED"), ("trace", "completed")])
def test_whole_feed_goes_to_a_table_or_some_to_the_console(spark, tmp_path, feed, line):
    records = log_records(bronze(spark, PAYMENTS, CHANGES), PAYMENTS)
    append_log_files(records, f"{tmp_path}/log")
    common = [feed, "--root", f"{tmp_path}/lake", "--log", f"{tmp_path}/log", "--once"]
    main([*common, "--out", f"{tmp_path}/feed"])
    assert spark.read.parquet(f"{tmp_path}/feed").count() == len(CHANGES)
    assert spark.read.parquet(f"{tmp_path}/feed").where(
        f"line like '%$10.0 USD | {line}'"
    ).count() == len(CHANGES)
    main([*common, "--preview", "2"])  # the JVM prints; ends once the log is shown


def test_feed_is_complete_by_default_and_goes_on(spark, tmp_path):
    values = bronze(spark, PAYMENTS, [{"user_id": f"user_{n}"} for n in range(1200)])
    common = ["timeline", "--root", f"{tmp_path}/lake", "--log", f"{tmp_path}/log", "--once"]
    for count in (1200, 2400):
        append_log_files(log_records(values, PAYMENTS), f"{tmp_path}/log")
        main(common)
        assert spark.read.parquet(f"{tmp_path}/lake/feeds/timeline").count() == count


def test_silver_of_days_reads_those_days_only(spark, tmp_path):
    lake = filled(spark, tmp_path, PAYMENTS)
    lake.refresh_silver(PAYMENTS)
    days = lake.silver(PAYMENTS, "2024-05-02", "2024-05-02")
    assert days.count() == 1
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date", plan(days))
    assert lake.silver(PAYMENTS, "2024-05-02").count() == 2
    assert lake.silver(PAYMENTS).where(F.col("event_timestamp").isNull()).count() == 1


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def changed(spark, lake, changes):
    """Silver after Bronze has got other events."""
    replace_table(bronze(spark, PAYMENTS, changes), lake.bronze_path(PAYMENTS))
    lake.refresh_silver(PAYMENTS)


def days(gold):
    rows = gold.where("hour is not null").orderBy("hour").collect()
    return [(r["hour"].day, r["total_transactions"]) for r in rows]


def test_gold_days_replace_those_days_only(spark, tmp_path):
    lake = filled(spark, tmp_path, PAYMENTS)
    lake.refresh_silver(PAYMENTS)
    assert days(lake.refresh_gold(PAYMENTS)) == [(1, 1), (2, 1), (3, 1)]
    changed(spark, lake, [*CHANGES, CHANGES[2], CHANGES[3]])
    assert days(lake.refresh_gold_days(PAYMENTS, "2024-05-02", "2024-05-02")) == [
        (1, 1), (2, 2), (3, 1)
    ]
    assert lake.gold(PAYMENTS).where("hour is null").count() == 1
    assert days(lake.gold(PAYMENTS, "2024-05-03")) == [(3, 1)]


def test_gold_days_drop_a_day_that_silver_lost(spark, tmp_path):
    lake = filled(spark, tmp_path, PAYMENTS)
    lake.refresh_silver(PAYMENTS)
    lake.refresh_gold(PAYMENTS)
    changed(spark, lake, [{}, CHANGES[3]])
    assert days(lake.refresh_gold_days(PAYMENTS, "2024-05-02", "2024-05-03")) == [(1, 1), (3, 1)]


@pytest.mark.parametrize("bounds", [("2024-05-02", None), (None, "2024-05-02"), (None, None)])
def test_gold_days_of_an_open_range_and_without_gold(spark, tmp_path, bounds):
    lake = filled(spark, tmp_path, PAYMENTS)
    lake.refresh_silver(PAYMENTS)
    expected = [day for day in (1, 2, 3) if "2024-05-02" not in bounds or
                (day >= 2 if bounds[0] else day <= 2)]
    found = lake.refresh_gold_days(PAYMENTS, *bounds)
    assert [day for day, _ in days(found)] == expected


def test_one_date_bound_is_honoured(spark, tmp_path):
    lake = filled(spark, tmp_path, PAYMENTS)
    lake.refresh_silver(PAYMENTS)
    main(["gold", "payments", "--root", str(tmp_path), "--first-date", "2024-05-03"])
    assert [day for day, _ in days(lake.gold(PAYMENTS))] == [3]


def test_a_lost_day_leaves_other_days_alone(spark, tmp_path):
    lake = filled(spark, tmp_path, PAYMENTS)
    lake.refresh_silver(PAYMENTS)
    lake.refresh_gold(PAYMENTS)
    before = {path for path in Path(lake.gold_path(PAYMENTS)).rglob("*.parquet")}
    changed(spark, lake, [{}, CHANGES[3]])
    lake.refresh_gold_days(PAYMENTS, "2024-05-02", "2024-05-02")
    after = {path for path in Path(lake.gold_path(PAYMENTS)).rglob("*.parquet")}
    assert after < before
    assert {path.parent.name for path in before - after} == {"event_date=2024-05-02"}


def test_a_failed_replacement_keeps_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in (3, 5, 7):
        replace_table(spark.range(n), path)
        assert read_table(spark, path).count() == n
    assert len(list(Path(path).glob("content-*"))) == 2
    with pytest.raises(Exception, match="broken"):
        replace_table(spark.range(4).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert read_table(spark, path).count() == 7


def test_baseline_outputs_are_stored_in_full(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path))
    rates = {f"m{n:02}": [5.0] * 9 + [90.0] for n in range(30)} | {"new": [1.0, 1.0, 90.0]}
    replace_table(gold(spark, rates).withColumn("event_date", F.to_date("hour")), lake.gold_path(PAYMENTS))
    main(["baseline", "payments", "--root", str(tmp_path), "--min-hours", "5"])
    thresholds = read_table(spark, lake.path("baseline", "payments_thresholds"))
    flagged = read_table(spark, lake.path("baseline", "payments_flagged"))
    assert (thresholds.count(), flagged.count()) == (31, 30)
    assert thresholds.where("merchant_id = 'new'").first()["anomaly_threshold_pct"] is None
    main(["baseline", "payments", "--root", str(tmp_path), "--percentile", "0.5"])
    thresholds = read_table(spark, lake.path("baseline", "payments_thresholds"))
    assert thresholds.where("merchant_id = 'm01'").first()["anomaly_threshold_pct"] == 5.0


def test_flagged_hours_of_stored_gold(spark, tmp_path):
    changes = [
        {"timestamp": f"2024-05-01T{hour:02}:10:00Z", "status": "failed" if hour == 9 else "pending"}
        for hour in range(10)
    ]
    lake = Lakehouse(spark, str(tmp_path))
    replace_table(bronze(spark, PAYMENTS, changes), lake.bronze_path(PAYMENTS))
    lake.refresh_silver(PAYMENTS)
    lake.refresh_gold(PAYMENTS)
    assert [r["hour"].hour for r in lake.flagged(PAYMENTS).collect()] == [9]


def test_scratch_is_fresh_and_shared(spark):
    shared = spark.conf.get(CHECKPOINT_SETTING)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(shared) and second.startswith(shared)


class Conf(dict):
    def get(self, name, default=None):
        return dict.get(self, name, default)


def test_scratch_of_a_cluster_must_be_named():
    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        scratch_path(Session, "x")


def test_command_line_runs_every_layer(spark, tmp_path, capsys):
    root = f"{tmp_path}/lake"
    append_log_files(
        log_records(bronze(spark, PAYMENTS, CHANGES), PAYMENTS), f"{tmp_path}/log"
    )
    main(["bronze", "payments", "--root", root, "--log", f"{tmp_path}/log", "--once"])
    for layer in ("silver", "gold", "baseline", "report"):
        main([layer, "payments", "--root", root])
    shown = capsys.readouterr().out
    assert "66.7" in shown  # quality score: four of six rows
    assert "failure_rate_pct" in shown
    assert "anomaly_threshold_pct" in shown
    assert sorted(p.name for p in Path(root).iterdir()) == [
        "baseline", "bronze", "checkpoints", "gold", "report", "silver"
    ]
    assert read_table(spark, f"{root}/report/total_events").first()[0] == len(CHANGES)
    assert sorted(p.name for p in Path(f"{root}/report").iterdir()) == [
        "failures_by_merchant", "status_breakdown", "total_events", "volume_by_currency"
    ]
