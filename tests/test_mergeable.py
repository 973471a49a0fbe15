"""Gold and baselines that merge, beside those computed from everything."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import NOON, bronze
from tidemark.operators.baseline import baseline, day_figures, thresholds_of_days
from tidemark.operators.cleaning import clean
from tidemark.operators.hourly import finished, hourly, hourly_states, hourly_with_states
from tidemark.operators.trends import coarser
from tidemark.plans.layers import EVENT_DATE, Lakehouse
from tidemark.plans.streams import PAYMENTS, STREAMS, SYSTEM_LOGS
from tidemark.sources.tables import replace_table


def rows_of(draw, spec, n=300, first=0, last=6):
    out = []
    for _ in range(n):
        at = NOON + timedelta(days=draw.randrange(first, last), hours=draw.randrange(9))
        out.append({
            "timestamp": draw.choice([at.isoformat()] * 12 + ["garbage"]),
            spec.key: draw.choice("abc"),
            "latency_ms": draw.random() * 1000,
            "cpu_percent": draw.random() * 100,
            "status": draw.choice(["failed", "completed"]),
        })
    return bronze(draw.spark, spec, [{k: v for k, v in row.items() if k in spec.field_names} for row in out])


def drawn(spark, seed):
    draw = random.Random(seed)
    draw.spark = spark
    return draw


@pytest.mark.parametrize("spec", STREAMS.values(), ids=STREAMS)
def test_states_finish_and_merge_as_silver_says(spark, spec):
    silver = clean(rows_of(drawn(spark, 1), spec), spec)
    states = hourly_states(silver, spec)
    assert sorted(map(str, finished(states, spec).collect())) == sorted(map(str, hourly(silver, spec).collect()))
    stored = hourly_with_states(silver, spec).select(hourly(silver, spec).columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, hourly(silver, spec).collect()))
    for unit in ("day", "week"):
        found = coarser(states, spec, unit)
        assert found.columns == hourly(silver, spec, unit).columns
        assert sorted(map(str, found.collect())) == sorted(map(str, hourly(silver, spec, unit).collect()))


def test_finished_averages_are_refused(spark):
    with pytest.raises(ValueError, match="latency_ms_sum"):
        coarser(hourly(clean(bronze(spark, SYSTEM_LOGS, [{}]), SYSTEM_LOGS), SYSTEM_LOGS), SYSTEM_LOGS, "day")


def test_baseline_of_days_equals_that_of_all_hours(spark, tmp_path):
    draw, lake = drawn(spark, 7), Lakehouse(spark, str(tmp_path))
    replace_table(rows_of(draw, PAYMENTS), lake.bronze_path(PAYMENTS))
    lake.refresh_silver(PAYMENTS)
    lake.refresh_gold(PAYMENTS)
    same = lambda found: sorted(map(str, found.collect())) == sorted(
        map(str, baseline(lake.gold(PAYMENTS), PAYMENTS).collect()))
    assert same(lake.refresh_baseline_days(PAYMENTS))
    # Two days change, one of them away to a day that is new.
    later = rows_of(draw, PAYMENTS, 80, 4, 8).where(
        "to_date(try_to_timestamp(timestamp)) <> '2024-05-05'"
    )
    replace_table(rows_of(drawn(spark, 7), PAYMENTS).where(
        "coalesce(to_date(try_to_timestamp(timestamp)) <> '2024-05-05', true)"
    ).unionByName(later.withColumn("event_id", F.concat(F.lit("l"), "event_id"))), lake.bronze_path(PAYMENTS))
    lake.refresh_silver(PAYMENTS)
    lake.refresh_gold_days(PAYMENTS, "2024-05-05", "2024-05-30")
    assert same(lake.refresh_baseline_days(PAYMENTS, "2024-05-05", "2024-05-30"))
    kept = {str(row[EVENT_DATE]) for row in lake.baseline_days(PAYMENTS).collect()}
    assert "2024-05-05" not in kept and "2024-05-08" in kept


def test_single_hours_and_far_values(spark):
    rates = [("a", 0, 1e6 + 0.25), ("a", 30, 1e6 + 0.75), ("a", 60, 1e6), ("b", 3, 5.0), ("c", None, 7.0)]
    gold = spark.createDataFrame(
        [(m, None if h is None else NOON + timedelta(hours=h), 10, 0, 0, 0.0, r) for m, h, r in rates],
        "merchant_id string, hour timestamp, total_transactions bigint, completed_count bigint, "
        "failed_count bigint, completed_volume double, failure_rate_pct double",
    )
    found = thresholds_of_days(day_figures(gold, PAYMENTS, "day"), PAYMENTS, "day")
    assert sorted(found.collect()) == sorted(baseline(gold, PAYMENTS).collect())
