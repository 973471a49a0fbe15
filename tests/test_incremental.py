"""Silver kept up by days of Bronze, beside a rebuild from all of it."""

import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.rows import NOON, bronze
from tidemark.operators.cleaning import clean
from tidemark.operators.envelope import LOG_DATE
from tidemark.plans import incremental
from tidemark.plans.incremental import IncrementalSilver
from tidemark.plans.layers import Lakehouse
from tidemark.plans.streams import PAYMENTS
from tidemark.sources.tables import replace_table

DAY = timedelta(days=1)


def changes(draw, days, n):
    """Events of some days of the log, with copies, invalid rows and odd times among them."""
    out = []
    for _ in range(n):
        day = draw.choice(days)
        stamp = NOON + day * DAY + timedelta(seconds=draw.randrange(3))
        event_day = NOON + (day - draw.randrange(3)) * DAY
        out.append({
            "event_id": draw.choice([None, *[f"evt_{k}" for k in range(60)]]),
            "amount": draw.choice([5.0, 7.5, -1.0, None, float(draw.randrange(1, 99))]),
            "timestamp": draw.choice(["garbage", event_day.isoformat(), event_day.isoformat()]),
            "offset": draw.randrange(10**9),
            "kafka_timestamp": draw.choice([stamp, stamp, stamp, None]),
        })
    return out


def append(spark, lake, rows):
    frame = bronze(spark, PAYMENTS, rows).withColumn(LOG_DATE, F.to_date("kafka_timestamp"))
    frame.write.mode("append").partitionBy(LOG_DATE).parquet(lake.bronze_path(PAYMENTS))


def silver(lake):
    return sorted(lake.silver(PAYMENTS).collect(), key=str)


def rebuilt(lake):
    return sorted(clean(lake.bronze(PAYMENTS), PAYMENTS).collect(), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_days_equals_a_rebuild(spark, tmp_path, seed):
    draw, lake = random.Random(seed), Lakehouse(spark, str(tmp_path))
    for days in ([4], [2, 3], [4, 9], [1]):
        append(spark, lake, changes(draw, days, 40))
        run = IncrementalSilver(lake, PAYMENTS, buckets=5).refresh().first()
        assert run["bronze_days"] >= len(days) and run["candidates"] >= run["added"]
        assert silver(lake) == rebuilt(lake)
    assert IncrementalSilver(lake, PAYMENTS).refresh().first()["bronze_days"] == 0
    assert IncrementalSilver(lake, PAYMENTS).buckets == 5
    index = IncrementalSilver(lake, PAYMENTS).index()
    assert sorted(r["event_id"] for r in index.collect()) == sorted(r["event_id"] for r in silver(lake))


def garble(folder):
    """Same names and sizes, but no longer readable."""
    for file in Path(folder).glob("*.parquet"):
        file.write_bytes(b"x" * file.stat().st_size)
    for file in Path(folder).glob(".*.crc"):
        file.unlink()
    return folder


def test_untouched_days_and_buckets_are_not_read(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path))
    at = lambda day, **more: {"kafka_timestamp": NOON + day * DAY,
                              "timestamp": (NOON + day * DAY).isoformat(), **more}
    append(spark, lake, [at(0, event_id="a"), at(1, event_id="b"), at(2, event_id="c")])
    IncrementalSilver(lake, PAYMENTS, buckets=64).refresh()
    before = IncrementalSilver(lake, PAYMENTS).index().where("event_id = 'c'").first()
    for file in Path(lake.bronze_path(PAYMENTS)).glob(".*crc"):
        file.unlink()
    days = [f"{NOON + day * DAY:%Y-%m-%d}" for day in range(4)]
    for day in days[:3]:
        folder = Path(lake.bronze_path(PAYMENTS), f"{LOG_DATE}={day}")
        size = sum(f.stat().st_size for f in folder.iterdir())
        garble(folder)
        missing = size - sum(f.stat().st_size for f in folder.iterdir())
        (folder / "_rest.crc").write_bytes(b"x" * missing)
        (folder / "_rest.crc").rename(folder / ".rest.crc")
    content = next(Path(lake.silver_path(PAYMENTS)).glob("content-*"))
    for day in days[:2]:
        garble(content / f"event_date={day}")
    own = next(Path(IncrementalSilver(lake, PAYMENTS).index_path).glob("content-*"))
    for folder in own.glob("bucket=*"):
        if folder.name != f"bucket={before['bucket']}":
            garble(folder)
    append(spark, lake, [at(3, event_id="c", amount=2.0)])
    run = IncrementalSilver(lake, PAYMENTS).refresh().first()
    assert tuple(run) == (1, 1, 0, 1, 1, 2)
    left = lake.silver(PAYMENTS, days[2])
    assert [(r["event_id"], r["amount"]) for r in left.collect()] == [("c", 2.0)]
    assert not (content / f"event_date={days[2]}").exists()


@pytest.mark.parametrize("step", ["_write_silver", "_write_index", "_note"])
def test_a_run_that_died_is_repeated(spark, tmp_path, monkeypatch, step):
    draw, lake = random.Random(9), Lakehouse(spark, str(tmp_path))
    append(spark, lake, changes(draw, [1, 2], 40))
    IncrementalSilver(lake, PAYMENTS, buckets=3).refresh()
    append(spark, lake, changes(draw, [2, 3], 40))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(incremental.IncrementalSilver, step, dies)
        with pytest.raises(RuntimeError):
            IncrementalSilver(lake, PAYMENTS).refresh()
    IncrementalSilver(lake, PAYMENTS).refresh()
    assert silver(lake) == rebuilt(lake)


def test_bronze_without_days_is_refused(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path))
    assert IncrementalSilver(lake, PAYMENTS).refresh().first()["bronze_days"] == 0
    replace_table(bronze(spark, PAYMENTS, [{}]), lake.bronze_path(PAYMENTS))
    with pytest.raises(ValueError, match="does not lie by"):
        IncrementalSilver(lake, PAYMENTS).refresh()
    with pytest.raises(ValueError, match="merge rows themselves"):
        IncrementalSilver(Lakehouse(spark, str(tmp_path), "delta"), PAYMENTS)
