"""Whole layers against a plain Python reading of their definition, on random events."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest

from tests.rows import NOON, bronze
from tidemark.operators.cleaning import clean
from tidemark.operators.hourly import hourly
from tidemark.operators.quality import quality
from tidemark.plans.streams import PAYMENTS


def random_changes(seed):
    draw = random.Random(seed)
    return [
        {
            # A third of all rows share one id.
            "event_id": draw.choice(["hot", f"evt_{draw.randrange(60)}", f"evt_{draw.random()}"]),
            "merchant_id": draw.choice([None, "m1", "m1", "m1", "m2", "m3"]),
            "amount": draw.choice([None, -1.0, 0.0, 1.25, 10.0, 99.5]),
            "currency": draw.choice(["USD", "EUR", "GBP", "CAD", "XYZ", None]),
            "status": draw.choice(["completed", "failed", "pending", "APPROVED", None]),
            "timestamp": draw.choice(
                [None, "x", *[(NOON + timedelta(minutes=m)).isoformat() for m in (0, 30, 61, 150)]]
            ),
            "kafka_timestamp": NOON + timedelta(seconds=draw.randrange(5)),
            "partition": draw.randrange(3),
            "offset": place,
        }
        for place in range(600)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_payments_layers(spark, seed):
    changes = random_changes(seed)
    usable = [
        c for c in changes if None not in (c["merchant_id"], c["amount"], c["status"])
    ]
    valid = [
        c
        for c in usable
        if c["amount"] > 0
        and c["currency"] in ("USD", "CAD", "EUR", "GBP")
        and c["status"] in ("completed", "failed", "pending")
    ]
    latest = {}
    for c in sorted(valid, key=lambda c: (c["kafka_timestamp"], c["partition"], c["offset"])):
        latest[c["event_id"]] = c

    rows = bronze(spark, PAYMENTS, changes).repartition(7)
    counts = quality(rows, PAYMENTS).first()
    assert (counts["total"], counts["after_nulls"], counts["after_validation"]) == (
        len(changes), len(usable), len(valid)
    )
    assert counts["after_dedup"] == len(latest)

    silver = clean(rows, PAYMENTS)
    assert {r["event_id"]: r["offset"] for r in silver.collect()} == {
        name: c["offset"] for name, c in latest.items()
    }

    expected = defaultdict(lambda: [0, 0, 0, 0.0])
    for c in latest.values():
        hour = None if c["timestamp"] in (None, "x") else int(c["timestamp"][11:13])
        cell = expected[c["merchant_id"], hour]
        cell[0] += 1
        cell[1] += c["status"] == "completed"
        cell[2] += c["status"] == "failed"
        cell[3] += c["amount"] if c["status"] == "completed" else 0
    found = {
        (r["merchant_id"], r["hour"] and r["hour"].hour): [*r[2:6]]
        for r in hourly(silver, PAYMENTS).collect()
    }
    assert found == dict(expected)
