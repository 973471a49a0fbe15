"""The ``events`` table seen as the three event streams.

Every event becomes one record in each stream; none is left out. Categories and ids
derive from the event's own columns, and fixed residues of ``event_id`` plant the cases
that the operators must meet: missing fields, values out of range, unknown categories,
three copies of an id, equal log times, unreadable times, a user with a third of all
events, a merchant with a short history, and log records that are no JSON, no object or
wrongly typed. A record's partition follows from its key. The expressions are plain SQL,
used by the Spark queries and by the SQL counterparts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENT_ID = """case when event_id % 101 = 0 then null
    when event_id % 20 in (1, 2) then 'evt_' || cast(event_id - event_id % 20 as string)
    else 'evt_' || cast(event_id as string) end"""
TIMESTAMP_TEXT = """case when event_id % 131 = 0 then 'garbage'
    when event_id % 137 = 0 then null
    else cast(ts as string) end"""

FIELDS: dict[str, dict[str, str]] = {
    "payments": {
        "event_id": EVENT_ID,
        "merchant_id": """case when event_id % 103 = 0 then null
            when event_id % 300 = 7 then 'store-few'
            else 'store-' || cast(1 + user_id % 4 as string) end""",
        "user_id": "'user-' || cast(user_id as string)",
        "amount": """case when event_id % 89 = 0 then null
            when event_id % 83 = 0 then -value
            when event_id % 79 = 0 then 0.0
            else value end""",
        "currency": """case when event_id % 73 = 0 then 'ZZZ'
            when event_id % 7 < 3 then 'EUR'
            when event_id % 7 < 5 then 'GBP'
            when event_id % 7 = 5 then 'CAD'
            else 'USD' end""",
        "status": """case when event_id % 71 = 0 then 'settled'
            when event_id % 300 = 7 then
                case when event_id % 3000 = 7 then 'failed' else 'completed' end
            when event_type = 'error' then 'failed'
            when event_type = 'signup' then 'pending'
            else 'completed' end""",
        "timestamp": TIMESTAMP_TEXT,
    },
    "user_events": {
        "event_id": EVENT_ID,
        "user_id": """case when event_id % 103 = 0 then null
            when event_id % 3 = 0 then 'user-0'
            else 'user-' || cast(user_id as string) end""",
        "session_id": "'visit-' || cast(user_id * 5 + event_id % 5 as string)",
        "event_type": """case when event_id % 97 = 0 then 'hover'
            when event_id % 10 < 2 then 'page_view'
            when event_id % 10 = 2 then 'click'
            when event_id % 10 = 3 then 'signup'
            when event_id % 10 < 6 then 'add_to_cart'
            when event_id % 10 < 9 then 'checkout'
            else 'purchase' end""",
        "page": """case when event_id % 11 < 3 then '/start'
            when event_id % 11 < 6 then '/list'
            when event_id % 11 < 8 then '/item'
            when event_id % 11 = 8 then '/basket'
            when event_id % 11 = 9 then '/pay'
            else '/thanks' end""",
        "device": """case when event_id % 89 = 0 then 'watch'
            when event_id % 83 = 0 then null
            when event_id % 13 < 11 then 'mobile'
            when event_id % 13 = 11 then 'desktop'
            else 'tablet' end""",
        "timestamp": TIMESTAMP_TEXT,
    },
    "system_logs": {
        "event_id": EVENT_ID,
        "service": """case when event_id % 103 = 0 then null
            when user_id % 5 = 0 then 'ledger'
            when user_id % 5 = 1 then 'search'
            when user_id % 5 = 2 then 'mailer'
            when user_id % 5 = 3 then 'gateway'
            else 'reports' end""",
        "level": """case when event_id % 97 = 0 then 'TRACE'
            when event_id * 7 % 10 < 6 then 'INFO'
            when event_id * 7 % 10 < 9 then 'WARN'
            else 'ERROR' end""",
        "message": "'step ' || cast(event_id % 6 as string)",
        "latency_ms": """case when event_id % 89 = 0 then null
            when event_id % 83 = 0 then -value
            else value * 3 end""",
        "cpu_percent": """case when event_id % 79 = 0 then 120.5
            when event_id % 73 = 0 then null
            else cast(event_id % 870 as double) / 10 end""",
        "memory_percent": """case when event_id % 71 = 0 then -2.0
            else cast(event_id % 640 as double) / 10 + 20 end""",
        "timestamp": TIMESTAMP_TEXT,
    },
}

# The number of the key, as the key itself says; a record without a key lies in 0.
PARTITION = {
    "payments": """cast(case when event_id % 103 = 0 then 0
        when event_id % 300 = 7 then 2 else user_id % 4 % 3 end as int)""",
    "user_events": """cast(case when event_id % 103 = 0 or event_id % 3 = 0 then 0
        else user_id % 3 end as int)""",
    "system_logs": """cast(case when event_id % 103 = 0 then 0
        else user_id % 5 % 3 end as int)""",
}
OFFSET = "event_id"
# All three copies of some ids have one log time.
KAFKA_TIMESTAMP = "case when event_id % 60 in (20, 21, 22) then date_trunc('month', ts) else ts end"

# Log records that do not hold what the stream declares, by offset: no JSON, no object, no
# field; a number given as text; a field that is not declared.
NO_JSON, NO_OBJECT, NO_FIELD, AS_TEXT, UNDECLARED = (
    '"offset" % 211 = 0', '"offset" % 223 = 0', '"offset" % 227 = 0',
    '"offset" % 229 = 0', '"offset" % 233 = 0',
)
NUMBERS = {"payments": "amount", "user_events": None, "system_logs": "latency_ms"}


def select_list(stream: str) -> list[str]:
    """The stream's Bronze columns as ``expression as name`` texts."""
    fields = [f'{sql} as {name}' for name, sql in FIELDS[stream].items()]
    return [
        *fields,
        f"{PARTITION[stream]} as partition",
        f"{OFFSET} as offset",
        f"{KAFKA_TIMESTAMP} as kafka_timestamp",
    ]


def bronze_rows(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    """All events as Bronze rows of a stream."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.selectExpr(*select_list(stream))
    return rows.withColumn("kafka_timestamp", rows.kafka_timestamp.cast("timestamp"))


def with_bad_records(log: DataFrame, stream: str) -> DataFrame:
    """A log in which some records do not hold what the stream declares."""
    text = "cast(value as string)"
    typed = text
    if number := NUMBERS[stream]:
        typed = f"""regexp_replace({text}, '"{number}":[^,}}]*', '"{number}":"12.5"')"""
    changed = f"""case when {NO_JSON} then 'no json' when {NO_OBJECT} then '[]'
        when {NO_FIELD} then '{{}}' when {AS_TEXT} then {typed}
        when {UNDECLARED} then regexp_replace({text}, '^.', '{{"more":[1],')
        else {text} end""".replace('"offset"', "offset")
    return log.selectExpr(
        *[f"cast({changed} as binary) as value" if c == "value" else c for c in log.columns]
    )
