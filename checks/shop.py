"""Queries over the shop tables (orders, lineitem, customer, part) and their SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.rounding import round2
from tidemark.operators.baseline import flagged_hours_in_one_pass
from tidemark.operators.cleaning import clean
from tidemark.operators.hourly import hourly
from tidemark.operators.quality import quality
from tidemark.plans.shop import ORDERS, REFUNDS, orphans
from tidemark.plans.streams import StreamSpec

# The tables hold no faults: some orders get a total of zero, some lose their customer, and
# every 500th comes twice.
ORDER_FIELDS = {
    "event_id": """'order_' || cast(
        o_orderkey - case when o_orderkey % 500 = 1 then 1 else 0 end as string)""",
    "customer_id": "case when o_orderkey % 89 = 0 then null else o_custkey end",
    "state": "o_orderstatus",
    "total": "case when o_orderkey % 97 = 0 then 0.0 else o_totalprice end",
    "timestamp": "cast(o_orderdate as string)",
}
LINE_FIELDS = {
    "event_id": "cast(l_orderkey as string) || '/' || cast(l_linenumber as string) || '/' "
    "|| cast(l_partkey as string) || '/' || cast(l_suppkey as string)",
    "order_id": "l_orderkey",
    "part_id": "l_partkey",
    "state": "l_returnflag",
    "quantity": "l_quantity",
    "timestamp": "cast(l_shipdate as string)",
}


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(
        *[f"{sql} as {name}" for name, sql in ORDER_FIELDS.items()],
        "0 as partition",
        "o_orderkey as offset",
        "cast(o_orderdate as timestamp) as kafka_timestamp",
    )


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines; equal lines of an order are one event, of which the larger quantity stays."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.selectExpr(
        *[f"{sql} as {name}" for name, sql in LINE_FIELDS.items()],
        "0 as partition",
        "cast(l_extendedprice * 100 as bigint) as offset",
        "cast(l_shipdate as timestamp) as kafka_timestamp",
    )


def orders_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(order_rows(spark, sf_dir), ORDERS)


def flagged(spark: SparkSession, sf_dir: str, spec: StreamSpec, rows_of, unit: str) -> DataFrame:
    spans = hourly(clean(rows_of(spark, sf_dir), spec), spec, unit)
    found = flagged_hours_in_one_pass(spans, spec, time=unit)
    return found.withColumn(unit, F.col(unit).cast("timestamp_ntz"))


def refund_rates_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refund rate per brand: lines meet their parts, whatever the sizes of both."""
    lines = clean(line_rows(spark, sf_dir), REFUNDS)
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand")
    joined = lines.join(parts, lines["part_id"] == parts["p_partkey"])
    rate = REFUNDS.rates["refund_rate_pct"]
    measures = [F.expr(m.sql).alias(name) for name, m in REFUNDS.measures.items()]
    return joined.groupBy("p_brand").agg(*measures).withColumn("refund_rate_pct", F.expr(rate))


def refunds_of_open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunded lines whose order is not among the finished ones."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_returnflag = 'R'")
    finished = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'F'")
    return orphans(lines, finished.select("o_orderkey"), "l_orderkey", "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


def customers_without_good_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers none of whose orders is worth anything and finished."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    good = clean(order_rows(spark, sf_dir), ORDERS).where("state = 'F'").select("customer_id")
    return orphans(customers, good, "c_custkey", "customer_id")


def all_queries() -> dict:
    return {
        "orders_quality": orders_quality,
        "customer_order_spikes": partial(
            flagged, spec=ORDERS, rows_of=order_rows, unit="quarter"
        ),
        "part_refund_spikes": partial(flagged, spec=REFUNDS, rows_of=line_rows, unit="year"),
        "refund_rates_by_brand": refund_rates_by_brand,
        "refunds_of_open_orders": refunds_of_open_orders,
        "customers_without_good_order": customers_without_good_order,
    }


ORDERS_SILVER = f"""
raw as (select {", ".join(f'{sql} as "{name}"' for name, sql in ORDER_FIELDS.items())},
    o_orderkey, o_orderdate from orders),
usable as (select * from raw
  where event_id is not null and customer_id is not null and total is not null),
valid as (select * from usable where total > 0 and state in ('O', 'F', 'P')),
silver as (select * from (select *, row_number() over (partition by event_id
    order by o_orderdate desc, o_orderkey desc) as place from valid) where place = 1)"""

LINES_SILVER = f"""
raw as (select {", ".join(f'{sql} as "{name}"' for name, sql in LINE_FIELDS.items())},
    l_shipdate, cast(trunc(l_extendedprice * 100) as bigint) as price from lineitem),
silver as (select * from (select *, row_number() over (partition by event_id
    order by l_shipdate desc, price desc) as place from raw
  where quantity > 0 and state in ('R', 'A', 'N')) where place = 1)"""


def flagged_sql(
    silver: str, entity: str, time: str, unit: str, total: str, rate: str, name: str
) -> str:
    return f"""with {silver},
spans as (select {entity}, date_trunc('{unit}', {time}) as {unit}, count(*) as {total},
    {rate} as {name} from silver group by 1, 2),
base as (select {entity}, {round2(f"avg({name})")} as mean,
    {round2(f"stddev_samp({name})")} as spread from spans group by 1)
select spans.{entity}, cast({unit} as timestamp) as {unit}, {name},
  round(mean + 2 * spread, 2) as anomaly_threshold_pct, {total}
from spans join base on spans.{entity} = base.{entity} where {name} > round(mean + 2 * spread, 2)"""


REFUND_RATE = """round(cast(sum(case when state = 'R' then 1 else 0 end) as bigint)
    / count(*) * 100, 2)"""


def all_oracles() -> dict[str, str]:
    return {
        "orders_quality": f"""with {ORDERS_SILVER},
counts as (select (select count(*) from raw) as total, (select count(*) from usable) as after_nulls,
    (select count(*) from valid) as after_validation, (select count(*) from silver) as after_dedup)
select total, after_nulls, after_validation, after_dedup, total - after_nulls as dropped_nulls,
  after_nulls - after_validation as dropped_invalid,
  after_validation - after_dedup as dropped_duplicates, total - after_dedup as dropped_total,
  round(after_dedup / nullif(total, 0) * 100, 1) as quality_score from counts""",
        "customer_order_spikes": flagged_sql(
            ORDERS_SILVER, "customer_id", "o_orderdate", "quarter", "orders",
            "cast(count(*) as double)", "order_volume",
        ),
        "part_refund_spikes": flagged_sql(
            LINES_SILVER, "part_id", "l_shipdate", "year", "lines", REFUND_RATE, "refund_rate_pct"
        ),
        "refund_rates_by_brand": f"""with {LINES_SILVER}
select p_brand, count(*) as lines,
  cast(sum(case when state = 'R' then 1 else 0 end) as bigint) as refunds,
  {REFUND_RATE} as refund_rate_pct
from silver join part on part_id = p_partkey group by p_brand""",
        "refunds_of_open_orders": """select l_orderkey, l_linenumber, l_partkey from lineitem
where l_returnflag = 'R' and not exists (
  select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')""",
        "customers_without_good_order": f"""with {ORDERS_SILVER}
select c_custkey, c_mktsegment from customer
where c_custkey not in (select customer_id from silver where state = 'F')""",
    }
