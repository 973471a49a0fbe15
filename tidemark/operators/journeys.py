"""Users on their way from the first page view to a purchase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The stages of a purchase in order.
STAGES = ("page_view", "add_to_cart", "checkout", "purchase")

# Events of one time follow each other as the log holds them.
ORDER = ("event_timestamp", "kafka_timestamp", "partition", "offset")


#: Seconds after which a cart that sees nothing more counts as left behind.
CART_WAIT = 3600

#: Seconds of a user's log that are walked in order at once, and then composed, and so on.
SPANS = (1, 3600)

# A stretch of a user's log is, for each stage that a user can enter it with (none to all),
# the stage reached at its end and the times of the stages reached inside. Such transitions
# compose, in whatever way a log is cut.
_NOTHING = f"transform(sequence(0, {len(STAGES)}), s -> struct(int(s) as reached, " \
    f"array_repeat(cast(null as timestamp), {len(STAGES)}) as times))"
_STEP = """transform(walked, way -> if(event.stage = way.reached + 1,
    struct(event.stage as reached, transform(way.times,
        (t, k) -> if(k = event.stage - 1, event.event_timestamp, t)) as times), way))"""
_COMPOSE = """transform(walked, way -> struct(part.ways[way.reached].reached as reached,
    zip_with(way.times, part.ways[way.reached].times, (a, b) -> coalesce(a, b)) as times))"""


def _time_of(stage: str) -> Column:
    return F.when(F.col("event_type") == stage, F.col("event_timestamp"))


def journeys(silver: DataFrame, spans: tuple[int, ...] = SPANS) -> DataFrame:
    """Per user, when each stage was reached in order, and how many stages were.

    A stage is reached by its first event after the one that reached the stage before
    it. Silver is read once. A user's log is cut into stretches of ``spans[0]`` seconds, whose
    events are sorted and walked through from every stage at once; stretches are composed
    within ``spans[1]`` seconds and so on, at last within the user. So a user with a third of
    all events is spread over tasks, and no list is longer than a second's events or the
    stretches of the span above. Events without a time reach nothing.
    """
    stage = F.when(
        F.col("event_timestamp").isNotNull(),
        F.array_position(F.array(*map(F.lit, STAGES)), F.col("event_type")).cast("int"),
    )
    event = F.when(stage > 0, F.struct(*ORDER, stage.alias("stage")))
    second = F.unix_seconds("event_timestamp")
    cut = [F.floor(second / span) for span in spans]
    names = [f"_cut_{span}" for span in spans]
    # Events that reach nothing only tell that there is such a user; they need no stretch.
    dealt = silver.select(
        "user_id",
        event.alias("_event"),
        *[F.when(stage > 0, own).alias(name) for own, name in zip(cut, names)],
    )
    ways = dealt.groupBy("user_id", *names).agg(
        F.expr(
            f"aggregate(sort_array(collect_list(_event)), {_NOTHING}, (walked, event) -> {_STEP})"
        ).alias("ways")
    )
    for place, order in enumerate(names):
        ways = ways.groupBy("user_id", *names[place + 1 :]).agg(
            F.expr(
                f"aggregate(sort_array(collect_list(struct({order}, ways))), {_NOTHING}, "
                f"(walked, part) -> {_COMPOSE})"
            ).alias("ways")
        )
    whole = F.col("ways")[0]
    times = [whole["times"][k].alias(f"{name}_at") for k, name in enumerate(STAGES)]
    return ways.select("user_id", *times, whole["reached"].alias("stages_reached"))


def expired_carts(silver: DataFrame, until: str, wait_seconds: int = CART_WAIT) -> DataFrame:
    """Carts that saw neither a purchase nor a further item within the wait: ``user_id, added_at``.

    A purchase at the moment of the item counts as one. ``until`` is the time up to which the
    log is known; carts whose wait ends later are undecided. A user's log is cut into
    stretches as long as the wait, each with the first event of the next as its context.
    """
    wait = F.make_dt_interval(secs=F.lit(wait_seconds))
    moments = (
        silver.where(F.col("event_timestamp").isNotNull())
        .where(F.col("event_type").isin("add_to_cart", "purchase"))
        .groupBy("user_id", F.col("event_timestamp").alias("at"))
        .agg(F.bool_or(F.col("event_type") == "purchase").alias("paid"))
        .withColumn("stretch", F.floor(F.unix_seconds("at") / wait_seconds))
    )
    own = Window.partitionBy("user_id", "stretch").orderBy("at")
    # A stretch's first event is copied into the stretch before, where it is the last.
    context = F.when(F.row_number().over(own) == 1, F.array("stretch", F.col("stretch") - 1))
    spread = moments.withColumn("_in", F.coalesce(context, F.array("stretch"))).select(
        "*", F.explode("_in").alias("_stretch")
    )
    order = Window.partitionBy("user_id", "_stretch").orderBy("at")
    following = spread.withColumn("_next", F.lead("at").over(order)).where("_stretch = stretch")
    left = F.col("_next").isNull() | (F.col("_next") > F.col("at") + wait)
    due = F.col("at") + wait <= F.lit(until).cast("timestamp")
    return following.where(~F.col("paid") & left & due).select(
        "user_id", F.col("at").alias("added_at")
    )


def funnel(silver: DataFrame) -> DataFrame:
    """One row: users seen, and users who got as far as each stage."""
    reached = [
        F.count_if(F.col("stages_reached") >= place).alias(f"{stage}_users")
        for place, stage in enumerate(STAGES, 1)
    ]
    return journeys(silver).agg(F.count("*").alias("users"), *reached)


def abandoned_carts(silver: DataFrame) -> DataFrame:
    """Users who put something into the cart and bought nothing since."""
    last = silver.groupBy("user_id").agg(
        F.max(_time_of("add_to_cart")).alias("last_add_to_cart"),
        F.max(_time_of("purchase")).alias("last_purchase"),
    )
    unpaid = F.col("last_purchase").isNull() | (
        F.col("last_purchase") < F.col("last_add_to_cart")
    )
    return last.where(F.col("last_add_to_cart").isNotNull() & unpaid)
