"""Aggregations by customer, event and arbitrary keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import any_flag, any_flag_nullable, count_where, mean_of
from ..functions.expressions import days_between, is_true, round_to
from .joins import HEAVY_ROWS, HEAVY_SHARE

# One row of this many is looked at to find heavy keys, which decides on tasks and never on results.
LOOK_AT = 16


def _packed(conds: Mapping[str, Column]) -> Column:
    """The conditions as bits of one int, NULL as false: narrower in an exchange than a column each."""
    bits = [F.when(is_true(cond), F.lit(1 << i)).otherwise(F.lit(0)) for i, cond in enumerate(conds.values())]
    return reduce(Column.__add__, bits).alias("_bits")


def _unpacked(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    return rows.withColumns({
        name: F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0 for i, name in enumerate(names)
    }).drop("_bits")


def per_key(
    rows: DataFrame, key: str, measure: Callable[[DataFrame], DataFrame], heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """``measure(rows)``, an aggregation by ``key`` (and more), with one exchange of the rows as they are.

    Where hardly any rows share their grouping, combining them map-side only makes them wider. Rows are
    dealt by ``key`` first, and every grouping by it and more columns then happens in place. The keys above
    ``heavy_rows``, at most ``1 / HEAVY_SHARE`` of them, are measured beside it with map-side combination,
    so that none gathers its rows in one task. NULL is a key like any other.
    """
    looked = rows.select(key).sample(1 / LOOK_AT, seed=7).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    found = looked.where(F.col("_n") > heavy_rows / LOOK_AT).orderBy(F.desc("_n")).limit(round(1 / HEAVY_SHARE))
    heavy = [r[0] for r in found.collect()]
    if not heavy:
        return measure(rows.repartition(key))
    among = [F.coalesce(F.col(key).isin([k for k in heavy if k is not None]), F.lit(False))]
    apart = reduce(Column.__or__, among + [F.col(key).isNull()] * (None in heavy))
    return measure(rows.where(~apart).repartition(key)).unionByName(measure(rows.where(apart)))


def mode_by(df: DataFrame, by: Sequence[str], col: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per group, ties to the smallest value.

    Counting per (group, value) first keeps a hot group spread over tasks and lets the
    counts combine map-side; only one row per distinct value reaches the group.
    """
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(*by, col)
        .agg((-F.count(F.lit(1))).alias("_neg"))
    )
    best = counts.groupBy(*by).agg(F.min(F.struct("_neg", col)).alias("_best"))
    return best.select(*by, F.col(f"_best.{col}").alias(name))


def distinct_count_by(df: DataFrame, by: str, col: str, name: str) -> DataFrame:
    """Distinct non-NULL values per group.

    Only the two columns are shuffled, spread by (group, value). Inside a wide aggregation a
    distinct count would drag every measure's buffer through that same shuffle.
    """
    pairs = df.select(by, col).distinct()
    return pairs.groupBy(by).agg(F.count(col).alias(name))


def agg_customer(
    fact: DataFrame, as_of: Column | str, key: str = "customer_id", events: DataFrame | None = None
) -> DataFrame:
    """Ticket behaviour per customer (18 measures) from one pass over the fact.

    Each ticket counts once for its event, which carries the measures, and once each for its channel and
    section. A first hash aggregation leaves one row per customer and value; a second one per customer adds
    up the measures, counts the events and channels and picks the commonest section. Nothing is sorted, the
    tickets are exchanged once (:func:`per_key`), and a hot customer is spread over tasks until its values
    are single rows. With ``events`` the phase is that of the event, else the ticket's own.
    """
    reference = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    if events is not None:
        phases = events.select("game_id", F.col("season_phase").alias("_phase")).dropDuplicates(["game_id"])
        fact = fact.join(phases, "game_id", "left").drop("season_phase").withColumnRenamed("_phase", "season_phase")
    phase_flags = {f"{p}_buyer": F.col("season_phase") == p for p in ("hot_start", "slump", "late_push")}
    flags = {
        "jersey_night_attendee": F.col("is_jersey_night_game"), "was_lapsed_reactivation": F.col("is_lapsed_reactivation"),
        **phase_flags,
    }
    bits = {
        "known": F.col("ticket_id").isNotNull(), "promo": F.col("is_promo_ticket"), "advance": F.col("is_advance_purchase"),
        **flags,
    }
    tickets = fact.select(
        key, "game_id", "purchase_channel", "section_tier", "ticket_price", "game_date", "days_before_game", "seat_tier_rank",
        _packed(bits),
    )
    return per_key(tickets, key, lambda rows: _customer_measures(_unpacked(rows, bits), key, list(flags), reference))


def _customer_measures(tickets: DataFrame, key: str, flags: Sequence[str], reference: Column) -> DataFrame:
    event, channel, section = 0, 1, 2
    counted = [(event, "game_id"), (channel, "purchase_channel"), (section, "section_tier")]
    kinds = F.array(*[
        F.struct(F.lit(kind).alias("_kind"), F.col(value).cast("string").alias("_value")) for kind, value in counted
    ])
    once = F.col("_kind") == event

    def own(column: str) -> Column:
        return F.when(once, F.col(column))

    values = tickets.select("*", F.inline(kinds)).groupBy(key, "_kind", "_value").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(own("ticket_price")).alias("spend"), F.count(own("ticket_price")).alias("priced"),
        F.max(own("ticket_price")).alias("top_price"), count_where(own("known")).alias("tickets"),
        F.max(own("game_date")).alias("last_date"),
        count_where(own("promo")).alias("promo"), count_where(own("advance")).alias("advance"),
        F.sum(own("days_before_game")).alias("lead_days"), F.count(own("days_before_game")).alias("lead_rows"),
        F.sum(own("seat_tier_rank")).alias("ranks"), F.count(own("seat_tier_rank")).alias("ranked"),
        *[F.bool_or(name).alias(name) for name in flags],
    )

    def ratio(total: str, count: str, digits: int) -> Column:
        return round_to(F.sum(total).cast("double") / F.nullif(F.sum(count), F.lit(0)), digits)

    def known(kind: int) -> Column:
        return (F.col("_kind") == kind) & F.col("_value").isNotNull()

    rows = F.sum(F.when(once, F.col("_rows")))
    commonest = F.min(F.when(known(section), F.struct((-F.col("_rows")).alias("n"), F.col("_value").alias("section"))))
    summed = values.groupBy(key).agg(
        round_to(F.sum("spend"), 2).alias("total_spend"),
        ratio("spend", "priced", 2).alias("avg_ticket_price"),
        round_to(F.max("top_price"), 2).alias("max_ticket_price"),
        F.sum("tickets").alias("total_tickets"),
        days_between(reference, F.max("last_date")).alias("days_since_last"),
        F.sum("promo").alias("promo_tickets"),
        round_to(F.sum("promo").cast("double") / F.nullif(rows, F.lit(0)), 4).alias("promo_rate"),
        F.sum("advance").alias("advance_purchases"),
        ratio("lead_days", "lead_rows", 1).alias("avg_days_before_game"),
        ratio("ranks", "ranked", 2).alias("avg_seat_tier_rank"),
        *[F.bool_or(name).alias(name) for name in flags],
        F.count_if(known(event)).alias("games_attended"),
        F.count_if(known(channel)).alias("channels_used"),
        commonest.alias("_commonest"),
    )
    return summed.withColumn("preferred_section", F.col("_commonest.section")).drop("_commonest")


# Columns of :func:`customer_measures` that stand for one of the two aggregations it does together.
CUSTOMER_MEASURES = [
    "total_spend", "avg_ticket_price", "max_ticket_price", "total_tickets", "days_since_last", "promo_tickets", "promo_rate",
    "advance_purchases", "avg_days_before_game", "avg_seat_tier_rank", "jersey_night_attendee", "was_lapsed_reactivation",
    "hot_start_buyer", "slump_buyer", "late_push_buyer", "games_attended", "channels_used", "preferred_section",
]
HISTORY_MEASURES = [
    "acquisition_phase", "first_purchase_date", "last_purchase_date", "total_games", "total_spend", "attended_jersey_night",
    "ever_used_promo", "overall_promo_rate", "second_purchase_date",
]


def customer_measures(
    fact: DataFrame, as_of: Column | str, key: str = "customer_id", events: DataFrame | None = None
) -> DataFrame:
    """:func:`agg_customer` and :func:`visit_history` side by side, for tables that store both.

    Visits, the tickets of a customer, event and phase, carry every measure and are reduced once for both;
    the flags of a visit are one number. Channels and sections are counted in narrow rows of their own. A
    customer's events and visit dates are gathered as sets, which the number of events bounds. Tickets
    without a key have no row.
    """
    reference = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    fact = fact.where(F.col(key).isNotNull())
    tagged = fact.withColumn("_of_event", F.col("season_phase"))
    if events is not None:
        phases = events.select("game_id", F.col("season_phase").alias("_of_event")).dropDuplicates(["game_id"])
        tagged = fact.join(phases, "game_id", "left")
    bits = {
        "jersey_night_attendee": F.col("is_jersey_night_game"), "was_lapsed_reactivation": F.col("is_lapsed_reactivation"),
        **{f"{p}_buyer": F.col("_of_event") == p for p in ("hot_start", "slump", "late_push")},
        "known": F.col("ticket_id").isNotNull(), "promo": F.col("is_promo_ticket"), "advance": F.col("is_advance_purchase"),
        "jersey_known": F.col("is_jersey_night_game").isNotNull(), "promo_known": F.col("is_promo_ticket").isNotNull(),
    }
    at = {name: 1 << i for i, name in enumerate(bits)}
    tickets = tagged.select(
        key, "game_id", "season_phase", "ticket_price", F.col("game_date").cast("date").alias("game_date"),
        "days_before_game", "seat_tier_rank", _packed(bits),
    )

    def has(name: str) -> Column:
        return F.col("_bits").bitwiseAND(F.lit(at[name])) != 0

    def measured(rows: DataFrame) -> DataFrame:
        seen = rows.groupBy(key, "game_id", "season_phase").agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("ticket_price").alias("spend"), F.count("ticket_price").alias("priced"),
            F.max("ticket_price").alias("top_price"),
            F.min("game_date").alias("first_date"), F.max("game_date").alias("last_date"),
            count_where(has("known")).alias("tickets"), count_where(has("promo")).alias("promo"),
            count_where(has("advance")).alias("advance"),
            F.sum("days_before_game").alias("lead_days"), F.count("days_before_game").alias("lead_rows"),
            F.sum("seat_tier_rank").alias("ranks"), F.count("seat_tier_rank").alias("ranked"),
            F.bit_or("_bits").alias("_bits"),
        )

        def ratio(total: str, count: str, digits: int) -> Column:
            return round_to(F.sum(total).cast("double") / F.nullif(F.sum(count), F.lit(0)), digits)

        entered = F.when(F.col("season_phase").isNotNull(), F.struct("first_date", "game_id"))
        summed = seen.groupBy(key).agg(
            round_to(F.sum("spend"), 2).alias("total_spend"),
            ratio("spend", "priced", 2).alias("avg_ticket_price"),
            round_to(F.max("top_price"), 2).alias("max_ticket_price"),
            F.sum("tickets").alias("total_tickets"),
            F.sum("promo").alias("promo_tickets"),
            ratio("promo", "rows", 4).alias("promo_rate"),
            ratio("promo", "tickets", 4).alias("overall_promo_rate"),
            F.sum("advance").alias("advance_purchases"),
            ratio("lead_days", "lead_rows", 1).alias("avg_days_before_game"),
            ratio("ranks", "ranked", 2).alias("avg_seat_tier_rank"),
            F.bit_or("_bits").alias("_bits"),
            F.max("last_date").alias("last_purchase_date"),
            F.size(F.collect_set("game_id")).cast("bigint").alias("games_attended"),
            F.array_sort(F.collect_set("first_date")).alias("_dates"),
            F.min_by("season_phase", entered).alias("acquisition_phase"),
        )
        flags = ["jersey_night_attendee", "was_lapsed_reactivation", "hot_start_buyer", "slump_buyer", "late_push_buyer"]
        return summed.withColumns({
            "days_since_last": days_between(reference, F.col("last_purchase_date")),
            "total_games": F.col("games_attended"),
            "first_purchase_date": F.get("_dates", F.lit(0)), "second_purchase_date": F.get("_dates", F.lit(1)),
            **{name: has(name) for name in flags},
            "attended_jersey_night": F.when(has("jersey_known"), has("jersey_night_attendee")),
            "ever_used_promo": F.when(has("promo_known"), has("promo")),
        }).drop("_bits", "_dates")

    channel, section = 0, 1
    kinds = F.array(*[
        F.struct(F.lit(kind).alias("_kind"), F.col(value).cast("string").alias("_value"))
        for kind, value in ((channel, "purchase_channel"), (section, "section_tier"))
    ])

    def counted(rows: DataFrame) -> DataFrame:
        values = rows.select(key, F.inline(kinds)).groupBy(key, "_kind", "_value").agg(F.count(F.lit(1)).alias("n"))
        known = F.col("_value").isNotNull()
        commonest = F.min(F.when(known & (F.col("_kind") == section), F.struct((-F.col("n")).alias("n"), F.col("_value").alias("section"))))
        summed = values.groupBy(key).agg(
            F.count_if(known & (F.col("_kind") == channel)).alias("channels_used"), commonest.alias("_commonest")
        )
        return summed.withColumn("preferred_section", F.col("_commonest.section")).drop("_commonest")

    picked = fact.select(key, "purchase_channel", "section_tier")
    both = per_key(tickets, key, measured).join(per_key(picked, key, counted), key)
    return both.select(key, *dict.fromkeys([*CUSTOMER_MEASURES, *HISTORY_MEASURES]))


def agg_customer_promo(promo: DataFrame, key: str = "customer_id") -> DataFrame:
    """Redeemed promotions per customer: total, mean impact, usual depth."""
    sums = promo.groupBy(key).agg(
        round_to(F.sum("discount_amount"), 2).alias("total_discount_received"),
        mean_of("promo_impact_score", 2).alias("avg_promo_impact_score"),
    )
    return sums.join(mode_by(promo, [key], "discount_tier", "most_common_discount_tier"), key, "left")


def agg_event(fact: DataFrame, key: str = "game_id", premium_rank: int = 4) -> DataFrame:
    """Ticket sales per event (13 measures) from one pass: tickets are dealt by customer and reduced to
    one row per event and customer, whose number is the number of buyers; those rows are added up map-side."""
    bits = {
        "known": F.col("ticket_id").isNotNull(), "promo": F.col("is_promo_ticket"), "advance": F.col("is_advance_purchase"),
        "lapsed": F.col("is_lapsed_reactivation"), "premium": F.col("seat_tier_rank") >= premium_rank,
    }
    tickets = fact.select(key, "customer_id", "ticket_price", "days_before_game", _packed(bits))

    def bought(rows: DataFrame) -> DataFrame:
        return _unpacked(rows, bits).groupBy(key, "customer_id").agg(
            F.sum("ticket_price").alias("spend"), F.count("ticket_price").alias("priced"),
            F.max("ticket_price").alias("top_price"), F.min("ticket_price").alias("low_price"),
            count_where("known").alias("tickets"), F.count(F.lit(1)).alias("rows"),
            count_where("promo").alias("promo"),
            F.sum("days_before_game").alias("lead_days"), F.count("days_before_game").alias("lead_rows"),
            count_where("advance").alias("advance"),
            F.bool_or("lapsed").alias("lapsed"),
            count_where("lapsed").alias("lapsed_rows"),
            count_where("premium").alias("premium"),
        )

    buyers = per_key(tickets, "customer_id", bought)

    def ratio(total: str, count: str, digits: int) -> Column:
        return round_to(F.sum(total).cast("double") / F.nullif(F.sum(count), F.lit(0)), digits)

    return buyers.groupBy(key).agg(
        round_to(F.sum("spend"), 2).alias("gross_revenue"),
        ratio("spend", "priced", 2).alias("avg_ticket_price"),
        round_to(F.max("top_price"), 2).alias("max_ticket_price"),
        round_to(F.min("low_price"), 2).alias("min_ticket_price"),
        F.sum("tickets").alias("tickets_sold"),
        F.sum("promo").alias("promo_tickets"),
        ratio("promo", "rows", 4).alias("promo_rate"),
        ratio("lead_days", "lead_rows", 1).alias("avg_days_before_game"),
        F.sum("advance").alias("advance_purchase_count"),
        F.bool_or("lapsed").alias("had_lapsed_reactivation"),
        F.sum("lapsed_rows").alias("lapsed_reactivation_count"),
        ratio("premium", "rows", 4).alias("premium_seat_rate"),
        F.count("customer_id").alias("unique_buyers"),
    )


def agg_event_promo(promo: DataFrame, key: str = "game_id") -> DataFrame:
    """Redeemed promotions per event."""
    return promo.groupBy(key).agg(
        round_to(F.sum("discount_amount"), 2).alias("total_discount_given"),
        mean_of("discount_pct", 1, scale=100).alias("avg_discount_pct"),
        count_where(F.col("discount_tier") == "deep").alias("deep_discount_count"),
    )


def visits(fact: DataFrame, key: str = "customer_id") -> DataFrame:
    """Tickets reduced to one row per customer, event and phase.

    Fixed-width measures only, so this runs as a code-generated hash aggregate with map-side
    combine, and a customer with very many tickets is spread over events.
    """
    return fact.groupBy(key, "game_id", "season_phase").agg(
        F.min(F.col("game_date").cast("date")).alias("game_date"),
        F.max(F.col("game_date").cast("date")).alias("last_date"),
        F.sum("ticket_price").alias("spend"),
        F.count("ticket_id").alias("tickets"),
        count_where("is_promo_ticket").alias("promo_tickets"),
        any_flag_nullable("is_jersey_night_game").alias("jersey"),
        any_flag_nullable("is_promo_ticket").alias("promo"),
    )


def visit_history(fact: DataFrame, key: str = "customer_id") -> DataFrame:
    """Timeline and second visit date per customer in one pass over the fact.

    The window runs over visits, so a customer contributes at most one row per event and
    phase however many tickets they hold; the tickets are exchanged once (:func:`per_key`) and
    visits, window and aggregation happen in place. The entry phase is that of the earliest event
    (then smallest event id) and becomes a grouping key, which keeps every aggregation buffer fixed-width.
    """
    used = ["game_id", "season_phase", "game_date", "ticket_price", "is_promo_ticket", "is_jersey_night_game"]
    tickets = fact.select(key, *used, F.when(F.col("ticket_id").isNotNull(), F.lit(1)).alias("ticket_id"))
    return per_key(tickets, key, lambda rows: _history(rows, key))


def _history(tickets: DataFrame, key: str) -> DataFrame:
    whole = (
        Window.partitionBy(key)
        .orderBy("game_date", "game_id")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    seen = visits(tickets, key).withColumns(
        {
            "acquisition_phase": F.first("season_phase", ignorenulls=True).over(whole),
            "_first": F.min("game_date").over(whole),
        }
    )
    promo_share = F.sum("promo_tickets").cast("double") / F.nullif(F.sum("tickets"), F.lit(0))
    later = F.when(F.col("game_date") > F.col("_first"), F.col("game_date"))
    return seen.groupBy(key, "acquisition_phase").agg(
        F.min("game_date").alias("first_purchase_date"),
        F.max("last_date").alias("last_purchase_date"),
        F.count_distinct("game_id").alias("total_games"),
        round_to(F.sum("spend"), 2).alias("total_spend"),
        F.bool_or("jersey").alias("attended_jersey_night"),
        F.bool_or("promo").alias("ever_used_promo"),
        round_to(promo_share, 4).alias("overall_promo_rate"),
        F.min(later).alias("second_purchase_date"),
    )


def timeline(fact: DataFrame, key: str = "customer_id") -> DataFrame:
    """First and last visit, spend, entry phase and promo use per customer."""
    return visit_history(fact, key).drop("second_purchase_date")


def nth_visit(
    fact: DataFrame, n: int = 2, key: str = "customer_id", date: str = "game_date",
    name: str = "second_purchase_date",
) -> DataFrame:
    """Date of the n-th distinct visit date; customers with fewer visits are absent.

    Dates are made distinct first and the rank filter is pushed below the shuffle as a
    window group limit, so at most n dates per customer leave each map task.
    """
    dates = fact.select(key, F.col(date).cast("date").alias(name)).distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy(name))
    return (
        dates.filter(F.col(name).isNotNull())
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= n)
        .filter(F.col("_rank") == n)
        .drop("_rank")
    )


def kpi_row(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Ungrouped one-row scorecard."""
    return df.agg(*[e.alias(n) for n, e in exprs.items()])


def group_by_expr(
    df: DataFrame, by: Mapping[str, Column], aggs: Mapping[str, Column]
) -> DataFrame:
    """GROUP BY computed aliases."""
    return (
        df.withColumns(dict(by)).groupBy(*by).agg(*[e.alias(n) for n, e in aggs.items()])
    )


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), col)


def scalar_of(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate as a scalar subquery usable in any expression."""
    return df.agg(expr.alias("value")).scalar()
