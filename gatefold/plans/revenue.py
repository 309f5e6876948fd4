"""Revenue operations datasets, from the event mart and the ticket fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import count_where, max_where, mean_of, n_rows, pct, phase_order, round_to, safe_ratio
from ..operators.ordering import order_by
from ..operators.windows import share_of_total



def _money(col: str) -> Column:
    return F.col(col).cast("decimal(18,4)")


def _total(col: str) -> Column:
    return F.sum(_money(col))


def _whole(col: str, alias: str | None = None) -> Column:
    return round_to(col, 0).alias(alias or col)


def _as_pct(col: str, alias: str) -> Column:
    return round_to(F.col(col) * 100, 1).alias(alias)


def rev_kpis(game_revenue: DataFrame) -> DataFrame:
    """Season totals in one row."""
    given, gross = _total("total_discount_given"), _total("gross_revenue")
    return game_revenue.agg(
        round_to(gross, 0).alias("total_gross_revenue"),
        round_to(_total("net_revenue"), 0).alias("total_net_revenue"),
        round_to(given, 0).alias("total_discounts_given"),
        round_to(safe_ratio(given, gross) * 100.0, 1).alias("discount_as_pct_of_gross"),
        mean_of("arena_fill_pct", 1, scale=100).alias("avg_fill_rate_pct"),
        round_to(max_where("gross_revenue", "is_jersey_night"), 0).alias("jersey_night_revenue"),
        n_rows().alias("total_games"),
        count_where(F.col("arena_fill_pct") >= 0.99).alias("sellouts"),
    )


def rev_by_game(game_revenue: DataFrame) -> DataFrame:
    """Trend over home events."""
    trend = game_revenue.filter(F.col("is_home_game")).select(
        "game_number", "game_date", "opponent", "season_phase", "is_jersey_night",
        _whole("gross_revenue"), _whole("net_revenue"),
        _whole("total_discount_given", "discounts_given"),
        _as_pct("arena_fill_pct", "fill_rate_pct"),
        round_to("revenue_index", 3).alias("revenue_index"),
        _whole("cumulative_revenue"),
        "result",
    )
    return order_by(trend, ["game_number"])


def rev_fill_trend(game_revenue: DataFrame, threshold: float = 60.0) -> DataFrame:
    """Fill rate, its moving average and a constant alert line."""
    trend = game_revenue.filter(F.col("is_home_game")).select(
        "game_number", "game_date", "season_phase", "is_jersey_night",
        _as_pct("arena_fill_pct", "fill_rate_pct"),
        _as_pct("fill_rate_3game_avg", "fill_rate_3game_avg_pct"),
        F.lit(threshold).alias("alert_threshold_pct"),
    )
    return order_by(trend, ["game_number"])


def _home_by_phase(game_revenue: DataFrame, *aggs: Column) -> DataFrame:
    grouped = game_revenue.filter(F.col("is_home_game")).groupBy("season_phase").agg(n_rows().alias("games"), *aggs)
    return order_by(
        grouped.withColumn("phase_order", phase_order("season_phase")), ["phase_order"]
    )


def rev_by_phase(game_revenue: DataFrame) -> DataFrame:
    """Home revenue per season phase."""
    return _home_by_phase(
        game_revenue,
        round_to(_total("gross_revenue"), 0).alias("total_gross_revenue"),
        round_to(_total("net_revenue"), 0).alias("total_net_revenue"),
        round_to(_total("total_discount_given"), 0).alias("total_discounts"),
        mean_of(_money("gross_revenue"), 0).alias("avg_revenue_per_game"),
        mean_of("arena_fill_pct", 1, scale=100).alias("avg_fill_rate_pct"),
        mean_of("promo_rate", 1, scale=100).alias("avg_promo_rate_pct"),
    )


def rev_promo_impact(game_revenue: DataFrame) -> DataFrame:
    """What promotions cost per phase and what full price would have brought."""
    gross, given = _total("gross_revenue"), _total("total_discount_given")
    return _home_by_phase(
        game_revenue,
        F.sum("promo_tickets").alias("total_promo_tickets"),
        mean_of("promo_rate", 1, scale=100).alias("avg_promo_rate_pct"),
        round_to(given, 0).alias("total_discount_cost"),
        mean_of("avg_discount_pct", 1).alias("avg_discount_depth_pct"),
        round_to(gross, 0).alias("actual_gross_revenue"),
        round_to(gross + given, 0).alias("full_price_revenue_estimate"),
    )


def rev_top_games(game_revenue: DataFrame) -> DataFrame:
    """Home events, best revenue first."""
    listed = order_by(game_revenue.filter(F.col("is_home_game")), [F.col("gross_revenue").desc_nulls_last()])
    return listed.select(
        "game_number", "game_date", "opponent", "season_phase", "is_jersey_night", "result",
        _whole("gross_revenue"), _whole("net_revenue"),
        _as_pct("arena_fill_pct", "fill_rate_pct"),
        _as_pct("promo_rate", "promo_rate_pct"),
        round_to("revenue_index", 2).alias("revenue_index"),
    )


def rev_section_tier(fact: DataFrame) -> DataFrame:
    """Revenue, price and promotion use per seat section, with share of all revenue."""
    sections = share_of_total(
        fact, ["section_tier", "seat_tier_rank"], F.sum("ticket_price"), "pct_of_total_revenue",
        [
            n_rows().alias("tickets_sold"),
            round_to(F.sum("ticket_price"), 0).alias("total_revenue"),
            mean_of("ticket_price", 2).alias("avg_ticket_price"),
            pct("is_promo_ticket").alias("promo_rate_pct"),
        ],
        few_groups=True,
    )
    return order_by(sections, [F.col("seat_tier_rank").desc_nulls_last()])


def rev_advance_vs_walkup(fact: DataFrame) -> DataFrame:
    """Advance purchases against walk-ups."""
    grouped = fact.groupBy("is_advance_purchase").agg(
        n_rows().alias("tickets"),
        mean_of("ticket_price", 2).alias("avg_ticket_price"),
        round_to(F.sum("ticket_price"), 0).alias("total_revenue"),
        pct("is_promo_ticket").alias("promo_rate_pct"),
        mean_of("days_before_game", 1).alias("avg_days_before_game"),
    )
    timing = F.when(F.col("is_advance_purchase"), F.lit("Advance (>3 days out)")).otherwise(
        F.lit("Walk-up / Day-of")
    )
    named = grouped.select(timing.alias("purchase_timing"), *grouped.columns[1:])
    return order_by(named, ["-avg_ticket_price"])
