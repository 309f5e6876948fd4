"""Aggregation operators."""

from pyspark.sql import functions as F

from .. import roles
from ..functions import (
    any_flag,
    any_flag_nullable,
    bucketize,
    count_distinct_where,
    count_where,
    max_where,
    mean_of,
    n_rows,
    pct,
    round_to,
)
from ..operators import grouping as g
from ..operators.quantiles import percentiles, summary_stats
from ..oracle import rounded as R
from .registry import query


@query("agg_customer_tickets", "SELECT * FROM ticket_agg")
def _(t):
    return g.agg_customer(t("fact_tickets"), roles.AS_OF, events=t("dim_game"))


@query("agg_customer_promo", "SELECT * FROM promo_agg")
def _(t):
    return g.agg_customer_promo(t("bridge_promo"))


@query("agg_game_tickets", "SELECT * FROM event_agg")
def _(t):
    return g.agg_event(t("fact_tickets"))


@query("agg_game_promo", "SELECT * FROM event_promo")
def _(t):
    return g.agg_event_promo(t("bridge_promo"))


@query("agg_customer_timeline", "SELECT * FROM customer_timeline")
def _(t):
    return g.timeline(t("fact_tickets"))


@query("agg_second_purchase", "SELECT * FROM second_visit")
def _(t):
    return g.nth_visit(t("fact_tickets"), 2)


@query(
    "agg_bool_or",
    """SELECT customer_id, bool_or(coalesce(is_promo_ticket, FALSE)) AS ever_promo, bool_or(is_jersey_night_game) AS attended,
        bool_or(coalesce(seat_tier_rank >= 5, FALSE)) AS ever_premium, bool_or(seat_tier_rank >= 5) AS ever_premium_nullable
        FROM fact_tickets GROUP BY 1""",
)
def _(t):
    premium = F.col("seat_tier_rank") >= 5
    return t("fact_tickets").groupBy("customer_id").agg(
        any_flag("is_promo_ticket").alias("ever_promo"),
        any_flag_nullable("is_jersey_night_game").alias("attended"),
        any_flag(premium).alias("ever_premium"),
        any_flag_nullable(premium).alias("ever_premium_nullable"),
    )


@query(
    "agg_conditional_count",
    """SELECT game_id, count(*) FILTER (is_promo_ticket) AS promo, count(*) FILTER (seat_tier_rank >= 4) AS premium,
        count(*) FILTER (is_advance_purchase AND NOT is_promo_ticket) AS loyal FROM fact_tickets GROUP BY 1""",
)
def _(t):
    return t("fact_tickets").groupBy("game_id").agg(
        count_where("is_promo_ticket").alias("promo"),
        count_where(F.col("seat_tier_rank") >= 4).alias("premium"),
        count_where(F.col("is_advance_purchase") & ~F.col("is_promo_ticket")).alias("loyal"),
    )


@query(
    "agg_count_distinct_if",
    """SELECT season_phase, count(DISTINCT customer_id) FILTER (is_promo_ticket) AS promo_buyers,
        count(DISTINCT customer_id) FILTER (seat_tier_rank = 5) AS premium_buyers FROM fact_tickets GROUP BY 1""",
)
def _(t):
    return t("fact_tickets").groupBy("season_phase").agg(
        count_distinct_where("customer_id", "is_promo_ticket").alias("promo_buyers"),
        count_distinct_where("customer_id", F.col("seat_tier_rank") == 5).alias("premium_buyers"),
    )


@query(
    "agg_max_if",
    """SELECT section_tier, CAST(max(CASE WHEN is_jersey_night_game THEN ticket_price ELSE 0 END) AS DOUBLE) AS top_special,
        CAST(max(CASE WHEN is_promo_ticket THEN ticket_price ELSE 0 END) AS DOUBLE) AS top_promo FROM fact_tickets GROUP BY 1""",
)
def _(t):
    return t("fact_tickets").groupBy("section_tier").agg(
        max_where("ticket_price", "is_jersey_night_game").alias("top_special"),
        max_where("ticket_price", "is_promo_ticket").alias("top_promo"),
    )


@query(
    "agg_pct_rate",
    f"""SELECT purchase_channel, {R("count(*) FILTER (is_promo_ticket) * CAST(100 AS DOUBLE) / count(*)", 1)} AS promo_pct,
        {R("count(*) FILTER (is_advance_purchase) * CAST(100 AS DOUBLE) / count(*)", 1)} AS advance_pct FROM fact_tickets GROUP BY 1""",
)
def _(t):
    return t("fact_tickets").groupBy("purchase_channel").agg(
        pct("is_promo_ticket").alias("promo_pct"), pct("is_advance_purchase").alias("advance_pct")
    )


@query(
    "agg_mode",
    """SELECT customer_id, arg_min(purchase_channel, (-n, purchase_channel)) AS usual_channel
        FROM (SELECT customer_id, purchase_channel, count(*) AS n FROM fact_tickets GROUP BY ALL) GROUP BY 1""",
)
def _(t):
    return g.mode_by(t("fact_tickets"), ["customer_id"], "purchase_channel", "usual_channel")


CUTS = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


@query(
    "agg_percentile",
    "SELECT season_phase, " + ", ".join(f"{R(f'quantile_cont(CAST(ticket_price AS DOUBLE), {p})', 4)} AS {n}" for n, p in CUTS.items())
    + " FROM fact_tickets GROUP BY 1",
)
def _(t):
    cuts = percentiles(t("fact_tickets"), ["season_phase"], "ticket_price", CUTS)
    return cuts.select("season_phase", *[round_to(n, 4).alias(n) for n in CUTS])


STATS = ["ticket_price", "days_before_game", "seat_tier_rank"]


@query(
    "agg_summary_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n_values, {R(f"avg({c})", 4)} AS mean, {R(f"min({c})", 4)} AS min,
        {R(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", 4)} AS p25, {R(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", 4)} AS p75,
        {R(f"max({c})", 4)} AS max FROM fact_tickets"""
        for c in STATS
    ),
)
def _(t):
    stats = summary_stats(t("fact_tickets"), STATS)
    return stats.select(
        "column_name", "n_values",
        *[round_to(c, 4).alias(c) for c in ("mean", "min", "p25", "p75", "max")],
    )


@query(
    "agg_global_one_row",
    f"""SELECT count(*) AS tickets, count(DISTINCT customer_id) AS buyers, {R("sum(ticket_price)", 2)} AS revenue,
        {R("avg(ticket_price)", 2)} AS avg_price, {R("count(*) FILTER (is_promo_ticket) * CAST(100 AS DOUBLE) / count(*)", 1)} AS promo_pct
        FROM fact_tickets""",
)
def _(t):
    return g.kpi_row(
        t("fact_tickets"),
        {
            "tickets": n_rows(),
            "buyers": F.count_distinct("customer_id"),
            "revenue": round_to(F.sum("ticket_price"), 2),
            "avg_price": mean_of("ticket_price", 2),
            "promo_pct": pct("is_promo_ticket"),
        },
    )


@query(
    "agg_group_by_alias",
    f"""SELECT price_band, count(*) AS tickets, {R("avg(ticket_price)", 2)} AS avg_price FROM (
        SELECT *, CASE WHEN ticket_price < 100 THEN 'tiny' WHEN ticket_price < 20000 THEN 'low' WHEN ticket_price < 60000 THEN 'mid' ELSE 'top' END AS price_band
        FROM fact_tickets) GROUP BY 1""",
)
def _(t):
    band = bucketize("ticket_price", [100, 20000, 60000], ["tiny", "low", "mid", "top"])
    return g.group_by_expr(
        t("fact_tickets"), {"price_band": band},
        {"tickets": n_rows(), "avg_price": mean_of("ticket_price", 2)},
    )


@query(
    "agg_max_scalar",
    """SELECT game_id, game_date, CAST(date_diff('day', game_date, (SELECT max(game_date) FROM dim_game)) AS INTEGER) AS days_to_last
        FROM dim_game""",
)
def _(t):
    last = g.scalar_of(t("dim_game"), F.max("game_date"))
    return t("dim_game").select(
        "game_id", "game_date", F.datediff(last, F.col("game_date")).alias("days_to_last")
    )
