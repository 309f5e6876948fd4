"""Projections, derived columns and scalar expressions, over whole tables."""

from pyspark.sql import functions as F

from .. import roles
from ..functions import (
    assign_phase,
    bucketize,
    flag_to_int,
    map_values,
    null_if,
    phase_order,
    promo_sensitivity,
    recommended_action,
    risk_tier,
    round_to,
    safe_ratio,
)
from ..oracle import rounded as R
from ..plans import silver
from ..plans.gold import fill_defaults
from ..plans.segments import ATTENDANCE_EDGES, ATTENDANCE_LABELS, MODEL_CARD
from .registry import query


@query(
    "proj_clean_customer",
    "SELECT customer_id, full_name, email, tenure_days, record_source FROM dim_customer",
)
def _(t):
    """Both sources, cleaned alike and labelled."""
    cleaned = silver.clean_customer(t("raw_customers"), "seed", roles.AS_OF).unionByName(
        silver.clean_customer(t("raw_customers_stream"), "simulator", roles.AS_OF)
    )
    kept = cleaned.filter(F.col("email").isNotNull() & F.col("customer_id").isNotNull())
    return kept.select("customer_id", "full_name", "email", "tenure_days", "record_source")


@query(
    "proj_enrich_ticket",
    """SELECT ticket_id, customer_id, section_tier, seat_tier_rank, seat_row, seat_number, days_before_game, is_advance_purchase
        FROM fact_all""",
)
def _(t):
    rows = silver.enrich_ticket(t("raw_tickets_all"), roles.TIER_RANKS)
    return rows.select(
        "ticket_id", "customer_id", "section_tier", "seat_tier_rank", "seat_row", "seat_number",
        "days_before_game", "is_advance_purchase",
    )


@query(
    "proj_dim_game",
    "SELECT game_id, result_numeric, arena_fill_pct, is_playoff_relevant, wins_to_date FROM dim_game",
)
def _(t):
    rows = silver.build_dim_game(t("raw_events"))
    return rows.select("game_id", "result_numeric", "arena_fill_pct", "is_playoff_relevant", "wins_to_date")


@query(
    "proj_bridge_promo",
    "SELECT promo_id, discount_pct, face_value, discount_amount, promo_impact_score, discount_tier FROM bridge_promo",
)
def _(t):
    rows = silver.build_bridge_promo(t("raw_promotions"), roles.DEEP, roles.MODERATE)
    return rows.select(
        "promo_id", "discount_pct", "face_value", "discount_amount", "promo_impact_score", "discount_tier"
    )


@query(
    "proj_phase_of_event",
    """SELECT o_orderkey, n AS event_number, coalesce(phase, 'bridge') AS season_phase
        FROM (SELECT o_orderkey, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS BIGINT) AS n FROM orders)
        LEFT JOIN (VALUES ('hot_start', 1, 22), ('slump', 23, 52), ('late_push', 53, 72), ('jersey_night', 77, 77), ('post_jersey', 78, 82))
          AS p(phase, lo, hi) ON n BETWEEN lo AND hi""",
)
def _(t):
    date = F.col("o_orderdate")
    number = ((F.year(date) - 1995) * 12 + F.month(date)).cast("bigint")
    numbered = t.source("orders").select("o_orderkey", number.alias("event_number"))
    return numbered.withColumn("season_phase", assign_phase("event_number", silver.SEASON_PHASES))


@query(
    "proj_case_bucket",
    """SELECT customer_id,
        CASE WHEN games_attended <= 0 THEN '0 games' WHEN games_attended <= 1 THEN '1 game' WHEN games_attended <= 3 THEN '2–3 games'
             WHEN games_attended <= 5 THEN '4–5 games' WHEN games_attended <= 10 THEN '6–10 games' WHEN games_attended <= 20 THEN '11–20 games' ELSE '21+ games' END AS attendance_bucket,
        CASE WHEN promo_rate < CAST(0.3 AS DOUBLE) THEN 0 WHEN promo_rate < CAST(0.5 AS DOUBLE) THEN 1 ELSE 2 END AS promo_bucket
        FROM customer_360""",
)
def _(t):
    return t("customer_360").select(
        "customer_id",
        bucketize("games_attended", ATTENDANCE_EDGES, ATTENDANCE_LABELS, closed="right").alias("attendance_bucket"),
        bucketize("promo_rate", [0.3, 0.5], [0, 1, 2]).alias("promo_bucket"),
    )


@query(
    "proj_case_simple",
    """SELECT customer_id, segment_label,
        CASE segment_label WHEN 'Season Core' THEN 'keep' WHEN 'Lapsed' THEN 'win back' ELSE 'grow' END AS goal,
        CASE acquisition_phase WHEN 'hot_start' THEN 1 WHEN 'slump' THEN 2 WHEN 'late_push' THEN 3 WHEN 'bridge' THEN 4
             WHEN 'jersey_night' THEN 5 WHEN 'post_jersey' THEN 6 ELSE 7 END AS phase_order
        FROM ml_fan_segments LEFT JOIN retention_cohort USING (customer_id)""",
)
def _(t):
    fans = t("ml_fan_segments").select("customer_id", "segment_label").join(
        t("retention_cohort").select("customer_id", "acquisition_phase"), "customer_id", "left"
    )
    return fans.select(
        "customer_id", "segment_label",
        map_values("segment_label", {"Season Core": "keep", "Lapsed": "win back"}, "grow").alias("goal"),
        phase_order("acquisition_phase").alias("phase_order"),
    )


@query(
    "proj_rule_action",
    """SELECT customer_id, CASE WHEN promo_sensitivity > 0.5 THEN 'Offer discount' WHEN games_attended > 5 THEN 'Loyalty reward'
        ELSE 'Re-engagement email' END AS recommended_action FROM customer_360""",
)
def _(t):
    action = recommended_action("promo_sensitivity", "games_attended")
    return t("customer_360").select("customer_id", action.alias("recommended_action"))


def _tiers(op, low, high):
    return f"CASE WHEN churn_probability {op} CAST({low} AS DOUBLE) THEN 'Low' WHEN churn_probability {op} CAST({high} AS DOUBLE) THEN 'Medium' ELSE 'High' END"


@query(
    "proj_risk_tier",
    f"""SELECT customer_id, {_tiers("<=", 0.4, 0.7)} AS tier, {_tiers("<", 0.4, 0.7)} AS tier_left_closed,
        {_tiers("<=", 0.5, 0.6)} AS tier_narrow FROM ml_churn_scores""",
)
def _(t):
    p = "churn_probability"
    return t("ml_churn_scores").select(
        "customer_id",
        risk_tier(p).alias("tier"),
        risk_tier(p, right_closed=False).alias("tier_left_closed"),
        risk_tier(p, low=0.5, high=0.6).alias("tier_narrow"),
    )


@query("proj_promo_sensitivity", "SELECT customer_id, promo_sensitivity FROM customer_360")
def _(t):
    value = promo_sensitivity("promo_rate", "most_common_discount_tier")
    return t("customer_360").select("customer_id", value.alias("promo_sensitivity"))


@query(
    "proj_null_defaults",
    """SELECT customer_id, coalesce(total_spend, 0) AS total_spend, coalesce(avg_seat_tier_rank, 3) AS avg_seat_tier_rank,
        coalesce(preferred_section, 'none') AS preferred_section, coalesce(jersey_night_attendee, FALSE) AS jersey_night_attendee
        FROM customer_360""",
)
def _(t):
    defaults = {
        "total_spend": 0.0, "avg_seat_tier_rank": 3.0, "preferred_section": "none",
        "jersey_night_attendee": False,
    }
    return fill_defaults(t("customer_360").select("customer_id", *defaults), defaults)


@query(
    "proj_safe_ratio",
    f"""SELECT customer_id, {R("CAST(coalesce(advance_purchases, 0) AS DOUBLE) / greatest(coalesce(total_tickets, 1), 1)", 4)} AS advance_rate,
        {R("total_discount_received / nullif(CAST(promo_tickets AS DOUBLE), 0)", 4)} AS discount_per_promo,
        nullif(promo_tickets, 0) AS promo_tickets_or_null FROM customer_360""",
)
def _(t):
    return t("customer_360").select(
        "customer_id",
        round_to(safe_ratio("advance_purchases", "total_tickets", floor=1), 4).alias("advance_rate"),
        round_to(safe_ratio("total_discount_received", "promo_tickets"), 4).alias("discount_per_promo"),
        null_if("promo_tickets", 0).alias("promo_tickets_or_null"),
    )


@query(
    "proj_flags_to_int",
    """SELECT customer_id, CAST(is_season_holder AS INTEGER) AS is_season_holder, CAST(jersey_night_attendee AS INTEGER) AS jersey_night_attendee
        FROM customer_360""",
)
def _(t):
    flags = ["is_season_holder", "jersey_night_attendee"]
    return t("customer_360").select("customer_id", *[flag_to_int(c).alias(c) for c in flags])


@query(
    "proj_constant",
    """SELECT game_id, arena_fill_pct, CAST(60 AS DOUBLE) AS alert_threshold_pct, 'K-Means Fan Segmentation' AS model FROM dim_game""",
)
def _(t):
    return t("dim_game").select(
        "game_id", "arena_fill_pct", F.lit(60.0).alias("alert_threshold_pct"),
        F.lit(MODEL_CARD["segmentation_model"]).alias("model"),
    )
