"""Conformed (silver) tables: event and customer dimensions, ticket fact, promotion bridge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_email, clean_name, days_between, is_true, map_values, round_to
from ..operators.quality import expect, expect_or_drop, quarantine
from ..operators.sets import union_sources
from ..operators.windows import running_sum

# Phases as inclusive event-number ranges; other numbers are 'bridge'.
SEASON_PHASES = [
    ("hot_start", 1, 22),
    ("slump", 23, 52),
    ("late_push", 53, 72),
    ("jersey_night", 77, 77),
    ("post_jersey", 78, 82),
]

# Seat sections by price level, 5 is the most expensive.
SECTION_RANKS = {"rinkside": 5, "lower_bowl": 4, "mid_bowl": 3, "upper_bowl": 2, "standing": 1}

# Accepted categories.
ACQUISITION_CHANNELS = (
    "season_package", "walk_up", "social_media", "friend_referral",
    "email_campaign", "promo_code", "corporate", "jersey_night_event",
)
PURCHASE_CHANNELS = ("online", "box_office", "mobile_app", "reseller")
HOME_STATES = ("ID",)
PLAYOFF_PHASES = ("late_push", "jersey_night", "post_jersey")

# Money is kept as DECIMAL in silver: sums are exact and independent of task order.
MONEY = "decimal(18,4)"


def _in(col: str, values: Sequence[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"{col} IN ({listed})"


EVENT_RULES = {
    "game_id_not_null": "game_id IS NOT NULL",
    "valid_result": "result IN ('W', 'L')",
    "fill_pct_valid": "arena_fill_pct BETWEEN 0 AND 1",
}
CUSTOMER_DROP_RULES = {
    "customer_id_not_null": "customer_id IS NOT NULL",
    "email_not_null": "email IS NOT NULL",
}
TICKET_DROP_RULES = {
    "ticket_id_not_null": "ticket_id IS NOT NULL",
    "customer_id_not_null": "customer_id IS NOT NULL",
    "game_id_not_null": "game_id IS NOT NULL",
    "price_positive": "ticket_price > 0",
}
PROMO_RULES = {
    "promo_id_not_null": "promo_id IS NOT NULL",
    "ticket_id_not_null": "ticket_id IS NOT NULL",
    "valid_discount": "discount_pct BETWEEN 0.05 AND 0.60",
    "discount_positive": "discount_amount > 0",
}
QUARANTINE_REASONS = [
    ("null_ticket_id", "ticket_id IS NULL"),
    ("null_customer_id", "customer_id IS NULL"),
    ("null_game_id", "game_id IS NULL"),
    ("invalid_price", "ticket_price <= 0"),
]


def customer_warn_rules(channels: Sequence[str] = ACQUISITION_CHANNELS) -> dict[str, str]:
    return {"valid_acquisition_channel": _in("acquisition_channel", channels)}


def ticket_warn_rules(
    sections: Sequence[str] = tuple(SECTION_RANKS), channels: Sequence[str] = PURCHASE_CHANNELS
) -> dict[str, str]:
    return {
        "valid_section_tier": _in("section_tier", sections),
        "valid_purchase_channel": _in("purchase_channel", channels),
    }


def _optional(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(n) for n in names if n in df.columns]


# ---------------------------------------------------------------- events


def build_dim_game(raw_events: DataFrame) -> DataFrame:
    """Event dimension: numeric result, rounded fill, playoff flag, running wins."""
    won = F.when(F.col("result") == "W", 1).otherwise(0)
    shaped = raw_events.select(
        "game_id",
        "game_number",
        F.col("game_date").cast("date").alias("game_date"),
        "opponent",
        "is_home_game",
        "arena",
        "home_score",
        "away_score",
        "result",
        won.alias("result_numeric"),
        "attendance",
        round_to("arena_fill_pct", 3).alias("arena_fill_pct"),
        "season_type",
        "season_phase",
        "is_jersey_night",
        "is_star_injury_game",
        is_true(F.col("season_phase").isin(*PLAYOFF_PHASES)).alias("is_playoff_relevant"),
        *_optional(raw_events, "_ingested_at", "_source"),
    )
    return running_sum(shaped, "result_numeric", "game_number", "wins_to_date")


# ---------------------------------------------------------------- customers


def clean_customer(df: DataFrame, source_label: str, as_of: str | Column) -> DataFrame:
    """Names, e-mails, tenure at ``as_of`` and the source label."""
    reference = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return df.select(
        "customer_id",
        clean_name("full_name").alias("full_name"),
        clean_email("email").alias("email"),
        "phone",
        "zip_code",
        "state",
        "acquisition_channel",
        "initial_segment",
        "is_season_holder",
        "signup_date",
        "is_jersey_night_acq",
        "is_deeply_lapsed",
        days_between(reference, F.col("signup_date")).alias("tenure_days"),
        F.lit(source_label).alias("record_source"),
        *_optional(df, "_ingested_at"),
    )


def build_dim_customer(seed: DataFrame, new: DataFrame, as_of: str | Column) -> DataFrame:
    """Customer dimension from both sources; rows without id or e-mail are dropped."""
    both = union_sources(
        clean_customer(seed, "seed", as_of), clean_customer(new, "simulator", as_of)
    )
    return expect_or_drop(both, CUSTOMER_DROP_RULES)


# ---------------------------------------------------------------- tickets


def enrich_ticket(
    df: DataFrame, tier_rank: Mapping[str, int] | None = None, advance_days: int = 3
) -> DataFrame:
    """Seat rank, days before the event, advance-purchase flag (unknown lead time: false)."""
    lead = days_between("game_date", "purchase_ts")
    return df.select(
        "ticket_id",
        "customer_id",
        "game_id",
        F.col("game_date").cast("date").alias("game_date"),
        "section_tier",
        map_values("section_tier", tier_rank or SECTION_RANKS).alias("seat_tier_rank"),
        F.expr("try_cast(seat_row AS int)").alias("seat_row"),
        F.expr("try_cast(seat_number AS int)").alias("seat_number"),
        F.col("ticket_price").cast(MONEY).alias("ticket_price"),
        "purchase_channel",
        "purchase_ts",
        "is_promo_ticket",
        "is_jersey_night_game",
        "is_lapsed_reactivation",
        "season_phase",
        lead.alias("days_before_game"),
        is_true(lead > advance_days).alias("is_advance_purchase"),
        *_optional(df, "_ingested_at"),
    )


def build_fact(
    seed: DataFrame,
    new: DataFrame,
    tier_rank: Mapping[str, int] | None = None,
    advance_days: int = 3,
) -> DataFrame:
    """Ticket fact from both sources; rows with a missing id or no positive price are dropped."""
    both = union_sources(
        enrich_ticket(seed, tier_rank, advance_days), enrich_ticket(new, tier_rank, advance_days)
    )
    return expect_or_drop(both, TICKET_DROP_RULES)


def build_quarantine(raw: DataFrame) -> DataFrame:
    """Rejected raw tickets with the first reason that applies."""
    bad = quarantine(raw, QUARANTINE_REASONS)
    return bad.select(
        "ticket_id",
        "customer_id",
        "game_id",
        "ticket_price",
        "purchase_channel",
        "season_phase",
        "quarantine_reason",
        *_optional(bad, "_source_filename", "quarantine_ts", "_source_file"),
    )


# ---------------------------------------------------------------- promotions


def build_bridge_promo(promos: DataFrame, deep: float = 0.40, moderate: float = 0.20) -> DataFrame:
    """Redeemed promotions with revenue given away and discount depth (on the raw percentage)."""
    depth = (
        F.when(F.col("discount_pct") >= deep, F.lit("deep"))
        .when(F.col("discount_pct") >= moderate, F.lit("moderate"))
        .otherwise(F.lit("light"))
    )
    return promos.filter(F.col("redeemed")).select(
        "promo_id",
        "ticket_id",
        "customer_id",
        "game_id",
        "promo_type",
        round_to("discount_pct", 4).alias("discount_pct"),
        round_to("face_value", 2).alias("face_value"),
        round_to("discount_amount", 2).alias("discount_amount"),
        "redeemed",
        "season_phase",
        round_to(F.col("discount_pct") * F.col("face_value"), 2).alias("promo_impact_score"),
        depth.alias("discount_tier"),
        *_optional(promos, "_ingested_at", "_source"),
    )


def warn_rules(
    table: str, sections: Sequence[str] = tuple(SECTION_RANKS), channels: Sequence[str] = PURCHASE_CHANNELS,
    acquisition: Sequence[str] = ACQUISITION_CHANNELS, states: Sequence[str] = HOME_STATES,
) -> dict[str, str]:
    """Warn-only expectations of a bronze or silver table; a table without any has none."""
    rules = {
        "raw_customers": {
            **CUSTOMER_DROP_RULES,
            "valid_state": _in("state", states),
        },
        "raw_tickets": TICKET_DROP_RULES,
        "dim_game": EVENT_RULES,
        "dim_customer": customer_warn_rules(acquisition),
        "fact_tickets": ticket_warn_rules(sections, channels),
        "bridge_promo": PROMO_RULES,
    }
    return rules.get(table, {})


def with_expectations(df: DataFrame, table: str, **accepted):
    """A table with its warn-only expectations: (table, observation), or (stream, None)."""
    return expect(df, warn_rules(table, **accepted), f"expectations_of_{table}")
