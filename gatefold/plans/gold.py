"""Marts: customer 360, event revenue, retention cohort, feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, flag_to_int, is_true, promo_sensitivity, round_to, safe_ratio
from ..operators.grouping import (
    CUSTOMER_MEASURES,
    HISTORY_MEASURES,
    agg_customer,
    agg_customer_promo,
    agg_event,
    agg_event_promo,
    visit_history,
)
from ..operators.joins import attach_labels, index_against_mean, left_agg_join
from ..operators.windows import moving_avg, running_sum
from ..session import ensure_checkpoint_dir

# Columns of the customer dimension carried into the customer mart.
PROFILE_COLUMNS = [
    "customer_id", "full_name", "email", "zip_code", "acquisition_channel", "initial_segment",
    "is_season_holder", "signup_date", "tenure_days", "is_jersey_night_acq",
    "is_deeply_lapsed", "record_source",
]


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace NULLs column by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def _zero(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0.0))


def customer_360(
    dim_c: DataFrame,
    fact: DataFrame,
    promo: DataFrame,
    as_of: str | Column,
    churn_days: int = 45,
    events: DataFrame | None = None,
    measures: DataFrame | None = None,
) -> DataFrame:
    """One row per customer of the dimension, buyers or not.

    The phase of a visit is that of the event in ``events``; without it, the ticket's own. Stored
    ``measures`` of the same fact (:func:`~gatefold.operators.grouping.customer_measures`) are taken as they are.
    """
    if measures is None:
        tickets = agg_customer(fact, as_of, events=events)
    else:
        tickets = measures.select("customer_id", *CUSTOMER_MEASURES)
    joined = left_agg_join(
        dim_c.select(*PROFILE_COLUMNS), [tickets, agg_customer_promo(promo)], "customer_id"
    )
    filled = fill_defaults(
        joined, {"total_discount_received": 0.0, "promo_tickets": 0, "promo_rate": 0.0}
    )
    return filled.withColumns(
        {
            "promo_sensitivity": promo_sensitivity("promo_rate", "most_common_discount_tier"),
            "is_churn_risk": is_true(F.col("days_since_last") > churn_days),
            "revenue_net": round_to(_zero("total_spend") - _zero("total_discount_received"), 2),
            "_gold_refreshed_at": F.current_timestamp(),
        }
    )


def game_revenue(
    dim_g: DataFrame, fact: DataFrame, promo: DataFrame, capacity: int = 6200
) -> DataFrame:
    """One row per event, sold or not.

    The facts are reduced to one row per event and checkpointed; the ordered measures, which
    read their input several times, work on that and never on the facts again.
    """
    ensure_checkpoint_dir(dim_g.sparkSession)
    joined = left_agg_join(dim_g, [agg_event(fact), agg_event_promo(promo)], "game_id")
    gross = _zero("gross_revenue")
    base = fill_defaults(joined, {"total_discount_given": 0.0}).withColumns(
        {
            "net_revenue": round_to(gross - F.col("total_discount_given"), 2),
            "revenue_per_seat": round_to(gross / F.lit(capacity), 2),
        }
    ).checkpoint()
    total = running_sum(base, gross.cast("decimal(18,4)"), "game_number", "cumulative_revenue")
    smooth = moving_avg(total, "arena_fill_pct", "game_number", "fill_rate_3game_avg", 3, digits=3)
    indexed = index_against_mean(smooth, "gross_revenue", "revenue_index", digits=3)
    return indexed.withColumns(
        {
            "cumulative_revenue": round_to("cumulative_revenue", 2),
            "_gold_refreshed_at": F.current_timestamp(),
        }
    )


def retention_cohort(
    fact: DataFrame,
    dim_c: DataFrame,
    dim_g: DataFrame,
    windows: tuple[int, int] = (30, 60),
    churn_days: int = 45,
    high_value: float = 300,
    measures: DataFrame | None = None,
) -> DataFrame:
    """One row per customer with at least one ticket, anchored at the last event date.

    Stored ``measures`` of the same fact are taken as they are.
    """
    attributes = dim_c.select(
        "customer_id", "acquisition_channel", "initial_segment",
        "is_season_holder", "tenure_days", "is_jersey_night_acq",
    )
    if measures is None:
        history = visit_history(fact)
    else:
        history = measures.select("customer_id", *HISTORY_MEASURES)
    joined = history.join(attributes, "customer_id", "left")
    last_event = dim_g.agg(F.max("game_date").alias("last_event")).scalar()
    gap = days_between("second_purchase_date", "first_purchase_date")
    idle = days_between(last_event, F.col("last_purchase_date"))
    short, long = windows
    return joined.withColumns(
        {
            "days_to_second_purchase": gap,
            f"returned_{short}d": is_true(gap <= short),
            f"returned_{long}d": is_true(gap <= long),
            "churn_flag": is_true(idle > churn_days),
            "days_since_last": idle,
            "is_one_and_done": is_true(F.col("total_games") == 1),
            "is_high_value": is_true(F.col("total_spend") >= high_value),
            "is_jersey_night_cohort": F.col("attended_jersey_night") | F.col("is_jersey_night_acq"),
            "_gold_refreshed_at": F.current_timestamp(),
        }
    )


# Defaults for customers without a cohort row: no data counts as churned.
LABEL_DEFAULTS = {
    "churn_flag": 1,
    "cohort_days_since_last": 999,
    "returned_30d": 0,
    "returned_60d": 0,
    "is_one_and_done": 1,
    "is_jersey_night_cohort": 0,
}


def fan_features(c360: DataFrame, cohort: DataFrame) -> DataFrame:
    """Model features, one row per customer, 25 columns."""

    def default(col: str, value) -> Column:
        return F.coalesce(F.col(col), F.lit(value))

    numbers = {
        "recency_days": default("days_since_last", 999),
        "frequency_games": default("games_attended", 0),
        "monetary_net": default("revenue_net", 0.0),
        "monetary_gross": default("total_spend", 0.0),
        "promo_sensitivity": default("promo_sensitivity", 0.0),
        "promo_rate": default("promo_rate", 0.0),
        "total_discount_received": default("total_discount_received", 0.0),
        "advance_purchase_rate": round_to(
            safe_ratio("advance_purchases", "total_tickets", floor=1), 4
        ),
        "avg_days_before_game": default("avg_days_before_game", 0.0),
        "avg_seat_tier_rank": default("avg_seat_tier_rank", 3.0),
        "tenure_days": default("tenure_days", 0),
        "is_season_holder": flag_to_int("is_season_holder"),
        "channels_used": default("channels_used", 1),
    }
    seen = [
        "jersey_night_attendee", "hot_start_buyer", "slump_buyer",
        "late_push_buyer", "was_lapsed_reactivation",
    ]
    features = c360.select(
        "customer_id",
        *[e.alias(n) for n, e in numbers.items()],
        *[flag_to_int(c).alias(c) for c in seen],
    )
    labels = cohort.select(
        "customer_id",
        flag_to_int("churn_flag").alias("churn_flag"),
        default("days_since_last", 999).alias("cohort_days_since_last"),
        *[
            flag_to_int(c).alias(c)
            for c in ("returned_30d", "returned_60d", "is_one_and_done", "is_jersey_night_cohort")
        ],
    )
    return attach_labels(features, labels, "customer_id", LABEL_DEFAULTS)
