"""Customer health datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    bucketize,
    count_where,
    is_true,
    map_values,
    mean_of,
    n_rows,
    pct,
    phase_order,
    recommended_action,
    round_to,
)
from ..operators.joins import star_join
from ..operators.ordering import order_by, top_k
from ..operators.windows import share_of_total

KEY = "customer_id"

# Bucket labels of promotion sensitivity.
SENSITIVITY_LABELS = [
    "0.0–0.1 (Never uses promos)", "0.1–0.3 (Rare)", "0.3–0.5 (Occasional)",
    "0.5–0.7 (Frequent)", "0.7–1.0 (Promo dependent)",
]
# Display orders.
TIER_ORDER = {"High": 1, "Medium": 2, "Low": 3}
ENTRY_PHASE_ORDER = {
    "hot_start": 1, "slump": 2, "late_push": 3, "jersey_night": 4, "post_jersey": 5,
}


def is_high_risk() -> Column:
    return F.col("risk_tier") == "High"


def _risk(scores: DataFrame) -> DataFrame:
    return scores.select(KEY, "churn_probability", "risk_tier")


def _label(segments: DataFrame) -> DataFrame:
    return segments.select(KEY, "segment_label")


def fh_kpis(
    scores: DataFrame, segments: DataFrame, features: DataFrame, c360: DataFrame, cohort: DataFrame
) -> DataFrame:
    """One-row scorecard over customers known to all five tables."""
    fans = star_join(
        _risk(scores),
        [
            _label(segments),
            features.select(KEY, "is_jersey_night_cohort"),
            c360.select(KEY, "revenue_net"),
            cohort.select(KEY, "returned_30d"),
        ],
        KEY,
    )
    in_cohort = F.col("is_jersey_night_cohort") == 1
    return fans.agg(
        n_rows().alias("total_fans"),
        count_where(is_high_risk()).alias("high_risk_fans"),
        pct(is_high_risk()).alias("high_risk_pct"),
        mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct"),
        count_where(F.col("segment_label") == "Season Core").alias("season_core_count"),
        pct(in_cohort & F.col("returned_30d"), of=in_cohort).alias("jersey_night_return_rate_pct"),
        round_to(F.sum(F.col("revenue_net").cast("decimal(18,4)")), 0).alias("total_net_revenue"),
    )


def fh_churn_distribution(scores: DataFrame) -> DataFrame:
    """Customers per risk tier with share of all and display order."""
    tiers = share_of_total(
        scores, ["risk_tier"], n_rows(), "pct_of_total",
        [n_rows().alias("fan_count"), mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct")],
        few_groups=True,
    )
    return order_by(
        tiers.withColumn("sort_order", map_values("risk_tier", TIER_ORDER)), ["sort_order"]
    )


def fh_segment_summary(segments: DataFrame, scores: DataFrame, c360: DataFrame) -> DataFrame:
    """Health of each segment."""
    fans = star_join(_label(segments), [_risk(scores), c360], KEY)
    grouped = fans.groupBy("segment_label").agg(
        n_rows().alias("fan_count"),
        mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct"),
        mean_of("total_spend", 2).alias("avg_total_spend"),
        mean_of("games_attended", 1).alias("avg_games_attended"),
        mean_of("days_since_last", 0).alias("avg_days_since_last"),
        mean_of("promo_sensitivity", 3).alias("avg_promo_sensitivity"),
        mean_of("tenure_days", 0).alias("avg_tenure_days"),
        count_where(is_high_risk()).alias("high_risk_count"),
        pct(is_high_risk()).alias("high_risk_pct"),
    )
    return order_by(grouped, ["-avg_churn_prob_pct"])


def fh_watchlist(
    scores: DataFrame, segments: DataFrame, c360: DataFrame, dim_c: DataFrame, k: int = 25,
    min_games: int = 2, min_net: float = 50,
) -> DataFrame:
    """The k most valuable high-risk customers with a suggested action."""
    worth = c360.filter(
        (F.col("games_attended") >= min_games) & (F.col("revenue_net") >= min_net)
    ).select(KEY, "revenue_net", "games_attended", "days_since_last", "promo_sensitivity")
    people = dim_c.select(KEY, "full_name", "email", "acquisition_channel")
    fans = star_join(_risk(scores).filter(is_high_risk()), [_label(segments), worth, people], KEY)
    first = top_k(fans, ["-revenue_net"], k, tie_break=KEY)
    return first.select(
        "full_name",
        "email",
        "acquisition_channel",
        "segment_label",
        round_to(F.col("churn_probability") * 100, 1).alias("churn_probability_pct"),
        "risk_tier",
        round_to("revenue_net", 2).alias("lifetime_net_spend"),
        "games_attended",
        F.col("days_since_last").alias("days_since_last_game"),
        round_to("promo_sensitivity", 2).alias("promo_sensitivity"),
        recommended_action("promo_sensitivity", "games_attended").alias("recommended_action"),
    )


def fh_event_cohort(
    features: DataFrame, scores: DataFrame, cohort: DataFrame, c360: DataFrame
) -> DataFrame:
    """Customers won at the special event against everyone else."""
    fans = star_join(
        features.select(KEY, "is_jersey_night_cohort"),
        [_risk(scores), cohort.select(KEY, "returned_30d"), c360.select(KEY, "revenue_net")],
        KEY,
    )
    grouped = fans.groupBy("is_jersey_night_cohort").agg(
        n_rows().alias("fans"),
        mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct"),
        count_where("returned_30d").alias("returned_within_30d"),
        pct("returned_30d").alias("return_30d_rate_pct"),
        mean_of(F.col("revenue_net").cast("decimal(18,4)"), 2).alias("avg_lifetime_spend"),
        count_where(is_high_risk()).alias("high_risk_count"),
    )
    named = F.when(F.col("is_jersey_night_cohort") == 1, F.lit("Jersey Night Cohort")).otherwise(
        F.lit("General Fan Base")
    )
    listed = order_by(grouped, ["-is_jersey_night_cohort"])
    return listed.select(named.alias("cohort"), *grouped.columns[1:])


def fh_promo_sensitivity_dist(features: DataFrame, segments: DataFrame) -> DataFrame:
    """Promotion-sensitivity histogram per segment."""
    fans = features.select(KEY, "promo_sensitivity").join(_label(segments), KEY)
    bucket = bucketize("promo_sensitivity", [0.1, 0.3, 0.5, 0.7], SENSITIVITY_LABELS)
    grouped = fans.groupBy("segment_label", bucket.alias("sensitivity_bucket")).agg(
        n_rows().alias("fan_count"), mean_of("promo_sensitivity", 3).alias("avg_sensitivity")
    )
    return order_by(grouped, ["segment_label", "avg_sensitivity"])


def fh_channel_health(
    dim_c: DataFrame, scores: DataFrame, c360: DataFrame, cohort: DataFrame
) -> DataFrame:
    """Quality of the customers each acquisition channel brought in."""
    fans = star_join(
        dim_c.select(KEY, "acquisition_channel"),
        [
            _risk(scores),
            c360.select(KEY, "games_attended", "revenue_net"),
            cohort.select(KEY, "returned_30d"),
        ],
        KEY,
    )
    grouped = fans.groupBy("acquisition_channel").agg(
        n_rows().alias("fans_acquired"),
        mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct"),
        mean_of("games_attended", 1).alias("avg_games_attended"),
        mean_of(F.col("revenue_net").cast("decimal(18,4)"), 2).alias("avg_lifetime_spend"),
        pct("returned_30d").alias("return_30d_rate_pct"),
        count_where(is_high_risk()).alias("high_risk_count"),
    )
    return order_by(grouped, ["-avg_lifetime_spend"])


def fh_churn_by_phase(cohort: DataFrame, c360: DataFrame) -> DataFrame:
    """Churn and early return by the phase in which customers arrived."""
    entered = cohort.filter(F.col("acquisition_phase").isNotNull()).select(
        KEY, "acquisition_phase", "churn_flag", "returned_30d"
    )
    fans = entered.join(c360.select(KEY, "games_attended"), KEY)
    grouped = fans.groupBy("acquisition_phase").agg(
        n_rows().alias("fans"),
        count_where("churn_flag").alias("churned_count"),
        pct("churn_flag").alias("churn_rate_pct"),
        mean_of("games_attended", 1).alias("avg_games_attended"),
        pct(is_true("returned_30d")).alias("return_30d_rate_pct"),
    )
    order = phase_order("acquisition_phase", ENTRY_PHASE_ORDER, 6)
    return order_by(grouped.withColumn("phase_order", order), ["phase_order"])
