"""Segment explorer datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bucketize, count_where, map_values, mean_of, n_rows, phase_order, round_to
from ..ml.metrics import accuracy, auc
from ..operators.joins import star_join
from ..operators.ordering import order_by
from ..operators.quantiles import percentiles
from ..operators.windows import share_of_total, share_within

KEY = "customer_id"

# Attendance histogram, upper edge of each bucket (inclusive).
ATTENDANCE_EDGES = [0, 1, 3, 5, 10, 20]
ATTENDANCE_LABELS = [
    "0 games", "1 game", "2–3 games", "4–5 games", "6–10 games", "11–20 games", "21+ games",
]

# Campaign guide, one row per segment:
# segment: (priority, channel, offer, goal); the last row is for any other segment.
CAMPAIGNS = {
    "Season Core": (
        "5 — Maintain", "Direct mail + VIP event invite",
        "Early renewal discount + exclusive access", "Retain and upsell",
    ),
    "High Value New": (
        "2 — Nurture", "Email welcome series + next-game offer",
        "10% off next game", "Convert to repeat buyer",
    ),
    "Casual Fan": (
        "3 — Re-engage", "SMS + social retargeting", "Buy 2 get 1 free", "Increase frequency",
    ),
    "Promo Hunter": (
        "4 — Reduce promo dependency", "Value bundle (not pure discount)",
        "Merch bundle (jersey + ticket)", "Shift to value perception",
    ),
    "Lapsed": (
        "1 — Win back", "Email win-back + urgency offer",
        "25% off return game", "Reactivate within 30 days",
    ),
    "Deeply Lapsed": (
        "1 — Win back", "Heritage/nostalgia campaign",
        "Free ticket + legacy fan recognition", "Emotional reconnection",
    ),
}
CAMPAIGN_DEFAULT = ("3 — Monitor", "Email", "Standard offer", "Maintain")

# Names on the model card. Its figures are measured.
MODEL_CARD = {
    "segmentation_model": "K-Means Fan Segmentation",
    "segmentation_registry": "gold.kmeans_fan_segmentation",
    "n_segments": 5,
    "churn_model": "Gradient-Boosted Churn Predictor",
    "churn_registry": "gold.gbt_churn_predictor",
}


def _label(segments: DataFrame) -> DataFrame:
    return segments.select(KEY, "segment_label")


def _risk(scores: DataFrame) -> DataFrame:
    return scores.select(KEY, "churn_probability", "risk_tier")


def _money(col: str):
    return F.col(col).cast("decimal(18,4)")


def seg_overview(segments: DataFrame, c360: DataFrame, scores: DataFrame) -> DataFrame:
    """Full profile of every segment, highest revenue first."""
    fans = star_join(_label(segments), [c360, _risk(scores)], KEY)
    profile = share_of_total(
        fans, ["segment_label"], n_rows(), "pct_of_base",
        [
            n_rows().alias("fan_count"),
            mean_of(_money("total_spend"), 2).alias("avg_total_spend"),
            mean_of(_money("revenue_net"), 2).alias("avg_net_spend"),
            round_to(F.sum(_money("revenue_net")), 0).alias("total_segment_revenue"),
            mean_of("games_attended", 1).alias("avg_games_attended"),
            mean_of("days_since_last", 0).alias("avg_days_since_last"),
            mean_of("tenure_days", 0).alias("avg_tenure_days"),
            count_where("is_season_holder").alias("season_holders"),
            mean_of("promo_sensitivity", 3).alias("avg_promo_sensitivity"),
            mean_of("promo_rate", 3).alias("avg_promo_rate"),
            mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct"),
            count_where(F.col("risk_tier") == "High").alias("high_risk_fans"),
            count_where("jersey_night_attendee").alias("jersey_night_attendees"),
        ],
        few_groups=True,
    )
    return order_by(profile, ["-total_segment_revenue"])


def seg_by_channel(dim_c: DataFrame, segments: DataFrame, scores: DataFrame) -> DataFrame:
    """Segment mix inside each acquisition channel."""
    fans = star_join(
        dim_c.select(KEY, "acquisition_channel"), [_label(segments), _risk(scores)], KEY
    )
    mix = share_within(
        fans, ["segment_label"], ["acquisition_channel"], n_rows(), "pct_within_channel",
        [n_rows().alias("fan_count"), mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct")],
    )
    return order_by(mix, ["acquisition_channel", "-fan_count"])


def seg_spend_percentiles(segments: DataFrame, c360: DataFrame) -> DataFrame:
    """Exact spend percentiles, mean and maximum per segment."""
    fans = _label(segments).join(c360.select(KEY, "revenue_net"), KEY)
    cuts = percentiles(
        fans, ["segment_label"], "revenue_net",
        {"p10_spend": 0.10, "p25_spend": 0.25, "median_spend": 0.50, "p75_spend": 0.75, "p90_spend": 0.90},
        mean="mean_spend", maximum="max_spend",
    )
    rounded = cuts.select(
        "segment_label", *[round_to(c, 2).alias(c) for c in cuts.columns if c != "segment_label"]
    )
    return order_by(rounded, ["-median_spend"])


def seg_attendance(segments: DataFrame, c360: DataFrame) -> DataFrame:
    """Attendance histogram per segment; customers without tickets fall into the top bucket,
    because their count is NULL, not 0."""
    fans = _label(segments).join(c360.select(KEY, "games_attended"), KEY)
    games = "games_attended"
    grouped = fans.groupBy(
        "segment_label",
        bucketize(games, ATTENDANCE_EDGES, ATTENDANCE_LABELS, closed="right").alias("attendance_bucket"),
        bucketize(games, ATTENDANCE_EDGES, list(range(7)), closed="right").alias("bucket_order"),
    ).agg(n_rows().alias("fan_count"))
    return order_by(grouped, ["segment_label", "bucket_order"])


def seg_model_card(
    scores: DataFrame, segments: DataFrame, labels: DataFrame, card: Mapping[str, object] | None = None
) -> DataFrame:
    """One row of model metadata: quality of the stored scores against the ``churn_flag`` of
    ``labels``, the last scoring time and the live segment count."""
    judged = labels.select(KEY, "churn_flag").join(scores.select(KEY, "churn_probability"), KEY)
    measured = {
        "churn_model_auc": auc(judged, "churn_flag", "churn_probability").select("auc").scalar(),
        "churn_model_accuracy": accuracy(judged, "churn_flag", "churn_probability").select("accuracy").scalar(),
        "active_segments": segments.agg(F.count_distinct("segment_label").alias("n")).scalar(),
    }
    last = scores.agg(F.max("scored_at").alias("last_scored_at"))
    constants = [F.lit(v).alias(k) for k, v in (card or MODEL_CARD).items()]
    return last.select(*constants, "last_scored_at", *[c.alias(k) for k, c in measured.items()])


def seg_campaign_guide(segments: DataFrame, scores: DataFrame) -> DataFrame:
    """Recommended campaign per segment, most urgent first."""
    fans = _label(segments).join(_risk(scores), KEY)
    grouped = fans.groupBy("segment_label").agg(
        n_rows().alias("fan_count"),
        mean_of("churn_probability", 1, scale=100).alias("avg_churn_prob_pct"),
    )
    fields = ["campaign_priority", "recommended_channel", "recommended_offer", "campaign_goal"]
    guided = grouped.withColumns(
        {
            field: map_values(
                "segment_label", {s: row[i] for s, row in CAMPAIGNS.items()}, CAMPAIGN_DEFAULT[i]
            )
            for i, field in enumerate(fields)
        }
    )
    return order_by(guided, ["campaign_priority"])


def seg_by_phase(cohort: DataFrame, segments: DataFrame) -> DataFrame:
    """Segment mix of the customers who arrived in each phase."""
    entered = cohort.filter(F.col("acquisition_phase").isNotNull()).select(KEY, "acquisition_phase")
    mix = share_within(
        entered.join(_label(segments), KEY), ["segment_label"], ["acquisition_phase"], n_rows(),
        "pct_within_phase", [n_rows().alias("fan_count")],
    )
    return order_by(
        mix.withColumn("phase_order", phase_order("acquisition_phase")), ["phase_order", "-fan_count"]
    )
