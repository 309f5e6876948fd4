"""Validation suites: profiles of every layer and PASS / FAIL check lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    count_distinct_where,
    count_where,
    flag_to_int,
    mean_of,
    n_rows,
    pct,
    round_to,
)
from ..operators.joins import left_join_then_profile, star_join
from ..operators.ordering import order_by, project_after, top_k
from ..operators.quality import checks_from, null_counts, scorecard
from ..operators.quantiles import summary_stats
from ..operators.sets import table_counts
from ..operators.windows import share_of_total

KEY = "customer_id"

# Verdict texts.
PASS, FAIL, WARN, REVIEW = "✅ PASS", "❌ FAIL", "⚠️ WARN", "⚠️ REVIEW"


def _money(col: str) -> Column:
    return F.col(col).cast("decimal(18,4)")


def _untidy_name() -> Column:
    name = F.col("full_name")
    return (name != F.trim(name)) | (name == F.upper(name))


def _promo_rate(phase: str) -> Column:
    """Unrounded share of promotion tickets in a phase."""
    in_phase = F.col("season_phase") == phase
    promo = F.count_if(in_phase & F.col("is_promo_ticket"))
    return promo.cast("double") / F.nullif(F.count_if(in_phase), F.lit(0))


# ---------------------------------------------------------------- bronze


def val_bronze_checks(
    tables: Mapping[str, DataFrame],
    limits: Mapping[str, int] | None = None,
    special_channel: str = "jersey_night_event",
    total_events: int = 82,
    special_acquired: int = 412,
) -> DataFrame:
    """Check list over the four raw tables, one pass per table.

    ``limits`` are minimum row counts: customers at least, tickets and promotions more than.
    """
    low = {"raw_customers": 5000, "raw_tickets": 10000, "raw_promotions": 500, **(limits or {})}
    required = ["raw_events", "raw_customers", "raw_tickets", "raw_promotions"]
    missing = [t for t in required if t not in tables]
    if missing:
        raise ValueError(f"tables missing: {missing}")
    events, customers, tickets, promos = (tables[t] for t in required)
    exists = [
        (i + 1, f"table {t} exists", F.count(F.lit(1)) >= 0, "PASS", "FAIL")
        for i, t in enumerate(required)
    ]
    special = F.col("is_jersey_night")
    sold_out = F.max(F.when(special, F.col("arena_fill_pct"))) == 1.0
    parts = [
        checks_from(events, [
            exists[0],
            (5, "event count as scheduled", n_rows() == total_events, "PASS", "FAIL"),
            (9, "exactly one special event", count_where(special) == 1, "PASS", "FAIL"),
            (10, "special event is sold out", sold_out, "PASS", "FAIL"),
        ]),
        checks_from(customers, [
            exists[1],
            (6, "enough customers", n_rows() >= low["raw_customers"], "PASS", "FAIL"),
            (11, "special event acquisitions",
             count_where(F.col("acquisition_channel") == special_channel) == special_acquired, "PASS", "FAIL"),
            (13, "untidy names present", count_where(_untidy_name()) > 0, "PASS", "WARN"),
        ]),
        checks_from(tickets, [
            exists[2],
            (7, "enough tickets", n_rows() > low["raw_tickets"], "PASS", "FAIL"),
            (12, "slump promo rate above hot start", _promo_rate("slump") > _promo_rate("hot_start"), "PASS", "FAIL"),
        ]),
        checks_from(promos, [
            exists[3],
            (8, "enough promotions", n_rows() > low["raw_promotions"], "PASS", "FAIL"),
        ]),
    ]
    return scorecard(parts, keep_order=True)


def val_phase_profile(fact: DataFrame, events: DataFrame, phase_of: str = "ticket") -> DataFrame:
    """Season story per phase, in season order; tickets without a known event are left out.

    The phase is the ticket's own, or with ``phase_of="event"`` that of its event. One scan reduces the
    tickets to (event, phase, customer) cells with additive measures. Each known cell then counts
    twice in one expanded aggregation: with its measures for the event, without them for the
    customer, whose distinct pairs with the phase are the buyers.
    """
    keys = ["game_id", "season_phase"] if phase_of == "ticket" else ["game_id"]
    known_events = events.select(
        "game_id", "game_number", "arena_fill_pct", *(["season_phase"] if phase_of == "event" else [])
    )
    cells = fact.groupBy(*keys, KEY).agg(
        n_rows().alias("tickets"),
        F.sum(_money("ticket_price")).alias("revenue"),
        F.count("ticket_price").alias("priced"),
        count_where("is_promo_ticket").alias("promo"),
    )
    known = cells.join(known_events, "game_id")
    of_event = F.struct(F.col("game_id").alias("event"), F.lit(None).cast("string").alias("buyer"), F.lit(1).alias("copy"))
    of_buyer = F.struct(F.lit(None).cast("string").alias("event"), F.col(KEY).cast("string").alias("buyer"), F.lit(0).alias("copy"))
    expanded = known.select("*", F.inline(F.array(of_event, of_buyer)))

    def measure(column: str) -> Column:
        return F.sum(F.when(F.col("copy") == 1, F.col(column))).alias(column)

    pairs = expanded.groupBy("season_phase", "event", "buyer", "copy").agg(
        *[measure(c) for c in ("tickets", "revenue", "priced", "promo")],
        F.min("game_number").alias("game_number"), F.first("arena_fill_pct").alias("arena_fill_pct"),
    )
    tickets = F.sum("tickets")
    fill = F.sum(F.col("arena_fill_pct").cast("decimal(12,8)") * F.col("tickets").cast("decimal(20,0)"))
    story = pairs.groupBy("season_phase").agg(
        F.sum("copy").alias("games"),
        tickets.alias("total_tickets"),
        round_to(F.sum("revenue").cast("double") / F.nullif(F.sum("priced"), F.lit(0)), 2).alias("avg_ticket_price"),
        round_to(F.sum("promo") * F.lit(100.0) / tickets, 1).alias("promo_rate_pct"),
        round_to(F.sum("revenue"), 2).alias("total_revenue"),
        round_to(fill.cast("double") / tickets * 100, 1).alias("avg_fill_pct"),
        F.min("game_number").alias("_first"),
        F.count("buyer").alias("unique_buyers"),
    )
    return project_after(story, "_first")


def val_event_snapshot(
    fact: DataFrame, customers: DataFrame | None = None, channel: str = "jersey_night_event"
) -> DataFrame:
    """The special event in one row; with ``customers``, also how many it newly won."""
    tickets = fact.filter(F.col("is_jersey_night_game"))
    measures = [
        n_rows().alias("total_tickets"),
        count_where("is_lapsed_reactivation").alias("lapsed_reactivations"),
        mean_of(_money("ticket_price"), 2).alias("avg_ticket_price"),
    ]
    if customers is None:
        return tickets.agg(
            *measures,
            count_where("is_jersey_night_game").alias("jersey_night_tickets"),
            round_to(F.sum(_money("ticket_price")), 2).alias("total_revenue"),
            pct("is_promo_ticket").alias("promo_rate_pct"),
        )
    joined = tickets.join(customers.select(KEY, "acquisition_channel"), KEY)
    won = count_distinct_where(KEY, F.col("acquisition_channel") == channel)
    return joined.agg(*measures, won.alias("new_fan_acquisitions"))


# ---------------------------------------------------------------- silver


def val_silver_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each silver table."""
    return table_counts(tables)


def val_cleaning(dim_c: DataFrame) -> DataFrame:
    """How many customers are still untidy, per kind, in one pass."""
    name, email = F.col("full_name"), F.col("email")
    return dim_c.agg(
        count_where(name != F.trim(name)).alias("names_with_whitespace"),
        count_where((name == F.upper(name)) & (F.length(name) > 2)).alias("all_caps_names"),
        count_where(email != F.lower(email)).alias("mixed_case_emails"),
        count_where(F.col("tenure_days") <= 0).alias("invalid_tenure"),
        count_where(F.col(KEY).isNull()).alias("null_customer_ids"),
    )


def val_tier_map(fact: DataFrame) -> DataFrame:
    """Seat sections, their rank and ticket count."""
    grouped = fact.groupBy("section_tier", "seat_tier_rank").agg(n_rows().alias("ticket_count"))
    return order_by(grouped, [F.col("seat_tier_rank").desc_nulls_last()])


def val_advance_dist(fact: DataFrame) -> DataFrame:
    """Advance purchases: count, mean price, share."""
    return share_of_total(
        fact, ["is_advance_purchase"], n_rows(), "pct_of_total",
        [n_rows().alias("tickets"), mean_of(_money("ticket_price"), 2).alias("avg_price")],
        few_groups=True,
    )


def val_phase_flags(dim_g: DataFrame) -> DataFrame:
    """Events per phase and playoff flag, in season order."""
    grouped = dim_g.groupBy("season_phase", "is_playoff_relevant").agg(
        n_rows().alias("games"), F.min("game_number").alias("_first")
    )
    return project_after(grouped, "_first")


def val_promo_by_phase(promo: DataFrame) -> DataFrame:
    """Redeemed promotions per phase, most expensive first."""
    grouped = promo.groupBy("season_phase").agg(
        n_rows().alias("promo_count"),
        mean_of("discount_pct", 1, scale=100).alias("avg_discount_pct"),
        round_to(F.sum(_money("discount_amount")), 2).alias("total_discount_given"),
        mean_of(_money("promo_impact_score"), 2).alias("avg_impact_score"),
        count_where(F.col("discount_tier") == "deep").alias("deep_discounts"),
    )
    return order_by(grouped, ["-total_discount_given"])


def val_silver_scorecard(
    dim_g: DataFrame, dim_c: DataFrame, fact: DataFrame, bad: DataFrame,
    total_events: int = 82, min_tickets: int = 10000,
) -> DataFrame:
    """Five verdicts over the silver tables."""
    parts = [
        checks_from(dim_g, [(1, f"dim_game rows = {total_events}", n_rows() == total_events, PASS, FAIL)]),
        checks_from(dim_c, [(2, "No dirty names in dim_customer", count_where(_untidy_name()) == 0, PASS, FAIL)]),
        checks_from(fact, [
            (3, "fact_tickets > 10k rows", n_rows() > min_tickets, PASS, FAIL),
            (5, "Slump promo rate > Hot Start promo rate", _promo_rate("slump") > _promo_rate("hot_start"), PASS, FAIL),
        ]),
        checks_from(bad, [(4, "Quarantine table is empty", n_rows() == 0, PASS, REVIEW)]),
    ]
    return scorecard(parts)


# ---------------------------------------------------------------- gold


def val_c360_by_segment(c360: DataFrame) -> DataFrame:
    """Customer mart by initial segment."""
    grouped = c360.groupBy("initial_segment").agg(
        n_rows().alias("fans"),
        mean_of(_money("total_spend"), 2).alias("avg_spend"),
        mean_of("games_attended", 1).alias("avg_games"),
        mean_of("promo_sensitivity", 3).alias("avg_promo_sensitivity"),
        mean_of("days_since_last", 0).alias("avg_days_since_last"),
        F.sum(flag_to_int("is_churn_risk")).alias("churn_risk_count"),
    )
    return order_by(grouped, ["-avg_spend"])


def val_revenue_by_phase(game_revenue: DataFrame) -> DataFrame:
    """Event mart by phase, all events."""
    grouped = game_revenue.groupBy("season_phase").agg(
        n_rows().alias("games"),
        round_to(F.sum(_money("gross_revenue")), 2).alias("total_gross_revenue"),
        round_to(F.sum(_money("total_discount_given")), 2).alias("total_discounts"),
        round_to(F.sum(_money("net_revenue")), 2).alias("total_net_revenue"),
        mean_of("arena_fill_pct", 1, scale=100).alias("avg_fill_pct"),
        mean_of("promo_rate", 1, scale=100).alias("avg_promo_rate_pct"),
    )
    return order_by(grouped, ["-total_gross_revenue"])


def val_churn_by_phase(cohort: DataFrame) -> DataFrame:
    """Churn and 30-day return by entry phase."""
    grouped = cohort.groupBy("acquisition_phase").agg(
        n_rows().alias("fans"),
        F.sum(flag_to_int("churn_flag")).alias("churned"),
        pct("churn_flag").alias("churn_rate_pct"),
        mean_of("days_since_last", 0).alias("avg_days_since_last"),
        F.sum(flag_to_int("returned_30d")).alias("returned_30d"),
        pct("returned_30d").alias("return_30d_rate_pct"),
    )
    return order_by(grouped, ["-churn_rate_pct"])


def val_event_cohort_return(cohort: DataFrame) -> DataFrame:
    """Return rate of the special-event cohort, the rest, and customers of unknown origin."""
    return cohort.groupBy("is_jersey_night_cohort").agg(
        n_rows().alias("fans"),
        pct("returned_30d").alias("return_30d_rate_pct"),
        mean_of("days_since_last", 0).alias("avg_days_since_last"),
    )


# ---------------------------------------------------------------- features and models

SUMMARY_FEATURES = [
    "recency_days", "frequency_games", "monetary_net", "promo_sensitivity",
    "advance_purchase_rate", "tenure_days", "churn_flag",
]
REQUIRED_FEATURES = ["recency_days", "frequency_games", "monetary_net", "promo_sensitivity", "churn_flag"]


def val_features_summary(features: DataFrame, cols: Sequence[str] = SUMMARY_FEATURES) -> DataFrame:
    """Count, mean, extremes and exact quartiles of the main features."""
    stats = summary_stats(features, cols)
    return stats.select(
        "column_name", "n_values",
        *[round_to(c, 4).alias(c) for c in ("mean", "min", "p25", "p75", "max")],
    )


def val_feature_nulls(features: DataFrame, cols: Sequence[str] = REQUIRED_FEATURES) -> DataFrame:
    """NULLs per required feature, in one pass."""
    return null_counts(features, cols)


def val_churn_rate(features: DataFrame) -> DataFrame:
    """Overall churn percentage."""
    return features.agg(mean_of("churn_flag", 1, scale=100).alias("churn_rate_pct"))


def val_ml_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of the model tables."""
    return table_counts(tables, "rows")


def val_segment_dist(segments: DataFrame) -> DataFrame:
    """Segment sizes and shares."""
    shares = share_of_total(
        segments, ["segment_label"], n_rows(), "pct_of_total", [n_rows().alias("fan_count")], few_groups=True
    )
    return order_by(shares, ["-fan_count"])


def val_tier_dist(scores: DataFrame) -> DataFrame:
    """Risk tiers: size, share, probability range."""
    p = "churn_probability"
    shares = share_of_total(
        scores, ["risk_tier"], n_rows(), "pct_of_total",
        [
            n_rows().alias("fans"),
            mean_of(p, 3).alias("avg_prob"),
            round_to(F.min(p), 3).alias("min_prob"),
            round_to(F.max(p), 3).alias("max_prob"),
        ],
        few_groups=True,
    )
    return order_by(shares, ["-avg_prob"])


def _high() -> Column:
    return F.col("risk_tier") == "High"


def val_segment_story(segments: DataFrame, scores: DataFrame, features: DataFrame) -> DataFrame:
    """Do risk and behaviour fit the segment names?"""
    fans = star_join(
        segments.select(KEY, "segment_label"),
        [scores.select(KEY, "churn_probability", "risk_tier"), features],
        KEY,
    )
    grouped = fans.groupBy("segment_label").agg(
        n_rows().alias("fans"),
        mean_of("churn_probability", 3).alias("avg_churn_prob"),
        mean_of("frequency_games", 1).alias("avg_games"),
        mean_of(_money("monetary_net"), 2).alias("avg_net_spend"),
        mean_of("promo_sensitivity", 3).alias("avg_promo_sensitivity"),
        mean_of("recency_days", 0).alias("avg_recency_days"),
        count_where(_high()).alias("high_risk_count"),
    )
    return order_by(grouped, ["-avg_churn_prob"])


def val_cohort_risk(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Risk of the special-event cohort against the rest."""
    fans = scores.select(KEY, "churn_probability", "risk_tier").join(
        features.select(KEY, "is_jersey_night_cohort"), KEY
    )
    return fans.groupBy("is_jersey_night_cohort").agg(
        n_rows().alias("fans"),
        mean_of("churn_probability", 3).alias("avg_churn_prob"),
        count_where(_high()).alias("high_risk_count"),
        pct(_high()).alias("high_risk_pct"),
    )


def val_watchlist20(
    scores: DataFrame, segments: DataFrame, features: DataFrame, dim_c: DataFrame, k: int = 20,
    min_games: int = 2, min_net: float = 50,
) -> DataFrame:
    """The k high-risk customers most likely to leave and worth keeping."""
    worth = features.filter(
        (F.col("frequency_games") >= min_games) & (F.col("monetary_net") >= min_net)
    ).select(KEY, "monetary_net", "frequency_games", "recency_days")
    fans = star_join(
        scores.filter(_high()).select(KEY, "churn_probability", "risk_tier"),
        [
            segments.select(KEY, "segment_label"),
            worth,
            dim_c.select(KEY, "full_name", "email", "acquisition_channel"),
        ],
        KEY,
    )
    return top_k(fans, ["-churn_probability"], k, tie_break=KEY).select(
        "full_name", "email", "acquisition_channel", "segment_label",
        round_to("churn_probability", 3).alias("churn_probability"),
        "risk_tier",
        round_to("monetary_net", 2).alias("lifetime_net_spend"),
        F.col("frequency_games").alias("games_attended"),
        F.col("recency_days").alias("days_since_last_game"),
    )


def val_ml_scorecard(
    features: DataFrame, segments: DataFrame, scores: DataFrame,
    riskiest: str = "Lapsed", safest: str = "Season Core",
) -> DataFrame:
    """Five ordered verdicts over the model tables."""
    joined = scores.select(KEY, "churn_probability").join(segments.select(KEY, "segment_label"), KEY)

    def mean_in(label: str) -> Column:
        return F.avg(F.when(F.col("segment_label") == label, F.col("churn_probability")))

    story = checks_from(joined, [
        (4, f"{riskiest} segment has highest avg churn probability",
         mean_in(riskiest) > mean_in(safest), PASS, f"{FAIL} - model may need review"),
    ])
    labels = F.count_distinct("segment_label") == 5
    parts = [
        checks_from(features, [(1, "fan_features table exists", n_rows() > 0, PASS, FAIL)]),
        checks_from(segments, [
            (2, "ml_fan_segments has 5 distinct labels", labels, PASS, f"{FAIL} - review segment labels"),
        ]),
        checks_from(scores, [
            (3, "ml_churn_scores has all 3 risk tiers", F.count_distinct("risk_tier") == 3, PASS, FAIL),
            (5, "No null churn probabilities", count_where(F.col("churn_probability").isNull()) == 0, PASS, FAIL),
        ]),
        story,
    ]
    return scorecard(parts)


def val_segments_vs_c360(segments: DataFrame, c360: DataFrame) -> DataFrame:
    """Business metrics per segment; segment members unknown to the mart still count."""
    profile = left_join_then_profile(
        segments.select(KEY, "segment_label"), c360, KEY, "segment_label",
        [
            n_rows().alias("fan_count"),
            mean_of(_money("total_spend"), 2).alias("avg_total_spend"),
            mean_of("games_attended", 1).alias("avg_games_attended"),
            mean_of("days_since_last", 0).alias("avg_days_since_last"),
            mean_of("promo_sensitivity", 3).alias("avg_promo_sensitivity"),
            mean_of("tenure_days", 0).alias("avg_tenure_days"),
            F.sum(flag_to_int("is_churn_risk")).alias("churn_risk_count"),
        ],
    )
    return order_by(profile, ["-avg_total_spend"])


def val_scores_vs_segments(scores: DataFrame, segments: DataFrame) -> DataFrame:
    """Risk per segment; unsegmented customers form their own row."""
    profile = left_join_then_profile(
        scores.select(KEY, "churn_probability", "risk_tier"),
        segments.select(KEY, "segment_label"), KEY, "segment_label",
        [
            n_rows().alias("fans"),
            mean_of("churn_probability", 3).alias("avg_churn_prob"),
            count_where(_high()).alias("high_risk_count"),
            pct(_high()).alias("high_risk_pct"),
        ],
    )
    return order_by(profile, ["-avg_churn_prob"])
