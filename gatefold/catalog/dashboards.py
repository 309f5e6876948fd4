"""Dashboard datasets."""

from ..oracle import rounded as R
from ..plans import fan_health as fh
from ..plans import revenue as rev
from ..plans import segments as seg
from .registry import query

PROB = R("avg(churn_probability) * 100", 1) + " AS avg_churn_prob_pct"
HIGH = "count(*) FILTER (risk_tier = 'High')"
HIGH_PCT = R(f"{HIGH} * CAST(100 AS DOUBLE) / count(*)", 1)
RET = R("count(*) FILTER (returned_30d) * CAST(100 AS DOUBLE) / count(*)", 1)
C360 = "(SELECT * EXCLUDE (acquisition_channel, initial_segment, is_season_holder, tenure_days, is_jersey_night_acq, full_name, email, signup_date, record_source, zip_code, is_deeply_lapsed) FROM customer_360)"
RTN = "(SELECT customer_id, returned_30d, churn_flag, acquisition_phase FROM retention_cohort)"


def _order(col, names, other):
    whens = " ".join(f"WHEN '{n}' THEN {i + 1}" for i, n in enumerate(names))
    return f"CASE {col} {whens} ELSE {other} END"


PHASES = ["hot_start", "slump", "late_push", "bridge", "jersey_night", "post_jersey"]


@query(
    "fh_kpis",
    f"""SELECT count(*) AS total_fans, {HIGH} AS high_risk_fans, {HIGH_PCT} AS high_risk_pct, {PROB},
        count(*) FILTER (segment_label = 'Season Core') AS season_core_count,
        {R("count(*) FILTER (is_jersey_night_cohort = 1 AND r.returned_30d) * CAST(100 AS DOUBLE) / nullif(count(*) FILTER (is_jersey_night_cohort = 1), 0)", 1)} AS jersey_night_return_rate_pct,
        {R("sum(CAST(revenue_net AS DECIMAL(18,4)))", 0)} AS total_net_revenue
        FROM ml_churn_scores JOIN ml_fan_segments USING (customer_id)
        JOIN (SELECT customer_id, is_jersey_night_cohort FROM fan_features) USING (customer_id)
        JOIN (SELECT customer_id, revenue_net FROM customer_360) USING (customer_id)
        JOIN {RTN} r USING (customer_id)""",
)
def _(t):
    return fh.fh_kpis(*map(t, ["ml_churn_scores", "ml_fan_segments", "fan_features", "customer_360", "retention_cohort"]))


@query(
    "fh_churn_distribution",
    f"""SELECT risk_tier, count(*) AS fan_count,
        {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER ()", 1)} AS pct_of_total, {PROB},
        CASE risk_tier WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 END AS sort_order
        FROM ml_churn_scores GROUP BY risk_tier""",
)
def _(t):
    return fh.fh_churn_distribution(t("ml_churn_scores"))


@query(
    "fh_segment_summary",
    f"""SELECT segment_label, count(*) AS fan_count, {PROB}, {R("avg(total_spend)", 2)} AS avg_total_spend,
        {R("avg(games_attended)", 1)} AS avg_games_attended, {R("avg(days_since_last)", 0)} AS avg_days_since_last,
        {R("avg(promo_sensitivity)", 3)} AS avg_promo_sensitivity, {R("avg(tenure_days)", 0)} AS avg_tenure_days,
        {HIGH} AS high_risk_count, {HIGH_PCT} AS high_risk_pct
        FROM ml_fan_segments JOIN ml_churn_scores USING (customer_id) JOIN customer_360 USING (customer_id)
        GROUP BY segment_label""",
)
def _(t):
    return fh.fh_segment_summary(*map(t, ["ml_fan_segments", "ml_churn_scores", "customer_360"]))


@query(
    "fh_watchlist",
    f"""SELECT full_name, email, acquisition_channel, segment_label,
        {R("churn_probability * 100", 1)} AS churn_probability_pct, risk_tier,
        {R("revenue_net", 2)} AS lifetime_net_spend, games_attended, days_since_last AS days_since_last_game,
        {R("promo_sensitivity", 2)} AS promo_sensitivity,
        CASE WHEN promo_sensitivity > 0.5 THEN 'Offer discount' WHEN games_attended > 5 THEN 'Loyalty reward'
             ELSE 'Re-engagement email' END AS recommended_action
        FROM ml_churn_scores JOIN ml_fan_segments USING (customer_id) JOIN customer_360 USING (customer_id)
        WHERE risk_tier = 'High' AND games_attended >= 2 AND revenue_net >= 50
        ORDER BY revenue_net DESC, customer_id LIMIT 25""",
)
def _(t):
    return fh.fh_watchlist(*map(t, ["ml_churn_scores", "ml_fan_segments", "customer_360", "dim_customer"]))


@query(
    "fh_event_cohort",
    f"""SELECT CASE WHEN is_jersey_night_cohort = 1 THEN 'Jersey Night Cohort' ELSE 'General Fan Base' END AS cohort,
        count(*) AS fans, {PROB}, count(*) FILTER (r.returned_30d) AS returned_within_30d,
        {R("count(*) FILTER (r.returned_30d) * CAST(100 AS DOUBLE) / count(*)", 1)} AS return_30d_rate_pct,
        {R("sum(CAST(revenue_net AS DECIMAL(18,4))) / CAST(count(*) AS DOUBLE)", 2)} AS avg_lifetime_spend, {HIGH} AS high_risk_count
        FROM (SELECT customer_id, is_jersey_night_cohort FROM fan_features) JOIN ml_churn_scores USING (customer_id)
        JOIN {RTN} r USING (customer_id) JOIN {C360} USING (customer_id) GROUP BY is_jersey_night_cohort""",
)
def _(t):
    return fh.fh_event_cohort(*map(t, ["fan_features", "ml_churn_scores", "retention_cohort", "customer_360"]))


@query(
    "fh_promo_sensitivity_dist",
    f"""SELECT segment_label,
        CASE WHEN promo_sensitivity < 0.1 THEN '0.0–0.1 (Never uses promos)' WHEN promo_sensitivity < CAST(0.3 AS DOUBLE) THEN '0.1–0.3 (Rare)'
             WHEN promo_sensitivity < 0.5 THEN '0.3–0.5 (Occasional)' WHEN promo_sensitivity < CAST(0.7 AS DOUBLE) THEN '0.5–0.7 (Frequent)'
             ELSE '0.7–1.0 (Promo dependent)' END AS sensitivity_bucket,
        count(*) AS fan_count, {R("avg(promo_sensitivity)", 3)} AS avg_sensitivity
        FROM fan_features JOIN ml_fan_segments USING (customer_id) GROUP BY 1, 2""",
)
def _(t):
    return fh.fh_promo_sensitivity_dist(t("fan_features"), t("ml_fan_segments"))


@query(
    "fh_channel_health",
    f"""SELECT acquisition_channel, count(*) AS fans_acquired, {PROB}, {R("avg(games_attended)", 1)} AS avg_games_attended,
        {R("sum(CAST(revenue_net AS DECIMAL(18,4))) / CAST(count(*) AS DOUBLE)", 2)} AS avg_lifetime_spend, {RET} AS return_30d_rate_pct, {HIGH} AS high_risk_count
        FROM customer_360 JOIN ml_churn_scores USING (customer_id) JOIN {RTN} USING (customer_id)
        GROUP BY acquisition_channel""",
)
def _(t):
    return fh.fh_channel_health(*map(t, ["dim_customer", "ml_churn_scores", "customer_360", "retention_cohort"]))


@query(
    "fh_churn_by_phase",
    f"""SELECT acquisition_phase, count(*) AS fans, count(*) FILTER (churn_flag) AS churned_count,
        {R("count(*) FILTER (churn_flag) * CAST(100 AS DOUBLE) / count(*)", 1)} AS churn_rate_pct,
        {R("avg(games_attended)", 1)} AS avg_games_attended, {RET} AS return_30d_rate_pct,
        {_order("acquisition_phase", ["hot_start", "slump", "late_push", "jersey_night", "post_jersey"], 6)} AS phase_order
        FROM {RTN} JOIN customer_360 USING (customer_id) WHERE acquisition_phase IS NOT NULL GROUP BY acquisition_phase""",
)
def _(t):
    return fh.fh_churn_by_phase(t("retention_cohort"), t("customer_360"))


# ---------------------------------------------------------------- revenue

G, NET, DISC = ("sum(CAST(gross_revenue AS DECIMAL(18,4)))", "sum(CAST(net_revenue AS DECIMAL(18,4)))", "sum(CAST(total_discount_given AS DECIMAL(18,4)))")


@query(
    "rev_kpis",
    f"""SELECT {R(G, 0)} AS total_gross_revenue, {R(NET, 0)} AS total_net_revenue, {R(DISC, 0)} AS total_discounts_given,
        {R(f"CAST({DISC} AS DOUBLE) / nullif(CAST({G} AS DOUBLE), 0) * 100", 1)} AS discount_as_pct_of_gross,
        {R("avg(arena_fill_pct) * 100", 1)} AS avg_fill_rate_pct,
        {R("max(CASE WHEN is_jersey_night THEN gross_revenue ELSE 0 END)", 0)} AS jersey_night_revenue,
        count(*) AS total_games, count(*) FILTER (arena_fill_pct >= CAST(0.99 AS DOUBLE)) AS sellouts FROM game_revenue""",
)
def _(t):
    return rev.rev_kpis(t("game_revenue"))


@query(
    "rev_by_game",
    f"""SELECT game_number, game_date, opponent, season_phase, is_jersey_night, {R("gross_revenue", 0)} AS gross_revenue,
        {R("net_revenue", 0)} AS net_revenue, {R("total_discount_given", 0)} AS discounts_given,
        {R("arena_fill_pct * 100", 1)} AS fill_rate_pct, revenue_index, {R("cumulative_revenue", 0)} AS cumulative_revenue, result
        FROM game_revenue WHERE is_home_game""",
)
def _(t):
    return rev.rev_by_game(t("game_revenue"))


@query(
    "rev_fill_trend",
    f"""SELECT game_number, game_date, season_phase, is_jersey_night, {R("arena_fill_pct * 100", 1)} AS fill_rate_pct,
        {R("fill_rate_3game_avg * 100", 1)} AS fill_rate_3game_avg_pct, CAST(60 AS DOUBLE) AS alert_threshold_pct
        FROM game_revenue WHERE is_home_game""",
)
def _(t):
    return rev.rev_fill_trend(t("game_revenue"))


@query(
    "rev_by_phase",
    f"""SELECT season_phase, count(*) AS games, {R(G, 0)} AS total_gross_revenue, {R(NET, 0)} AS total_net_revenue,
        {R(DISC, 0)} AS total_discounts, {R(f"{G} / CAST(count(gross_revenue) AS DOUBLE)", 0)} AS avg_revenue_per_game,
        {R("avg(arena_fill_pct) * 100", 1)} AS avg_fill_rate_pct, {R("avg(promo_rate) * 100", 1)} AS avg_promo_rate_pct,
        {_order("season_phase", PHASES, 7)} AS phase_order
        FROM game_revenue WHERE is_home_game GROUP BY season_phase""",
)
def _(t):
    return rev.rev_by_phase(t("game_revenue"))


@query(
    "rev_promo_impact",
    f"""SELECT season_phase, count(*) AS games, CAST(sum(promo_tickets) AS BIGINT) AS total_promo_tickets,
        {R("avg(promo_rate) * 100", 1)} AS avg_promo_rate_pct, {R(DISC, 0)} AS total_discount_cost,
        {R("avg(avg_discount_pct)", 1)} AS avg_discount_depth_pct, {R(G, 0)} AS actual_gross_revenue,
        {R(f"{G} + {DISC}", 0)} AS full_price_revenue_estimate, {_order("season_phase", PHASES, 7)} AS phase_order
        FROM game_revenue WHERE is_home_game GROUP BY season_phase""",
)
def _(t):
    return rev.rev_promo_impact(t("game_revenue"))


@query(
    "rev_top_games",
    f"""SELECT game_number, game_date, opponent, season_phase, is_jersey_night, result, {R("gross_revenue", 0)} AS gross_revenue,
        {R("net_revenue", 0)} AS net_revenue, {R("arena_fill_pct * 100", 1)} AS fill_rate_pct,
        {R("promo_rate * 100", 1)} AS promo_rate_pct, {R("revenue_index", 2)} AS revenue_index
        FROM game_revenue WHERE is_home_game""",
)
def _(t):
    return rev.rev_top_games(t("game_revenue"))


PROMO_PCT = R("count(*) FILTER (is_promo_ticket) * CAST(100 AS DOUBLE) / count(*)", 1) + " AS promo_rate_pct"


@query(
    "rev_section_tier",
    f"""SELECT section_tier, seat_tier_rank, count(*) AS tickets_sold, {R("sum(ticket_price)", 0)} AS total_revenue,
        {R("avg(ticket_price)", 2)} AS avg_ticket_price, {PROMO_PCT},
        {R("CAST(sum(ticket_price) AS DOUBLE) * 100 / CAST(sum(sum(ticket_price)) OVER () AS DOUBLE)", 1)} AS pct_of_total_revenue
        FROM fact_tickets GROUP BY section_tier, seat_tier_rank""",
)
def _(t):
    return rev.rev_section_tier(t("fact_tickets"))


@query(
    "rev_advance_vs_walkup",
    f"""SELECT CASE WHEN is_advance_purchase THEN 'Advance (>3 days out)' ELSE 'Walk-up / Day-of' END AS purchase_timing,
        count(*) AS tickets, {R("avg(ticket_price)", 2)} AS avg_ticket_price, {R("sum(ticket_price)", 0)} AS total_revenue,
        {PROMO_PCT}, {R("avg(days_before_game)", 1)} AS avg_days_before_game
        FROM fact_tickets GROUP BY is_advance_purchase""",
)
def _(t):
    return rev.rev_advance_vs_walkup(t("fact_tickets"))


# ---------------------------------------------------------------- segments


@query(
    "seg_overview",
    f"""SELECT segment_label, count(*) AS fan_count, {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER ()", 1)} AS pct_of_base,
        {R("sum(CAST(total_spend AS DECIMAL(18,4))) / CAST(count(total_spend) AS DOUBLE)", 2)} AS avg_total_spend,
        {R("sum(CAST(revenue_net AS DECIMAL(18,4))) / CAST(count(*) AS DOUBLE)", 2)} AS avg_net_spend,
        {R("sum(CAST(revenue_net AS DECIMAL(18,4)))", 0)} AS total_segment_revenue,
        {R("avg(games_attended)", 1)} AS avg_games_attended, {R("avg(days_since_last)", 0)} AS avg_days_since_last,
        {R("avg(tenure_days)", 0)} AS avg_tenure_days, count(*) FILTER (is_season_holder) AS season_holders,
        {R("avg(promo_sensitivity)", 3)} AS avg_promo_sensitivity, {R("avg(promo_rate)", 3)} AS avg_promo_rate, {PROB},
        {HIGH} AS high_risk_fans, count(*) FILTER (jersey_night_attendee) AS jersey_night_attendees
        FROM ml_fan_segments JOIN customer_360 USING (customer_id) JOIN ml_churn_scores USING (customer_id)
        GROUP BY segment_label""",
)
def _(t):
    return seg.seg_overview(*map(t, ["ml_fan_segments", "customer_360", "ml_churn_scores"]))


@query(
    "seg_by_channel",
    f"""SELECT acquisition_channel, segment_label, count(*) AS fan_count,
        {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY acquisition_channel)", 1)} AS pct_within_channel, {PROB}
        FROM dim_customer JOIN ml_fan_segments USING (customer_id) JOIN ml_churn_scores USING (customer_id)
        GROUP BY acquisition_channel, segment_label""",
)
def _(t):
    return seg.seg_by_channel(*map(t, ["dim_customer", "ml_fan_segments", "ml_churn_scores"]))


@query(
    "seg_spend_percentiles",
    "SELECT segment_label, "
    + ", ".join(
        f"{R(f'quantile_cont(revenue_net, {p})', 2)} AS {n}"
        for n, p in [("p10_spend", 0.1), ("p25_spend", 0.25), ("median_spend", 0.5), ("p75_spend", 0.75), ("p90_spend", 0.9)]
    )
    + f""", {R("sum(CAST(revenue_net AS DECIMAL(18,4))) / CAST(count(*) AS DOUBLE)", 2)} AS mean_spend, {R("max(revenue_net)", 2)} AS max_spend
        FROM ml_fan_segments JOIN customer_360 USING (customer_id) GROUP BY segment_label""",
)
def _(t):
    return seg.seg_spend_percentiles(t("ml_fan_segments"), t("customer_360"))


@query(
    "seg_attendance",
    """SELECT segment_label, attendance_bucket, bucket_order, count(*) AS fan_count FROM (
        SELECT segment_label, ord AS bucket_order,
          ['0 games', '1 game', '2–3 games', '4–5 games', '6–10 games', '11–20 games', '21+ games'][ord + 1] AS attendance_bucket
        FROM (SELECT segment_label, CASE WHEN games_attended = 0 THEN 0 WHEN games_attended = 1 THEN 1 WHEN games_attended <= 3 THEN 2
              WHEN games_attended <= 5 THEN 3 WHEN games_attended <= 10 THEN 4 WHEN games_attended <= 20 THEN 5 ELSE 6 END AS ord
              FROM ml_fan_segments JOIN customer_360 USING (customer_id))) GROUP BY ALL""",
)
def _(t):
    return seg.seg_attendance(t("ml_fan_segments"), t("customer_360"))


JUDGED = "(SELECT churn_flag, churn_probability FROM fan_features JOIN ml_churn_scores USING (customer_id))"


@query(
    "seg_model_card",
    f"""SELECT 'K-Means Fan Segmentation' AS segmentation_model, 'gold.kmeans_fan_segmentation' AS segmentation_registry,
        5 AS n_segments, 'gold.gbt_churn_predictor' AS churn_registry,
        'Gradient-Boosted Churn Predictor' AS churn_model,
        (SELECT {R("(s - CAST(p AS DOUBLE) * (p + 1) / 2) / (CAST(p AS DOUBLE) * n)", 6)}
         FROM (SELECT count(*) FILTER (churn_flag = 1) AS p, count(*) FILTER (churn_flag = 0) AS n,
                      sum(r) FILTER (churn_flag = 1) AS s
               FROM (SELECT churn_flag, rank() OVER (ORDER BY churn_probability)
                            + (count(*) OVER (PARTITION BY churn_probability) - 1) / CAST(2 AS DOUBLE) AS r
                     FROM {JUDGED}))) AS churn_model_auc,
        (SELECT {R("CAST(count(*) FILTER (CAST(churn_probability >= 0.5 AS INTEGER) = churn_flag) AS DOUBLE) / count(*)", 4)}
         FROM {JUDGED}) AS churn_model_accuracy,
        (SELECT max(scored_at) FROM ml_churn_scores) AS last_scored_at,
        (SELECT count(DISTINCT segment_label) FROM ml_fan_segments) AS active_segments""",
)
def _(t):
    return seg.seg_model_card(t("ml_churn_scores"), t("ml_fan_segments"), t("fan_features"))


@query(
    "seg_campaign_guide",
    f"""SELECT segment_label, count(*) AS fan_count, {PROB}, priority AS campaign_priority, channel AS recommended_channel,
        offer AS recommended_offer, goal AS campaign_goal
        FROM ml_fan_segments JOIN ml_churn_scores USING (customer_id)
        JOIN (VALUES ('Season Core', '5 — Maintain', 'Direct mail + VIP event invite', 'Early renewal discount + exclusive access', 'Retain and upsell'),
          ('High Value New', '2 — Nurture', 'Email welcome series + next-game offer', '10% off next game', 'Convert to repeat buyer'),
          ('Casual Fan', '3 — Re-engage', 'SMS + social retargeting', 'Buy 2 get 1 free', 'Increase frequency'),
          ('Promo Hunter', '4 — Reduce promo dependency', 'Value bundle (not pure discount)', 'Merch bundle (jersey + ticket)', 'Shift to value perception'),
          ('Lapsed', '1 — Win back', 'Email win-back + urgency offer', '25% off return game', 'Reactivate within 30 days'))
          AS guide(name, priority, channel, offer, goal) ON segment_label = name
        GROUP BY segment_label, priority, channel, offer, goal""",
)
def _(t):
    return seg.seg_campaign_guide(t("ml_fan_segments"), t("ml_churn_scores"))


@query(
    "seg_by_phase",
    f"""SELECT acquisition_phase, segment_label, count(*) AS fan_count,
        {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY acquisition_phase)", 1)} AS pct_within_phase,
        {_order("acquisition_phase", PHASES, 7)} AS phase_order
        FROM {RTN} JOIN ml_fan_segments USING (customer_id) WHERE acquisition_phase IS NOT NULL
        GROUP BY acquisition_phase, segment_label""",
)
def _(t):
    return seg.seg_by_phase(t("retention_cohort"), t("ml_fan_segments"))
