"""Validation and profile queries."""

from ..oracle import rounded as R
from ..plans import validation as v
from .registry import query

PASS, FAIL, REVIEW = "'✅ PASS'", "'❌ FAIL'", "'⚠️ REVIEW'"


def P(cond, digits=1):
    return R(f"count(*) FILTER ({cond}) * CAST(100 AS DOUBLE) / count(*)", digits)


def verdict(cond, ok="'PASS'", bad="'FAIL'"):
    return f"CASE WHEN {cond} THEN {ok} ELSE {bad} END AS result"


def M(col):
    return f"CAST({col} AS DECIMAL(18,4))"


def AVGM(col, d=2):
    return R(f"sum({M(col)}) / CAST(count({col}) AS DOUBLE)", d)


HOT = "avg(CASE WHEN season_phase = 'hot_start' THEN CAST(is_promo_ticket AS INTEGER) END)"
SLUMP = "avg(CASE WHEN season_phase = 'slump' THEN CAST(is_promo_ticket AS INTEGER) END)"
DIRTY = "full_name <> trim(full_name) OR full_name = upper(full_name)"

BRONZE = [
    (1, "table raw_events exists", "raw_events", "TRUE"),
    (2, "table raw_customers exists", "raw_customers", "TRUE"),
    (3, "table raw_tickets exists", "raw_tickets", "TRUE"),
    (4, "table raw_promotions exists", "raw_promotions", "TRUE"),
    (5, "event count as scheduled", "raw_events", "count(*) = 82"),
    (6, "enough customers", "raw_customers", "count(*) >= 100"),
    (7, "enough tickets", "raw_tickets", "count(*) > 10000"),
    (8, "enough promotions", "raw_promotions", "count(*) > 500"),
    (9, "exactly one special event", "raw_events", "count(*) FILTER (is_jersey_night) = 1"),
    (10, "special event is sold out", "raw_events", "max(CASE WHEN is_jersey_night THEN arena_fill_pct END) = 1"),
    (11, "special event acquisitions", "raw_customers", "count(*) FILTER (acquisition_channel = 'household') = 412"),
    (12, "slump promo rate above hot start", "raw_tickets", f"{SLUMP} > {HOT}"),
]


@query(
    "val_bronze_checks",
    " UNION ALL ".join(
        f"SELECT {i} AS sort_order, '{n}' AS check_name, {verdict('min(1) IS NULL OR ' + c if c == 'TRUE' else c)} FROM {t}"
        for i, n, t, c in BRONZE
    )
    + f" UNION ALL SELECT 13, 'untidy names present', {verdict(f'count(*) FILTER ({DIRTY}) > 0', bad=chr(39) + 'WARN' + chr(39))} FROM raw_customers",
)
def _(t):
    names = ["raw_events", "raw_customers", "raw_tickets", "raw_promotions"]
    return v.val_bronze_checks(
        {n: t(n) for n in names}, {"raw_customers": 100}, special_channel="household"
    )


def _phase_profile_sql(fact, events, phase="f"):
    return f"""SELECT {phase}.season_phase, count(DISTINCT f.game_id) AS games, count(*) AS total_tickets,
        {R("avg(ticket_price)", 2)} AS avg_ticket_price, {P("is_promo_ticket")} AS promo_rate_pct,
        count(DISTINCT customer_id) AS unique_buyers, {R("sum(ticket_price)", 2)} AS total_revenue,
        {R("avg(arena_fill_pct) * 100", 1)} AS avg_fill_pct
        FROM {fact} f JOIN {events} e ON f.game_id = e.game_id GROUP BY {phase}.season_phase"""


@query("val_phase_profile", _phase_profile_sql("fact_tickets", "dim_game"))
def _(t):
    return v.val_phase_profile(t("fact_tickets"), t("dim_game"))


@query("val_phase_profile_bronze", _phase_profile_sql("raw_tickets", "raw_events", "e"))
def _(t):
    return v.val_phase_profile(t("raw_tickets"), t("raw_events"), phase_of="event")


@query(
    "val_event_snapshot",
    f"""SELECT count(*) AS total_tickets, count(*) FILTER (is_lapsed_reactivation) AS lapsed_reactivations,
        {R("avg(ticket_price)", 2)} AS avg_ticket_price, count(*) FILTER (is_jersey_night_game) AS jersey_night_tickets,
        {R("sum(ticket_price)", 2)} AS total_revenue, {P("is_promo_ticket")} AS promo_rate_pct
        FROM fact_tickets WHERE is_jersey_night_game""",
)
def _(t):
    return v.val_event_snapshot(t("fact_tickets"))


@query(
    "val_event_snapshot_bronze",
    f"""SELECT count(*) AS total_tickets, count(*) FILTER (is_lapsed_reactivation) AS lapsed_reactivations,
        {R("avg(ticket_price)", 2)} AS avg_ticket_price,
        count(DISTINCT customer_id) FILTER (acquisition_channel = 'household') AS new_fan_acquisitions
        FROM raw_tickets JOIN raw_customers USING (customer_id) WHERE is_jersey_night_game""",
)
def _(t):
    return v.val_event_snapshot(t("raw_tickets"), t("raw_customers"), channel="household")


def _counts(names, col):
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS {col} FROM {n}" for n in names)


SILVER = ["dim_game", "dim_customer", "fact_tickets", "bridge_promo", "quarantine_tickets"]
MODELS = ["fan_features", "ml_fan_segments", "ml_churn_scores"]


@query("val_silver_counts", _counts(SILVER, "row_count"))
def _(t):
    return v.val_silver_counts({n: t(n) for n in SILVER})


@query(
    "val_cleaning",
    """SELECT count(*) FILTER (full_name <> trim(full_name)) AS names_with_whitespace,
        count(*) FILTER (full_name = upper(full_name) AND length(full_name) > 2) AS all_caps_names,
        count(*) FILTER (email <> lower(email)) AS mixed_case_emails, count(*) FILTER (tenure_days <= 0) AS invalid_tenure,
        count(*) FILTER (customer_id IS NULL) AS null_customer_ids FROM dim_customer""",
)
def _(t):
    return v.val_cleaning(t("dim_customer"))


@query("val_tier_map", "SELECT section_tier, seat_tier_rank, count(*) AS ticket_count FROM fact_tickets GROUP BY ALL")
def _(t):
    return v.val_tier_map(t("fact_tickets"))


@query(
    "val_advance_dist",
    f"""SELECT is_advance_purchase, count(*) AS tickets, {R("avg(ticket_price)", 2)} AS avg_price,
        {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER ()", 1)} AS pct_of_total FROM fact_tickets GROUP BY 1""",
)
def _(t):
    return v.val_advance_dist(t("fact_tickets"))


@query("val_phase_flags", "SELECT season_phase, is_playoff_relevant, count(*) AS games FROM dim_game GROUP BY ALL")
def _(t):
    return v.val_phase_flags(t("dim_game"))


@query(
    "val_promo_by_phase",
    f"""SELECT season_phase, count(*) AS promo_count, {R("avg(discount_pct) * 100", 1)} AS avg_discount_pct,
        {R(f"sum({M('discount_amount')})", 2)} AS total_discount_given, {AVGM("promo_impact_score")} AS avg_impact_score,
        count(*) FILTER (discount_tier = 'deep') AS deep_discounts FROM bridge_promo GROUP BY season_phase""",
)
def _(t):
    return v.val_promo_by_phase(t("bridge_promo"))


@query(
    "val_silver_scorecard",
    f"""SELECT 'dim_game rows = 82' AS check_name, {verdict("count(*) = 82", PASS, FAIL)} FROM dim_game
        UNION ALL SELECT 'No dirty names in dim_customer', {verdict(f"count(*) FILTER ({DIRTY}) = 0", PASS, FAIL)} FROM dim_customer
        UNION ALL SELECT 'fact_tickets > 10k rows', {verdict("count(*) > 10000", PASS, FAIL)} FROM fact_tickets
        UNION ALL SELECT 'Quarantine table is empty', {verdict("count(*) = 0", PASS, REVIEW)} FROM quarantine_tickets
        UNION ALL SELECT 'Slump promo rate > Hot Start promo rate', {verdict(f"{SLUMP} > {HOT}", PASS, FAIL)} FROM fact_tickets""",
)
def _(t):
    return v.val_silver_scorecard(*map(t, ["dim_game", "dim_customer", "fact_tickets", "quarantine_tickets"]))


@query(
    "val_c360_by_segment",
    f"""SELECT initial_segment, count(*) AS fans, {AVGM("total_spend")} AS avg_spend, {R("avg(games_attended)", 1)} AS avg_games,
        {R("avg(promo_sensitivity)", 3)} AS avg_promo_sensitivity, {R("avg(days_since_last)", 0)} AS avg_days_since_last,
        count(*) FILTER (is_churn_risk) AS churn_risk_count FROM customer_360 GROUP BY initial_segment""",
)
def _(t):
    return v.val_c360_by_segment(t("customer_360"))


@query(
    "val_revenue_by_phase",
    f"""SELECT season_phase, count(*) AS games, {R(f"sum({M('gross_revenue')})", 2)} AS total_gross_revenue,
        {R(f"sum({M('total_discount_given')})", 2)} AS total_discounts, {R(f"sum({M('net_revenue')})", 2)} AS total_net_revenue,
        {R("avg(arena_fill_pct) * 100", 1)} AS avg_fill_pct, {R("avg(promo_rate) * 100", 1)} AS avg_promo_rate_pct
        FROM game_revenue GROUP BY season_phase""",
)
def _(t):
    return v.val_revenue_by_phase(t("game_revenue"))


@query(
    "val_churn_by_phase",
    f"""SELECT acquisition_phase, count(*) AS fans, count(*) FILTER (churn_flag) AS churned, {P("churn_flag")} AS churn_rate_pct,
        {R("avg(days_since_last)", 0)} AS avg_days_since_last, count(*) FILTER (c.returned_30d) AS returned_30d,
        {P("c.returned_30d")} AS return_30d_rate_pct FROM retention_cohort c GROUP BY acquisition_phase""",
)
def _(t):
    return v.val_churn_by_phase(t("retention_cohort"))


@query(
    "val_event_cohort_return",
    f"""SELECT is_jersey_night_cohort, count(*) AS fans, {P("returned_30d")} AS return_30d_rate_pct,
        {R("avg(days_since_last)", 0)} AS avg_days_since_last FROM retention_cohort GROUP BY 1""",
)
def _(t):
    return v.val_event_cohort_return(t("retention_cohort"))


@query(
    "val_features_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n_values, {R(f"avg({c})", 4)} AS mean, {R(f"min({c})", 4)} AS min,
        {R(f"quantile_cont({c}, 0.25)", 4)} AS p25, {R(f"quantile_cont({c}, 0.75)", 4)} AS p75, {R(f"max({c})", 4)} AS max FROM fan_features"""
        for c in v.SUMMARY_FEATURES
    ),
)
def _(t):
    return v.val_features_summary(t("fan_features"))


@query(
    "val_feature_nulls",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM fan_features" for c in v.REQUIRED_FEATURES
    ),
)
def _(t):
    return v.val_feature_nulls(t("fan_features"))


@query("val_churn_rate", f"SELECT {R('avg(churn_flag) * 100', 1)} AS churn_rate_pct FROM fan_features")
def _(t):
    return v.val_churn_rate(t("fan_features"))


@query("val_ml_counts", _counts(MODELS, '"rows"'))
def _(t):
    return v.val_ml_counts({n: t(n) for n in MODELS})


@query(
    "val_segment_dist",
    f"""SELECT segment_label, count(*) AS fan_count, {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER ()", 1)} AS pct_of_total
        FROM ml_fan_segments GROUP BY 1""",
)
def _(t):
    return v.val_segment_dist(t("ml_fan_segments"))


@query(
    "val_tier_dist",
    f"""SELECT risk_tier, count(*) AS fans, {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER ()", 1)} AS pct_of_total,
        {R("avg(churn_probability)", 3)} AS avg_prob, {R("min(churn_probability)", 3)} AS min_prob,
        {R("max(churn_probability)", 3)} AS max_prob FROM ml_churn_scores GROUP BY 1""",
)
def _(t):
    return v.val_tier_dist(t("ml_churn_scores"))


HIGH = "count(*) FILTER (risk_tier = 'High')"


@query(
    "val_segment_story",
    f"""SELECT segment_label, count(*) AS fans, {R("avg(churn_probability)", 3)} AS avg_churn_prob,
        {R("avg(frequency_games)", 1)} AS avg_games, {AVGM("monetary_net")} AS avg_net_spend,
        {R("avg(promo_sensitivity)", 3)} AS avg_promo_sensitivity, {R("avg(recency_days)", 0)} AS avg_recency_days,
        {HIGH} AS high_risk_count
        FROM ml_fan_segments JOIN ml_churn_scores USING (customer_id) JOIN fan_features USING (customer_id) GROUP BY 1""",
)
def _(t):
    return v.val_segment_story(*map(t, ["ml_fan_segments", "ml_churn_scores", "fan_features"]))


@query(
    "val_cohort_risk",
    f"""SELECT is_jersey_night_cohort, count(*) AS fans, {R("avg(churn_probability)", 3)} AS avg_churn_prob,
        {HIGH} AS high_risk_count, {P("risk_tier = 'High'")} AS high_risk_pct
        FROM ml_churn_scores JOIN fan_features USING (customer_id) GROUP BY 1""",
)
def _(t):
    return v.val_cohort_risk(t("ml_churn_scores"), t("fan_features"))


@query(
    "val_watchlist20",
    f"""SELECT full_name, email, acquisition_channel, segment_label, {R("c.churn_probability", 3)} AS churn_probability, risk_tier,
        {R("monetary_net", 2)} AS lifetime_net_spend, frequency_games AS games_attended, recency_days AS days_since_last_game
        FROM ml_churn_scores c JOIN ml_fan_segments USING (customer_id) JOIN fan_features USING (customer_id)
        JOIN (SELECT customer_id, full_name, email, acquisition_channel FROM dim_customer) USING (customer_id)
        WHERE risk_tier = 'High' AND frequency_games >= 2 AND monetary_net >= 50
        ORDER BY c.churn_probability DESC, customer_id LIMIT 20""",
)
def _(t):
    return v.val_watchlist20(*map(t, ["ml_churn_scores", "ml_fan_segments", "fan_features", "dim_customer"]))


SEG_AVG = "(SELECT avg(churn_probability) FROM ml_churn_scores JOIN ml_fan_segments USING (customer_id) WHERE segment_label = '{}')"


@query(
    "val_ml_scorecard",
    f"""SELECT 'fan_features table exists' AS check_name, {verdict("count(*) > 0", PASS, FAIL)} FROM fan_features
        UNION ALL SELECT 'ml_fan_segments has 5 distinct labels', {verdict("count(DISTINCT segment_label) = 5", PASS, "'❌ FAIL - review segment labels'")} FROM ml_fan_segments
        UNION ALL SELECT 'ml_churn_scores has all 3 risk tiers', {verdict("count(DISTINCT risk_tier) = 3", PASS, FAIL)} FROM ml_churn_scores
        UNION ALL SELECT 'Lapsed segment has highest avg churn probability',
          {verdict(SEG_AVG.format("Lapsed") + " > " + SEG_AVG.format("Season Core"), PASS, "'❌ FAIL - model may need review'")}
        UNION ALL SELECT 'No null churn probabilities', {verdict("count(*) FILTER (churn_probability IS NULL) = 0", PASS, FAIL)} FROM ml_churn_scores""",
)
def _(t):
    return v.val_ml_scorecard(*map(t, MODELS))


@query(
    "val_segments_vs_c360",
    f"""SELECT segment_label, count(*) AS fan_count, {AVGM("total_spend")} AS avg_total_spend, {R("avg(games_attended)", 1)} AS avg_games_attended,
        {R("avg(days_since_last)", 0)} AS avg_days_since_last, {R("avg(promo_sensitivity)", 3)} AS avg_promo_sensitivity,
        {R("avg(tenure_days)", 0)} AS avg_tenure_days, count(*) FILTER (is_churn_risk) AS churn_risk_count
        FROM ml_fan_segments LEFT JOIN customer_360 USING (customer_id) GROUP BY 1""",
)
def _(t):
    return v.val_segments_vs_c360(t("ml_fan_segments"), t("customer_360"))


@query(
    "val_scores_vs_segments",
    f"""SELECT segment_label, count(*) AS fans, {R("avg(churn_probability)", 3)} AS avg_churn_prob, {HIGH} AS high_risk_count,
        {P("risk_tier = 'High'")} AS high_risk_pct
        FROM ml_churn_scores LEFT JOIN ml_fan_segments USING (customer_id) GROUP BY 1""",
)
def _(t):
    return v.val_scores_vs_segments(t("ml_churn_scores"), t("ml_fan_segments"))
