"""The stored tables restated as SQL over the driver's parquet views."""

from __future__ import annotations

import re

SHIFT = 9000
AS_OF = "2001-11-30"


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding on a decimal grid; both engines agree on it."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def _phase(n: str) -> str:
    return (
        f"CASE WHEN {n} >= 1 AND {n} <= 22 THEN 'hot_start' WHEN {n} >= 23 AND {n} <= 52 THEN 'slump' "
        f"WHEN {n} >= 53 AND {n} <= 72 THEN 'late_push' WHEN {n} = 77 THEN 'jersey_night' "
        f"WHEN {n} >= 78 AND {n} <= 82 THEN 'post_jersey' ELSE 'bridge' END"
    )


def _number(d: str) -> str:
    return f"CAST((year({d}) - 1995) * 12 + month({d}) AS BIGINT)"


def _game(n: str) -> str:
    return f"'EV-' || lpad(CAST({n} AS VARCHAR), 3, '0')"


def _initcap(expr: str) -> str:
    words = f"string_split(lower(trim({expr})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _lead(date: str, ts: str) -> str:
    return f"CAST(date_diff('day', CAST({ts} AS DATE), {date}) AS INTEGER)"


R = rounded

TABLES: dict[str, str] = {
    "raw_events": f"""
        SELECT {_game('game_number')} AS game_id, game_number, game_date,
               'Guest ' || CAST(month(game_date) AS VARCHAR) AS opponent,
               month(game_date) NOT IN (6, 12) AS is_home_game, 'Main Hall' AS arena,
               home_score, attendance - home_score AS away_score,
               CASE WHEN home_score >= attendance - home_score THEN 'W' ELSE 'L' END AS result,
               attendance,
               CAST(attendance AS DOUBLE) / max(attendance) OVER () AS arena_fill_pct,
               'regular' AS season_type, {_phase('game_number')} AS season_phase,
               game_number = 77 AS is_jersey_night, game_number = 23 AS is_star_injury_game
        FROM (SELECT {_number('l_shipdate')} AS game_number,
                     max(last_day(CAST(l_shipdate AS DATE))) AS game_date,
                     count(*) AS attendance, count(*) FILTER (l_linestatus = 'F') AS home_score
              FROM lineitem GROUP BY 1)""",
    "raw_customers": """
        SELECT id AS customer_id,
               CASE WHEN chan = 'machinery' THEN upper(nm) WHEN chan = 'building' THEN '  ' || nm || '  ' ELSE nm END AS full_name,
               CASE WHEN bal >= -900 THEN replace(nm, '#', '.') || '@Example.COM' END AS email,
               '555-' || id AS phone, lpad(CAST(nat AS VARCHAR), 5, '0') AS zip_code,
               CASE WHEN n_nationkey IS NULL THEN NULL WHEN r_name = 'EUROPE' THEN 'MT' ELSE 'ID' END AS state,
               chan AS acquisition_channel, lower(r_name) AS initial_segment,
               bal >= 8000 AS is_season_holder,
               DATE '1994-06-01' + CAST(floor((bal + 1000) / 20) AS INTEGER) AS signup_date,
               bal >= 5000 AND bal <= 5500 AS is_jersey_night_acq, bal < -500 AS is_deeply_lapsed
        FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nm, c_nationkey AS nat, c_acctbal AS bal,
                     lower(c_mktsegment) AS chan FROM customer
              UNION ALL
              SELECT 'S-' || CAST(s_suppkey AS VARCHAR), s_name, s_nationkey, s_acctbal, 'corporate' FROM supplier)
        LEFT JOIN nation ON nat = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "raw_customers_stream": f"""
        SELECT 'U-' || u AS customer_id, 'new user ' || u AS full_name, 'U' || u || '@Example.COM' AS email,
               '556-' || u AS phone, '00099' AS zip_code, 'ID' AS state, kind AS acquisition_channel,
               'digital' AS initial_segment, top >= 200 AS is_season_holder, seen - {SHIFT} AS signup_date,
               FALSE AS is_jersey_night_acq, FALSE AS is_deeply_lapsed
        FROM (SELECT CAST(user_id AS VARCHAR) AS u, min(CAST(ts AS DATE)) AS seen, min(event_type) AS kind,
                     max(value) AS top FROM events GROUP BY user_id)""",
    "raw_tickets": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ticket_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, {_game(_number('l_shipdate'))} AS game_id,
               last_day(CAST(l_shipdate AS DATE)) AS game_date, p_type AS section_tier,
               CAST(l_linenumber AS VARCHAR) AS seat_row, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS seat_number,
               CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS ticket_price,
               o_orderpriority AS purchase_channel, CAST(o_orderdate AS DATE) AS purchase_ts,
               l_discount > CAST(0.05 AS DOUBLE) AS is_promo_ticket,
               {_number('l_shipdate')} = 77 AS is_jersey_night_game,
               {_number('l_shipdate')} = 77 AND o_orderpriority = '1-URGENT' AS is_lapsed_reactivation,
               {_phase(_number('l_shipdate'))} AS season_phase
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "raw_tickets_stream": f"""
        SELECT CASE WHEN k <> 11 THEN 'E-' || CAST(event_id AS VARCHAR) END AS ticket_id,
               CASE WHEN k <> 22 THEN 'U-' || CAST(user_id AS VARCHAR) END AS customer_id,
               CASE WHEN k <> 33 THEN {_game(_number('d'))} END AS game_id, last_day(d) AS game_date,
               CASE WHEN k < 20 THEN 'SMALL' WHEN k < 40 THEN 'STANDARD' WHEN k < 60 THEN 'MEDIUM'
                    WHEN k < 80 THEN 'LARGE' ELSE 'ECONOMY' END AS section_tier,
               'GA' AS seat_row, CAST(k AS VARCHAR) AS seat_number,
               CASE WHEN k <> 44 THEN CAST(value - 5 AS DECIMAL(18,4)) END AS ticket_price,
               'mobile_app' AS purchase_channel, d AS purchase_ts, k >= 70 AS is_promo_ticket,
               FALSE AS is_jersey_night_game, FALSE AS is_lapsed_reactivation, {_phase(_number('d'))} AS season_phase
        FROM (SELECT event_id, user_id, value, CAST(ts AS DATE) - {SHIFT} AS d,
                     CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
              FROM events WHERE event_type = 'purchase')""",
    "raw_tickets_all": "SELECT * FROM raw_tickets UNION ALL SELECT * FROM raw_tickets_stream",
    "raw_promotions": f"""
        SELECT 'P-' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS promo_id,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ticket_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, {_game(_number('l_shipdate'))} AS game_id,
               l_returnflag AS promo_type, l_discount AS discount_pct, l_extendedprice AS face_value,
               CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS discount_amount,
               l_returnflag <> 'R' AS redeemed, {_phase(_number('l_shipdate'))} AS season_phase
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount > CAST(0.05 AS DOUBLE)""",
    "dim_game": f"""
        SELECT game_id, game_number, game_date, opponent, is_home_game, arena, home_score, away_score, result,
               CAST(result = 'W' AS INTEGER) AS result_numeric, attendance,
               {R('arena_fill_pct', 3)} AS arena_fill_pct, season_type, season_phase, is_jersey_night,
               is_star_injury_game, season_phase IN ('late_push', 'jersey_night', 'post_jersey') AS is_playoff_relevant,
               CAST(sum(CAST(result = 'W' AS INTEGER)) OVER (ORDER BY game_number) AS BIGINT) AS wins_to_date
        FROM raw_events""",
    "dim_customer": f"""
        SELECT customer_id, {_initcap('full_name')} AS full_name, lower(trim(email)) AS email, phone, zip_code, state,
               acquisition_channel, initial_segment, is_season_holder, signup_date, is_jersey_night_acq,
               is_deeply_lapsed, CAST(date_diff('day', signup_date, DATE '{AS_OF}') AS INTEGER) AS tenure_days,
               record_source
        FROM (SELECT *, 'seed' AS record_source FROM raw_customers
              UNION ALL SELECT *, 'simulator' FROM raw_customers_stream)
        WHERE customer_id IS NOT NULL AND email IS NOT NULL""",
    "fact_all": f"""
        SELECT ticket_id, customer_id, game_id, game_date, section_tier,
               CASE section_tier WHEN 'PROMO' THEN 5 WHEN 'LARGE' THEN 4 WHEN 'MEDIUM' THEN 3
                                 WHEN 'STANDARD' THEN 2 WHEN 'SMALL' THEN 1 END AS seat_tier_rank,
               TRY_CAST(seat_row AS INTEGER) AS seat_row, TRY_CAST(seat_number AS INTEGER) AS seat_number,
               ticket_price, purchase_channel, purchase_ts, is_promo_ticket, is_jersey_night_game,
               is_lapsed_reactivation, season_phase, {_lead('game_date', 'purchase_ts')} AS days_before_game,
               coalesce({_lead('game_date', 'purchase_ts')} > 3, FALSE) AS is_advance_purchase
        FROM raw_tickets_all""",
    "fact_tickets": """
        SELECT * FROM fact_all
        WHERE ticket_id IS NOT NULL AND customer_id IS NOT NULL AND game_id IS NOT NULL AND ticket_price > 0""",
    "quarantine_tickets": """
        SELECT ticket_id, customer_id, game_id, CAST(ticket_price AS DOUBLE) AS ticket_price, purchase_channel, season_phase,
               CASE WHEN ticket_id IS NULL THEN 'null_ticket_id' WHEN customer_id IS NULL THEN 'null_customer_id'
                    WHEN game_id IS NULL THEN 'null_game_id' ELSE 'invalid_price' END AS quarantine_reason
        FROM raw_tickets_all
        WHERE ticket_id IS NULL OR customer_id IS NULL OR game_id IS NULL OR ticket_price <= 0""",
    "bridge_promo": f"""
        SELECT promo_id, ticket_id, customer_id, game_id, promo_type, {R('discount_pct', 4)} AS discount_pct,
               {R('face_value', 2)} AS face_value, {R('discount_amount', 2)} AS discount_amount, redeemed, season_phase,
               {R('discount_pct * face_value', 2)} AS promo_impact_score,
               CASE WHEN discount_pct >= CAST(0.09 AS DOUBLE) THEN 'deep'
                    WHEN discount_pct >= CAST(0.07 AS DOUBLE) THEN 'moderate' ELSE 'light' END AS discount_tier
        FROM raw_promotions WHERE redeemed""",
    "mode_section": """
        SELECT customer_id, arg_min(section_tier, (-n, section_tier)) AS preferred_section
        FROM (SELECT customer_id, section_tier, count(*) AS n FROM fact_tickets GROUP BY ALL) GROUP BY 1""",
    "mode_depth": """
        SELECT customer_id, arg_min(discount_tier, (-n, discount_tier)) AS most_common_discount_tier
        FROM (SELECT customer_id, discount_tier, count(*) AS n FROM bridge_promo GROUP BY ALL) GROUP BY 1""",
    "ticket_agg": f"""
        SELECT customer_id, {R('sum(ticket_price)', 2)} AS total_spend, {R('avg(ticket_price)', 2)} AS avg_ticket_price,
               {R('max(ticket_price)', 2)} AS max_ticket_price, count(DISTINCT game_id) AS games_attended,
               count(ticket_id) AS total_tickets,
               CAST(date_diff('day', max(game_date), DATE '{AS_OF}') AS INTEGER) AS days_since_last,
               count(*) FILTER (is_promo_ticket) AS promo_tickets,
               {R('CAST(count(*) FILTER (is_promo_ticket) AS DOUBLE) / count(*)', 4)} AS promo_rate,
               count(*) FILTER (is_advance_purchase) AS advance_purchases,
               {R('avg(days_before_game)', 1)} AS avg_days_before_game,
               {R('avg(seat_tier_rank)', 2)} AS avg_seat_tier_rank,
               bool_or(coalesce(is_jersey_night_game, FALSE)) AS jersey_night_attendee,
               bool_or(coalesce(is_lapsed_reactivation, FALSE)) AS was_lapsed_reactivation,
               bool_or(coalesce(event_phase = 'hot_start', FALSE)) AS hot_start_buyer,
               bool_or(coalesce(event_phase = 'slump', FALSE)) AS slump_buyer,
               bool_or(coalesce(event_phase = 'late_push', FALSE)) AS late_push_buyer,
               count(DISTINCT purchase_channel) AS channels_used, any_value(preferred_section) AS preferred_section
        FROM fact_tickets LEFT JOIN mode_section USING (customer_id)
             LEFT JOIN (SELECT game_id, season_phase AS event_phase FROM dim_game) USING (game_id)
        GROUP BY customer_id""",
    "promo_agg": f"""
        SELECT customer_id, {R('sum(discount_amount)', 2)} AS total_discount_received,
               {R('avg(promo_impact_score)', 2)} AS avg_promo_impact_score,
               any_value(most_common_discount_tier) AS most_common_discount_tier
        FROM bridge_promo LEFT JOIN mode_depth USING (customer_id) GROUP BY customer_id""",
    "customer_360": f"""
        SELECT c.customer_id, full_name, email, zip_code, acquisition_channel, initial_segment, is_season_holder,
               signup_date, tenure_days, is_jersey_night_acq, is_deeply_lapsed, record_source,
               total_spend, avg_ticket_price, max_ticket_price, games_attended, total_tickets, days_since_last,
               coalesce(promo_tickets, 0) AS promo_tickets, coalesce(promo_rate, 0) AS promo_rate, advance_purchases,
               avg_days_before_game, preferred_section, avg_seat_tier_rank, jersey_night_attendee,
               was_lapsed_reactivation, hot_start_buyer, slump_buyer, late_push_buyer, channels_used,
               coalesce(total_discount_received, 0) AS total_discount_received, avg_promo_impact_score,
               most_common_discount_tier,
               {R("coalesce(promo_rate, 0) * CAST(0.7 AS DOUBLE) + CAST(CASE most_common_discount_tier WHEN 'deep' THEN 0.3 WHEN 'moderate' THEN 0.15 ELSE 0 END AS DOUBLE)", 4)} AS promo_sensitivity,
               coalesce(days_since_last > 45, FALSE) AS is_churn_risk,
               {R('coalesce(total_spend, 0) - coalesce(total_discount_received, 0)', 2)} AS revenue_net
        FROM dim_customer c LEFT JOIN ticket_agg USING (customer_id) LEFT JOIN promo_agg USING (customer_id)""",
    "event_agg": f"""
        SELECT game_id, {R('sum(ticket_price)', 2)} AS gross_revenue, {R('avg(ticket_price)', 2)} AS avg_ticket_price,
               {R('max(ticket_price)', 2)} AS max_ticket_price, {R('min(ticket_price)', 2)} AS min_ticket_price,
               count(ticket_id) AS tickets_sold, count(DISTINCT customer_id) AS unique_buyers,
               count(*) FILTER (is_promo_ticket) AS promo_tickets,
               {R('CAST(count(*) FILTER (is_promo_ticket) AS DOUBLE) / count(*)', 4)} AS promo_rate,
               {R('avg(days_before_game)', 1)} AS avg_days_before_game,
               count(*) FILTER (is_advance_purchase) AS advance_purchase_count,
               bool_or(is_lapsed_reactivation) AS had_lapsed_reactivation,
               count(*) FILTER (is_lapsed_reactivation) AS lapsed_reactivation_count,
               {R('CAST(count(*) FILTER (seat_tier_rank >= 4) AS DOUBLE) / count(*)', 4)} AS premium_seat_rate
        FROM fact_tickets GROUP BY game_id""",
    "event_promo": f"""
        SELECT game_id, {R('sum(discount_amount)', 2)} AS total_discount_given,
               {R('avg(discount_pct) * 100', 1)} AS avg_discount_pct,
               count(*) FILTER (discount_tier = 'deep') AS deep_discount_count
        FROM bridge_promo GROUP BY game_id""",
    "game_revenue": f"""
        SELECT g.*, e.* EXCLUDE (game_id), coalesce(p.total_discount_given, 0) AS total_discount_given,
               p.avg_discount_pct, p.deep_discount_count,
               {R('coalesce(gross_revenue, 0) - coalesce(p.total_discount_given, 0)', 2)} AS net_revenue,
               {R('coalesce(gross_revenue, 0) / 6200', 2)} AS revenue_per_seat,
               {R('sum(CAST(coalesce(gross_revenue, 0) AS DECIMAL(18,4))) OVER (ORDER BY game_number)', 2)} AS cumulative_revenue,
               {R('avg(arena_fill_pct) OVER (ORDER BY game_number ROWS 2 PRECEDING)', 3)} AS fill_rate_3game_avg,
               {R('coalesce(gross_revenue, 0) / avg(coalesce(gross_revenue, 0)) OVER ()', 3)} AS revenue_index
        FROM dim_game g LEFT JOIN event_agg e ON g.game_id = e.game_id LEFT JOIN event_promo p ON g.game_id = p.game_id""",
    "second_visit": """
        SELECT customer_id, min(game_date) AS second_purchase_date
        FROM (SELECT customer_id, game_date, dense_rank() OVER (PARTITION BY customer_id ORDER BY game_date) AS dr
              FROM fact_tickets) WHERE dr = 2 GROUP BY customer_id""",
    "customer_timeline": f"""
        SELECT customer_id, min(game_date) AS first_purchase_date, max(game_date) AS last_purchase_date,
               count(DISTINCT game_id) AS total_games, {R('sum(ticket_price)', 2)} AS total_spend,
               arg_min(season_phase, (game_date, game_id)) AS acquisition_phase,
               bool_or(is_jersey_night_game) AS attended_jersey_night, bool_or(is_promo_ticket) AS ever_used_promo,
               {R('CAST(count(*) FILTER (is_promo_ticket) AS DOUBLE) / count(*)', 4)} AS overall_promo_rate
        FROM fact_tickets GROUP BY customer_id""",
    "retention_cohort": """
        SELECT t.*, second_purchase_date, acquisition_channel, initial_segment, is_season_holder, tenure_days,
               is_jersey_night_acq,
               CAST(date_diff('day', first_purchase_date, second_purchase_date) AS INTEGER) AS days_to_second_purchase,
               coalesce(date_diff('day', first_purchase_date, second_purchase_date) <= 30, FALSE) AS returned_30d,
               coalesce(date_diff('day', first_purchase_date, second_purchase_date) <= 60, FALSE) AS returned_60d,
               date_diff('day', last_purchase_date, last_event) > 45 AS churn_flag,
               CAST(date_diff('day', last_purchase_date, last_event) AS INTEGER) AS days_since_last,
               total_games = 1 AS is_one_and_done, total_spend >= 300 AS is_high_value,
               attended_jersey_night OR is_jersey_night_acq AS is_jersey_night_cohort
        FROM customer_timeline t LEFT JOIN second_visit USING (customer_id) LEFT JOIN dim_customer USING (customer_id)
        CROSS JOIN (SELECT max(game_date) AS last_event FROM dim_game)""",
    "fan_features": f"""
        SELECT c.customer_id, coalesce(c.days_since_last, 999) AS recency_days,
               coalesce(games_attended, 0) AS frequency_games, revenue_net AS monetary_net,
               coalesce(c.total_spend, 0) AS monetary_gross, promo_sensitivity, promo_rate, total_discount_received,
               {R('CAST(coalesce(advance_purchases, 0) AS DOUBLE) / greatest(coalesce(total_tickets, 1), 1)', 4)} AS advance_purchase_rate,
               coalesce(avg_days_before_game, 0) AS avg_days_before_game,
               coalesce(avg_seat_tier_rank, 3) AS avg_seat_tier_rank, coalesce(c.tenure_days, 0) AS tenure_days,
               CAST(c.is_season_holder AS INTEGER) AS is_season_holder, coalesce(channels_used, 1) AS channels_used,
               CAST(jersey_night_attendee AS INTEGER) AS jersey_night_attendee,
               CAST(hot_start_buyer AS INTEGER) AS hot_start_buyer, CAST(slump_buyer AS INTEGER) AS slump_buyer,
               CAST(late_push_buyer AS INTEGER) AS late_push_buyer,
               CAST(was_lapsed_reactivation AS INTEGER) AS was_lapsed_reactivation,
               coalesce(CAST(churn_flag AS INTEGER), 1) AS churn_flag,
               coalesce(r.days_since_last, 999) AS cohort_days_since_last,
               coalesce(CAST(returned_30d AS INTEGER), 0) AS returned_30d,
               coalesce(CAST(returned_60d AS INTEGER), 0) AS returned_60d,
               coalesce(CAST(is_one_and_done AS INTEGER), 1) AS is_one_and_done,
               coalesce(CAST(is_jersey_night_cohort AS INTEGER), 0) AS is_jersey_night_cohort
        FROM customer_360 c LEFT JOIN retention_cohort r USING (customer_id)""",
    "ml_churn_scores": f"""
        SELECT customer_id, churn_probability,
               CASE WHEN churn_probability <= CAST(0.4 AS DOUBLE) THEN 'Low'
                    WHEN churn_probability <= CAST(0.7 AS DOUBLE) THEN 'Medium' ELSE 'High' END AS risk_tier,
               TIMESTAMP '{AS_OF} 00:00:00' AS scored_at, 'rule_v1' AS model_version, 'rule_churn' AS model_name
        FROM (SELECT customer_id,
                     {R('least(1, greatest(0, CAST(0.95 AS DOUBLE) - CAST(0.012 AS DOUBLE) * frequency_games + CAST(0.2 AS DOUBLE) * promo_rate))', 4)} AS churn_probability
              FROM fan_features)""",
    "ml_fan_segments": f"""
        SELECT customer_id, CASE segment_label WHEN 'Season Core' THEN 0 WHEN 'High Value New' THEN 1 WHEN 'Casual Fan' THEN 2
                    WHEN 'Promo Hunter' THEN 3 ELSE 4 END AS segment_id, segment_label,
               CAST(0 AS DOUBLE) AS distance_to_centroid, TIMESTAMP '{AS_OF} 00:00:00' AS scored_at,
               'rule_v1' AS model_version, 'rule_segments' AS model_name
        FROM (SELECT customer_id,
                     CASE WHEN recency_days > 240 THEN 'Lapsed' WHEN promo_sensitivity >= CAST(0.45 AS DOUBLE) THEN 'Promo Hunter'
                          WHEN frequency_games >= 33 THEN 'Season Core' WHEN tenure_days < 2500 THEN 'High Value New'
                          ELSE 'Casual Fan' END AS segment_label
              FROM fan_features)""",
}


def _needed(sql: str, seen: list[str]) -> None:
    for name in TABLES:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            _needed(TABLES[name], seen)
            if name not in seen:
                seen.append(name)


def compose(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it refers to, in dependency order."""
    seen: list[str] = []
    _needed(sql, seen)
    if not seen:
        return sql
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in seen)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
