"""Silver and gold tables on small hand-made inputs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gatefold.plans import gold, silver

D = dt.date
EVENT = (
    "game_id string, game_number bigint, game_date date, opponent string, is_home_game boolean, arena string, "
    "home_score bigint, away_score bigint, result string, attendance bigint, arena_fill_pct double, "
    "season_type string, season_phase string, is_jersey_night boolean, is_star_injury_game boolean"
)
CUSTOMER = (
    "customer_id string, full_name string, email string, phone string, zip_code string, state string, "
    "acquisition_channel string, initial_segment string, is_season_holder boolean, signup_date date, "
    "is_jersey_night_acq boolean, is_deeply_lapsed boolean"
)
TICKET = (
    "ticket_id string, customer_id string, game_id string, game_date date, section_tier string, seat_row string, "
    "seat_number string, ticket_price double, purchase_channel string, purchase_ts timestamp, is_promo_ticket boolean, "
    "is_jersey_night_game boolean, is_lapsed_reactivation boolean, season_phase string"
)
PROMO = (
    "promo_id string, ticket_id string, customer_id string, game_id string, promo_type string, discount_pct double, "
    "face_value double, discount_amount double, redeemed boolean, season_phase string"
)
LAST = D(2024, 6, 30)


def event(n, date, fill, phase="slump", result="W"):
    return (f"g{n}", n, date, "X", True, "A", 3, 2, result, 100, fill, "regular", phase, n == 3, False)


def person(cid, name="Ann Lee", email="a@b.c", acq=False):
    return (cid, name, email, "1", "0", "ID", "walk_up", "core", False, D(2024, 1, 1), acq, False)


def ticket(tid, cid, gid, date, price, section="mid_bowl", lead=5, promo=False, jersey=False, phase="slump", channel="online", lapsed=False):
    ts = None if lead is None else dt.datetime.combine(date - dt.timedelta(days=lead), dt.time(20))
    return (tid, cid, gid, date, section, "7", "12", price, channel, ts, promo, jersey, lapsed, phase)


@pytest.fixture(scope="module")
def world(spark):
    events = [
        event(1, D(2024, 1, 1), 0.9), event(2, D(2024, 1, 31), 0.6, result="L"),
        event(3, D(2024, 2, 1), 0.3, "jersey_night"), event(4, D(2024, 5, 15), 0.5), event(5, LAST, 0.7, "late_push"),
    ]
    tickets = [
        ticket("t1", "one", "g1", D(2024, 1, 1), 10.0), ticket("t2", "one", "g1", D(2024, 1, 1), 20.0, promo=True),
        ticket("t3", "d30", "g1", D(2024, 1, 1), 100.0), ticket("t4", "d30", "g2", D(2024, 1, 31), 200.0, section="vip"),
        ticket("t5", "d31", "g1", D(2024, 1, 1), 1.0, phase="hot_start"),
        ticket("t6", "d31", "g3", D(2024, 2, 1), 2.0, jersey=True, lapsed=True, section="rinkside"),
        ticket("t7", "d45", "g4", D(2024, 5, 16), 5.0, lead=3), ticket("t8", "d46", "g4", D(2024, 5, 15), 5.0, lead=4, channel="reseller"),
        ticket("t9", "stranger", "g1", D(2024, 1, 1), 9.0),
        ticket("bad1", None, "g1", D(2024, 1, 1), 9.0), ticket("bad2", "one", "g1", D(2024, 1, 1), 0.0),
        ticket("bad3", "one", "g1", D(2024, 1, 1), None),
    ]
    people = [person(c) for c in ("one", "d30", "d31", "d45", "d46")] + [person("idle", acq=True), person("mute", email=None)]
    promos = [
        ("p1", "t2", "one", "g1", "x", 0.40, 33.335, 13.33, True, "slump"),
        ("p2", "t3", "d30", "g1", "x", 0.3999, 10.0, 4.0, True, "slump"),
        ("p3", "t4", "d30", "g2", "x", 0.20, 10.0, 2.0, True, "slump"),
        ("p4", "t4", "d30", "g2", "x", 0.1999, 10.0, 2.0, True, "slump"),
        ("p5", "t1", "one", "g1", "x", 0.5, 10.0, 5.0, False, "slump"),
        ("p6", "t1", "one", "g1", "x", 0.5, 10.0, 5.0, None, "slump"),
    ]
    raw = {
        "events": spark.createDataFrame(events, EVENT), "people": spark.createDataFrame(people, CUSTOMER),
        "tickets": spark.createDataFrame(tickets, TICKET), "promos": spark.createDataFrame(promos, PROMO),
    }
    dim_g = silver.build_dim_game(raw["events"])
    dim_c = silver.build_dim_customer(raw["people"], raw["people"].limit(0), str(LAST))
    fact = silver.build_fact(raw["tickets"], raw["tickets"].limit(0))
    bridge = silver.build_bridge_promo(raw["promos"])
    return {**raw, "dim_g": dim_g, "dim_c": dim_c, "fact": fact, "bridge": bridge}


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_dim_game(world):
    got = by(world["dim_g"], "game_number")
    assert [got[n].wins_to_date for n in range(1, 6)] == [1, 1, 2, 3, 4]
    assert [got[n].is_playoff_relevant for n in range(1, 6)] == [False, False, True, False, True]
    assert got[2].result_numeric == 0


def test_customers_without_mail_are_dropped_and_tenure_is_relative(world):
    got = by(world["dim_c"], "customer_id")
    assert "mute" not in got and got["one"].tenure_days == (LAST - D(2024, 1, 1)).days
    assert got["one"].record_source == "seed"


def test_fact_gates_and_enrichment(world):
    got = by(world["fact"], "ticket_id")
    assert set(got) == {f"t{i}" for i in range(1, 10)}
    assert got["t1"].ticket_price == Decimal("10.0000")
    assert (got["t7"].days_before_game, got["t7"].is_advance_purchase) == (3, False)
    assert (got["t8"].days_before_game, got["t8"].is_advance_purchase) == (4, True)
    assert got["t4"].seat_tier_rank is None and got["t6"].seat_tier_rank == 5


def test_unknown_purchase_time_and_odd_seats(spark):
    rows = [ticket("a", "c", "g", LAST, 1.0, lead=None), ticket("b", "c", "g", LAST, 1.0, lead=-2)]
    raw = spark.createDataFrame([r[:5] + ("GA", None) + r[7:] for r in rows], TICKET)
    got = by(silver.enrich_ticket(raw), "ticket_id")
    assert (got["a"].days_before_game, got["a"].is_advance_purchase) == (None, False)
    assert got["b"].days_before_game == -2 and got["b"].seat_row is None


def test_bridge_keeps_redeemed_and_tiers_on_the_raw_percentage(world):
    got = by(world["bridge"], "promo_id")
    assert {k: r.discount_tier for k, r in got.items()} == {
        "p1": "deep", "p2": "moderate", "p3": "moderate", "p4": "light",
    }
    assert (got["p1"].face_value, got["p1"].promo_impact_score) == (33.34, 13.33)


def test_quarantine_misses_unknown_prices(world):
    got = by(silver.build_quarantine(world["tickets"]), "ticket_id")
    assert {k: r.quarantine_reason for k, r in got.items()} == {"bad1": "null_customer_id", "bad2": "invalid_price"}


def test_customer_360(world):
    got = by(gold.customer_360(world["dim_c"], world["fact"], world["bridge"], str(LAST)), "customer_id")
    assert set(got) == {"one", "d30", "d31", "d45", "d46", "idle"}
    one, idle = got["one"], got["idle"]
    assert (one.total_spend, one.games_attended, one.total_tickets, one.promo_rate) == (30.0, 1, 2, 0.5)
    assert (one.promo_sensitivity, one.revenue_net, one.is_churn_risk) == (0.65, 16.67, True)
    assert (idle.total_spend, idle.promo_tickets, idle.promo_rate, idle.revenue_net) == (None, 0, 0.0, 0.0)
    assert (idle.days_since_last, idle.is_churn_risk, idle.preferred_section) == (None, False, None)
    assert got["d30"].most_common_discount_tier == "moderate"
    assert (got["d45"].days_since_last, got["d45"].is_churn_risk) == (45, False)
    assert (got["d46"].days_since_last, got["d46"].is_churn_risk) == (46, True)
    assert got["d30"].preferred_section == "mid_bowl" and got["d30"].channels_used == 1
    assert got["d31"].hot_start_buyer and got["d31"].jersey_night_attendee and got["d31"].was_lapsed_reactivation


def test_game_revenue(world):
    got = by(gold.game_revenue(world["dim_g"], world["fact"], world["bridge"], capacity=10), "game_number")
    assert [got[n].cumulative_revenue for n in range(1, 6)] == [140.0, 340.0, 342.0, 352.0, 352.0]
    assert [got[n].fill_rate_3game_avg for n in range(1, 6)] == [0.9, 0.75, 0.6, 0.467, 0.5]
    assert (got[5].gross_revenue, got[5].net_revenue, got[5].promo_rate, got[5].avg_discount_pct) == (None, 0.0, None, None)
    assert (got[5].revenue_index, got[1].revenue_index, got[1].revenue_per_seat) == (0.0, 1.989, 14.0)
    assert (got[1].total_discount_given, got[1].net_revenue, got[1].unique_buyers) == (17.33, 122.67, 4)


def test_retention_cohort(world):
    got = by(gold.retention_cohort(world["fact"], world["dim_c"], world["dim_g"]), "customer_id")
    assert set(got) == {"one", "d30", "d31", "d45", "d46", "stranger"}
    assert got["one"].is_one_and_done and got["one"].second_purchase_date is None and not got["one"].returned_60d
    assert (got["d30"].days_to_second_purchase, got["d30"].returned_30d, got["d30"].is_high_value) == (30, True, True)
    assert (got["d31"].days_to_second_purchase, got["d31"].returned_30d, got["d31"].returned_60d) == (31, False, True)
    assert (got["d45"].days_since_last, got["d45"].churn_flag) == (45, False)
    assert (got["d46"].days_since_last, got["d46"].churn_flag) == (46, True)
    assert got["d31"].acquisition_phase == "hot_start" and got["d31"].is_jersey_night_cohort is True
    assert got["stranger"].is_jersey_night_cohort is None and got["one"].is_jersey_night_cohort is False


def test_features_default_missing_customers(world):
    c360 = gold.customer_360(world["dim_c"], world["fact"], world["bridge"], str(LAST))
    cohort = gold.retention_cohort(world["fact"], world["dim_c"], world["dim_g"])
    features = gold.fan_features(c360, cohort)
    assert len(features.columns) == 25
    idle = by(features, "customer_id")["idle"]
    assert (idle.recency_days, idle.frequency_games, idle.churn_flag, idle.cohort_days_since_last) == (999, 0, 1, 999)
    assert (idle.advance_purchase_rate, idle.avg_seat_tier_rank, idle.channels_used) == (0.0, 3.0, 1)
    assert (idle.is_one_and_done, idle.is_jersey_night_cohort, idle.jersey_night_attendee) == (1, 0, None)


def test_hot_customer_and_hot_event(spark):
    """One customer and one event hold most tickets; totals are still exact."""
    rows = [ticket(f"h{i}", "hot", "g1", D(2024, 1, 1), 1.0) for i in range(600)]
    rows += [ticket(f"c{i}", f"c{i}", "g1" if i % 2 else "g2", D(2024, 1, 1), 2.0) for i in range(200)]
    fact = silver.build_fact(spark.createDataFrame(rows, TICKET).repartition(4), spark.createDataFrame([], TICKET))
    from gatefold.operators.grouping import agg_customer, agg_event

    hot = by(agg_customer(fact, str(LAST)), "customer_id")["hot"]
    assert (hot.total_spend, hot.total_tickets, hot.games_attended) == (600.0, 600, 1)
    events = by(agg_event(fact), "game_id")
    assert (events["g1"].tickets_sold, events["g1"].unique_buyers, events["g1"].gross_revenue) == (700, 101, 800.0)


def test_customer_phases_follow_the_event(spark, world):
    """A ticket whose own phase disagrees counts for the phase of its event."""
    from gatefold.operators.grouping import agg_customer

    events = world["dim_g"].withColumn("season_phase", F.lit("slump"))
    plain, moved = (by(agg_customer(world["fact"], str(LAST), events=e), "customer_id") for e in (None, events))
    assert set(plain) == set(moved)
    known = {r.game_id for r in events.collect()}
    for r in world["fact"].select("customer_id", "game_id").collect():
        if r.game_id in known:
            assert moved[r.customer_id].slump_buyer and not moved[r.customer_id].hot_start_buyer


def test_customer_measures_need_one_scan_of_the_fact(spark, tmp_path, world):
    from gatefold.operators.grouping import agg_customer, agg_event

    world["fact"].write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    for made in (agg_customer(fact, str(LAST)), agg_event(fact)):
        shape = made._jdf.queryExecution().executedPlan().toString()
        assert shape.count("FileScan") == 1 and shape.count("Exchange") <= 3
