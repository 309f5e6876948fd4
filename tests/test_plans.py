"""Shape of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from gatefold import catalog
from gatefold.operators import grouping as g
from gatefold.plans import fan_health
from gatefold.plans.stored import stored

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_star_needs_one_shuffle_for_the_result_only(spark, no_broadcast):
    names = ["ml_churn_scores", "ml_fan_segments", "fan_features", "customer_360", "retention_cohort"]
    shape = plan(fan_health.fh_kpis(*[stored(spark, SF, n) for n in names]))
    assert shape.count("SortMergeJoin") == 4
    assert shape.count("Exchange hashpartitioning") == 0 and shape.count("Exchange SinglePartition") == 1


def test_nth_visit_prunes_before_the_shuffle(spark):
    shape = plan(g.nth_visit(stored(spark, SF, "fact_tickets"), 2))
    assert shape.count("WindowGroupLimit") == 2


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    events = stored(spark, SF, "game_revenue").filter("is_home_game").select("game_number")
    shape = plan(events)
    assert re.search(r"ReadSchema: struct<game_number:bigint,is_home_game:boolean>", shape)
    assert "EqualTo(is_home_game,true)" in shape


def test_history_reads_the_fact_once_and_hash_aggregates(spark):
    shape = plan(g.visit_history(stored(spark, SF, "fact_tickets")))
    assert shape.count("FileScan") == 1 and "SortAggregate" not in shape


def test_top_k_does_not_sort_globally(spark):
    shape = plan(catalog.queries()["topk_watchlist"](spark, SF))
    assert "TakeOrderedAndProject" in shape and "rangepartitioning" not in shape


@pytest.mark.parametrize(
    "name",
    ["mart_customer_360", "mart_retention_cohort", "mart_fact_tickets", "mart_fan_features", "seg_overview",
     "val_phase_profile", "proj_phase_of_event", "join_left_enrich", "dq_split", "win_rank"],
)
def test_no_cartesian_or_nested_loop_and_no_python(spark, name):
    shape = plan(catalog.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in shape


def test_heavy_keys_are_spread_without_adaptive_splitting(spark):
    """A key with a third of all rows is dealt over many tasks, and no row is lost or doubled."""
    from gatefold.operators.joins import salted_join

    fact = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("int").alias("k")
    )
    dim = spark.range(4000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("twice"))
    wanted = {how: fact.join(dim, "k", how) for how in ("inner", "left")}
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how, plain in wanted.items():
            made = salted_join(fact, dim, ["k"], spread=["id"], how=how, heavy_rows=100)
            assert made.select(plain.columns).exceptAll(plain).count() == 0 == plain.exceptAll(made.select(plain.columns)).count()
        tasks = made.select("k", F.spark_partition_id().alias("p")).where("k = 7").groupBy("p").count().collect()
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert salted_join(fact.limit(0), dim, ["k"], how="left").count() == 0


def test_phase_story_scans_the_fact_once(spark, tmp_path):
    from gatefold.plans.validation import val_phase_profile

    rows = [(f"e{i % 4}", ["hot", "slump"][i % 2], f"c{i % 5}", 2.5 * i, i % 3 == 0) for i in range(40)]
    path = str(tmp_path / "fact")
    spark.createDataFrame(rows, "game_id string, season_phase string, customer_id string, ticket_price double, is_promo_ticket boolean").write.parquet(path)
    events = spark.createDataFrame([(f"e{i}", i, 0.5 + i / 10) for i in range(3)], "game_id string, game_number int, arena_fill_pct double")
    story = val_phase_profile(spark.read.parquet(path), events)
    plan = story._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    got = {r.season_phase: (r.games, r.total_tickets, r.unique_buyers) for r in story.collect()}
    assert got == {"hot": (2, 20, 5), "slump": (1, 10, 5)}


def test_customer_measures_need_no_window(spark):
    from gatefold.operators.grouping import agg_customer

    columns = (
        "customer_id string, game_id string, purchase_channel string, section_tier string, season_phase string, "
        "ticket_id string, ticket_price decimal(18,4), game_date date, is_promo_ticket boolean, is_advance_purchase boolean, "
        "days_before_game int, seat_tier_rank int, is_jersey_night_game boolean, is_lapsed_reactivation boolean"
    )
    from datetime import date
    from decimal import Decimal

    def ticket(c, g, ch, s, price):
        return (c, g, ch, s, "slump", f"{c}{g}{ch}{s}", Decimal(price), date(2024, 1, 5), True, False, 3, 4, False, None)

    rows = [ticket("a", "g1", "web", "B", 10), ticket("a", "g1", "web", "A", 20), ticket("a", "g2", None, "B", 30), ticket("a", None, "app", "A", 40), ticket(None, "g1", "web", None, 5)]
    made = agg_customer(spark.createDataFrame(rows, columns), "2024-01-10")
    assert "Window" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {r.customer_id: r for r in made.collect()}
    a = got["a"]
    assert (a.games_attended, a.channels_used, a.preferred_section, a.total_tickets) == (2, 2, "A", 4)
    assert (float(a.total_spend), a.days_since_last, a.promo_rate, a.slump_buyer, a.hot_start_buyer) == (100.0, 5, 1.0, True, False)
    assert (got[None].preferred_section, got[None].games_attended) == (None, 1)


def test_tickets_are_exchanged_once_as_they_are(spark):
    """Combined map-side they would be wider and hardly fewer, and cross twice."""
    fact = stored(spark, SF, "fact_tickets")
    for made in (g.agg_customer(fact, "2024-01-10"), g.visit_history(fact)):
        assert plan(made).count("Exchange hashpartitioning") == 1
    assert plan(g.agg_event(fact)).count("Exchange hashpartitioning") == 2


def test_heavy_keys_are_measured_apart(spark):
    """Heavy customers, the one without an id among them, keep map-side combination; no row changes."""
    who = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    rows = spark.range(6000).select(who.alias("k"), (F.col("id") % 7).alias("e"), "id")

    def measure(part):
        return part.groupBy("k", "e").agg(F.sum("id").alias("s")).groupBy("k").agg(F.count("e").alias("n"), F.sum("s").alias("s"))

    made, wanted = g.per_key(rows, "k", measure, heavy_rows=320), measure(rows)
    assert "Union" in plan(made) and "Union" not in plan(g.per_key(rows, "k", measure))
    assert sorted(made.collect(), key=repr) == sorted(wanted.collect(), key=repr)


def test_tables_are_built_in_tasks_by_the_size_of_the_source(spark):
    from gatefold.plans.stored import SOURCE_BYTES_PER_TASK, sized_tasks

    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    rows = spark.range(10)
    with sized_tasks(spark, 50 * SOURCE_BYTES_PER_TASK):
        assert "id#" in plan(rows.repartition("id")) and re.search(r"hashpartitioning\(id#\d+L, 50\)", plan(rows.repartition("id")))
    assert spark.conf.get(first, None) is None
    with sized_tasks(spark, 1):
        assert spark.conf.get(first) == spark.conf.get("spark.sql.shuffle.partitions")


def test_customer_measures_are_both_aggregations_from_one_reduction(spark):
    """Odd tickets: no event, phase, date, price, channel or section, and one event in two phases."""
    from datetime import date, timedelta
    from decimal import Decimal

    columns = (
        "customer_id string, game_id string, season_phase string, game_date date, ticket_id string, ticket_price decimal(18,4), "
        "purchase_channel string, section_tier string, is_promo_ticket boolean, is_advance_purchase boolean, "
        "days_before_game int, seat_tier_rank int, is_jersey_night_game boolean, is_lapsed_reactivation boolean"
    )
    phases, flags = ["slump", "hot_start", None], [True, False, None]
    at = [(i // 5) % 3 if i % 7 > 3 else 0 for i in range(200)]
    rows = [
        (f"c{i % 7}", None if i % 11 == 0 else f"g{i % 5}", phases[at[i]],
         None if i % 13 == 0 else date(2024, 1, 9) + timedelta(days=i % 5 - 3 * at[i]), None if i % 17 == 0 else f"t{i}",
         None if i % 19 == 0 else Decimal(i), None if i % 6 == 0 else f"ch{i % 4}", None if i % 9 == 0 else f"s{i % 3}",
         flags[i % 3], flags[i % 2], None if i % 8 == 0 else i % 10, None if i % 4 == 0 else i % 5,
         None if i % 7 == 2 else i % 29 == 0, flags[(i // 3) % 3])
        for i in range(200)
    ]
    fact = spark.createDataFrame(rows, columns)
    events = spark.createDataFrame([("g1", "late_push"), ("g2", "hot_start")], "game_id string, season_phase string")
    made = g.customer_measures(fact, "2024-02-01", events=events).cache()
    for names, wanted in ((g.CUSTOMER_MEASURES, g.agg_customer(fact, "2024-02-01", events=events)), (g.HISTORY_MEASURES, g.visit_history(fact))):
        assert {*wanted.columns} == {"customer_id", *names}
        got = made.select(wanted.columns)
        assert got.dtypes == wanted.dtypes
        assert sorted(got.collect(), key=repr) == sorted(wanted.collect(), key=repr)
    made.unpersist()


def test_stored_marts_share_one_pass_over_the_tickets(spark):
    from gatefold.plans.stored import TABLES

    for name in ("customer_360", "retention_cohort"):
        assert "fact_tickets" not in plan(TABLES[name][1](spark, SF))
