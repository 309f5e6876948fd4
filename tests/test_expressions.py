import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatefold import functions as fn
from gatefold.plans.silver import SEASON_PHASES
from gatefold.plans.segments import ATTENDANCE_EDGES, ATTENDANCE_LABELS


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_round_to_is_half_up_on_the_decimal_value(spark):
    assert column(spark, [1.005, 2.675, -1.005, 0.125, None], "double", fn.round_to("v", 2)) == [
        1.01, 2.68, -1.01, 0.13, None,
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=30))
def test_round_to_matches_decimal_arithmetic(spark, cents):
    values = [c / 10000 for c in cents]
    expected = [
        float((Decimal(c) / 10000).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for c in cents
    ]
    assert column(spark, values, "double", fn.round_to("v", 2)) == expected


def test_names_and_emails_are_tidied(spark):
    names = ["JANE DOE", "  bob  ", "mcKay", None]
    assert column(spark, names, "string", fn.clean_name("v")) == ["Jane Doe", "Bob", "Mckay", None]
    assert column(spark, [" A@B.Com "], "string", fn.clean_email("v")) == ["a@b.com"]


def test_phase_ranges_are_inclusive_with_a_default(spark):
    numbers = [1, 22, 23, 52, 53, 72, 73, 76, 77, 78, 82, 83, None]
    assert column(spark, numbers, "int", fn.assign_phase("v", SEASON_PHASES)) == [
        "hot_start", "hot_start", "slump", "slump", "late_push", "late_push", "bridge", "bridge",
        "jersey_night", "post_jersey", "post_jersey", "bridge", "bridge",
    ]


@pytest.mark.parametrize(
    "closed,expected", [("left", ["a", "b", "b", "c", "c"]), ("right", ["a", "a", "b", "b", "c"])]
)
def test_bucket_edges(spark, closed, expected):
    got = column(spark, [0.0, 1.0, 1.5, 2.0, 2.5], "double", fn.bucketize("v", [1, 2], ["a", "b", "c"], closed))
    assert got == expected


def test_bucket_of_null_is_the_last_and_labels_must_fit(spark):
    buckets = fn.bucketize("v", ATTENDANCE_EDGES, ATTENDANCE_LABELS, closed="right")
    assert column(spark, [0, 1, 2, 20, 21, None], "int", buckets) == [
        "0 games", "1 game", "2–3 games", "11–20 games", "21+ games", "21+ games",
    ]
    with pytest.raises(ValueError):
        fn.bucketize("v", [1], ["only one"])


def test_risk_tier_boundaries(spark):
    p = [0.0, 0.40, 0.4000001, 0.70, 0.7000001, 1.0, None]
    assert column(spark, p, "double", fn.risk_tier("v")) == [
        "Low", "Low", "Medium", "Medium", "High", "High", None,
    ]
    assert column(spark, p, "double", fn.risk_tier("v", right_closed=False)) == [
        "Low", "Medium", "Medium", "High", "High", "High", None,
    ]


def test_promo_sensitivity(spark):
    rows = [(0.5, "deep"), (0.5, "moderate"), (0.5, "light"), (0.5, None), (None, "deep"), (None, None)]
    df = spark.createDataFrame(rows, "rate double, tier string").coalesce(1)
    got = [r[0] for r in df.select(fn.promo_sensitivity("rate", "tier")).collect()]
    assert got == [0.65, 0.5, 0.35, 0.35, 0.3, 0.0]


def test_safe_ratio_never_divides_by_zero(spark):
    rows = [(4, 2), (4, 0), (None, 3), (4, None)]
    df = spark.createDataFrame(rows, "a int, b int").coalesce(1)
    got = df.select(fn.safe_ratio("a", "b").alias("x"), fn.safe_ratio("a", "b", floor=1).alias("y")).collect()
    assert [r.x for r in got] == [2.0, None, None, None]
    assert [r.y for r in got] == [2.0, 4.0, 0.0, 4.0]


def test_actions_maps_and_flags(spark):
    df = spark.createDataFrame([(0.6, 1), (0.5, 6), (0.5, 5), (None, None)], "s double, g int").coalesce(1)
    got = [r[0] for r in df.select(fn.recommended_action("s", "g")).collect()]
    assert got == ["Offer discount", "Loyalty reward", "Re-engagement email", "Re-engagement email"]
    assert column(spark, ["a", "z", None], "string", fn.map_values("v", {"a": 1})) == [1, None, None]
    assert column(spark, ["a", "z", None], "string", fn.map_values("v", {"a": 1}, 9)) == [1, 9, 9]
    assert column(spark, [True, False, None], "boolean", fn.flag_to_int("v")) == [1, 0, None]


def test_days_between_uses_dates(spark):
    late = dt.datetime(2024, 1, 1, 23, 59)
    df = spark.createDataFrame([(dt.date(2024, 1, 5), late)], "d date, t timestamp")
    assert df.select(fn.days_between("d", "t")).first()[0] == 4


def test_aggregate_columns_with_nulls(spark):
    df = spark.createDataFrame(
        [("a", True, 10.0), ("a", None, 20.0), ("a", False, None), ("b", None, None)],
        "k string, f boolean, x double",
    )
    got = {
        r.k: r
        for r in df.groupBy("k").agg(
            fn.count_where("f").alias("n"),
            fn.any_flag("f").alias("any"),
            fn.any_flag_nullable("f").alias("any_nullable"),
            fn.max_where("x", "f").alias("top"),
            fn.mean_of("x", 2).alias("mean"),
            fn.pct("f").alias("pct"),
            fn.pct(F.col("f"), of=F.col("x") > 15).alias("pct_of"),
            fn.count_distinct_where("x", "f").alias("d"),
        ).collect()
    }
    assert (got["a"].n, got["a"].any, got["a"].any_nullable, got["a"].top) == (1, True, True, 10.0)
    assert (got["a"].mean, got["a"].pct, got["a"].pct_of, got["a"].d) == (15.0, 33.3, 100.0, 1)
    assert (got["b"].n, got["b"].any, got["b"].any_nullable, got["b"].top) == (0, False, None, 0.0)
    assert (got["b"].mean, got["b"].pct, got["b"].pct_of) == (None, 0.0, None)
