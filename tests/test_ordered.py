"""Ordered and grouped operators against brute force, with a hot group holding most rows."""

import random
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatefold.operators import grouping as g
from gatefold.operators import joins as j
from gatefold.operators import ordering as o
from gatefold.operators import sets
from gatefold.operators import windows as w
from gatefold.operators.prefix import prefix_sums
from gatefold.operators.quantiles import exact_quantiles, percentiles, summary_stats

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def skewed(spark):
    """2000 rows, two thirds of them in group 'hot'."""
    rng = random.Random(7)
    rows = [
        (i, "hot" if rng.random() < 0.66 else f"k{rng.randrange(6)}", rng.randrange(40), rng.randrange(10_000) / 4)
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "id int, k string, d int, x double").repartition(4)
    return rows, df


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40), st.integers(1, 9))
def test_running_sum_and_moving_average(spark, values, width):
    rows = [(3 * i + 1, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n int, v int").repartition(3)
    sums = {r.n: r.s for r in w.running_sum(df, "v", "n", "s", slices=width).collect()}
    means = {r.n: r.m for r in w.moving_avg(df, "v", "n", "m", 3, width=width).collect()}
    assert len(sums) == len(means) == len(rows)
    for i, (n, _) in enumerate(rows):
        known = [v for _, v in rows[: i + 1] if v is not None]
        last = [v for _, v in rows[max(0, i - 2) : i + 1] if v is not None]
        assert sums[n] == (sum(known) if known else None)
        assert means[n] == (pytest.approx(sum(last) / len(last)) if last else None)


def test_moving_average_with_slices_shorter_than_the_frame(spark):
    df = spark.createDataFrame([(i, i * i) for i in range(7)], "n int, v int").repartition(3)
    got = {r.n: r.m for r in w.moving_avg(df, "v", "n", "m", 4, width=1).collect()}
    for i in range(7):
        frame = [x * x for x in range(max(0, i - 3), i + 1)]
        assert got[i] == pytest.approx(sum(frame) / len(frame))


def test_running_sum_within_groups_including_null_group(spark):
    rows = [("a", 1, 1), ("a", 5, 2), (None, 1, 10), (None, 9, 20), ("b", 3, 5)]
    df = spark.createDataFrame(rows, "k string, n int, v int")
    got = {(r.k, r.n): r.s for r in w.running_sum(df, "v", "n", "s", by=["k"], slices=4).collect()}
    assert got == {("a", 1): 1, ("a", 5): 3, (None, 1): 10, (None, 9): 30, ("b", 3): 5}


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_running_sum_over_any_order(spark, skewed, slices):
    rows, df = skewed
    total = w.running_sum_scalable(df, "x", ["d", "id"], "s", slices)
    got = {r.id: r.s for r in total.collect()}
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    for row, expected in zip(ordered, accumulate(r[3] for r in ordered)):
        assert got[row[0]] == pytest.approx(expected)


def test_prefix_sums_spread_a_hot_group_over_slices(spark, skewed):
    rows, df = skewed
    placed = df.repartitionByRange(8, "k", "id").withColumn("p", F.spark_partition_id())
    assert placed.filter("k = 'hot'").select("p").distinct().count() > 3
    got = {r.id: (r.x_before, r.x_total) for r in prefix_sums(df, ["k"], ["id"], ["x"], 8).collect()}
    run, total = defaultdict(float), defaultdict(float)
    for _, k, _, x in rows:
        total[k] += x
    for i, k, _, x in sorted(rows):
        assert got[i] == (pytest.approx(run[k]), pytest.approx(total[k]))
        run[k] += x


def test_ranks_match_definition(spark, skewed):
    rows, df = skewed
    rank = {r.id: r["rank"] for r in w.rank_in(df, ["k"], "d").collect()}
    dense = {r.id: r.dense_rank for r in w.dense_rank_in(df, ["k"], "d").collect()}
    groups = defaultdict(list)
    for _, k, d, _ in rows:
        groups[k].append(d)
    for i, k, d, _ in rows:
        assert rank[i] == 1 + sum(v < d for v in groups[k])
        assert dense[i] == 1 + len({v for v in groups[k] if v < d})


def test_exact_quantiles_match_numpy(spark, skewed):
    rows, df = skewed
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    groups = defaultdict(list)
    for _, k, _, x in rows:
        groups[k].append(x)
    got = exact_quantiles(df, ["k"], ["x"], ps).collect()
    assert len(got) == len(groups)
    for r in got:
        values = groups[r.k]
        assert [r[f"q{i}"] for i in range(len(ps))] == pytest.approx(list(np.quantile(values, ps)))
        assert (r.n_values, r.min, r.max) == (len(values), min(values), max(values))
        assert r["mean"] == pytest.approx(sum(values) / len(values))


@pytest.mark.parametrize("n", [1, 2, 7])
def test_percentiles_of_small_groups_ignore_nulls(spark, n):
    rows = [("a", float(i * i)) for i in range(n)] + [("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = percentiles(df, ["k"], "x", {"p25": 0.25, "p90": 0.9}).collect()
    assert [r.k for r in got] == ["a"]
    assert [got[0].p25, got[0].p90] == pytest.approx(list(np.quantile([i * i for i in range(n)], [0.25, 0.9])))


def test_summary_stats(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "a int, b double")
    got = {r.column_name: r for r in summary_stats(df, ["a", "b"]).collect()}
    assert tuple(got["a"])[1:] == (3, 2.0, 1.0, 1.5, 2.5, 3.0)
    assert tuple(got["b"])[1:] == (2, 3.0, 2.0, 2.5, 3.5, 4.0)


def test_mode_breaks_ties_to_the_smallest_and_skips_nulls(spark):
    rows = [("a", "y"), ("a", "x"), ("a", None), ("a", None), ("a", None), ("b", "z"), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    assert {r.k: r.m for r in g.mode_by(df, ["k"], "v", "m").collect()} == {"a": "x", "b": "z"}


def test_distinct_count_with_nulls(spark):
    rows = [("a", 1), ("a", 1), ("a", None), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    assert {r.k: r.n for r in g.distinct_count_by(df, "k", "v", "n").collect()} == {"a": 1, "b": 0}


def test_nth_visit_against_brute_force(spark, skewed):
    rows, df = skewed
    dated = df.select(F.col("k").alias("customer_id"), F.date_add(F.lit("2024-01-01").cast("date"), "d").alias("game_date"))
    for n in (1, 2, 3):
        got = {r.customer_id: r.visit for r in g.nth_visit(dated, n, name="visit").collect()}
        days = defaultdict(set)
        for _, k, d, _ in rows:
            days[k].add(d)
        expected = {k: sorted(v)[n - 1] for k, v in days.items() if len(v) >= n}
        assert {k: (v.toordinal() - 738886) for k, v in got.items()} == expected


@pytest.mark.parametrize("many", [False, True])
def test_shares(spark, skewed, many):
    rows, df = skewed
    share = w.share_of_total(df, ["k"], F.count(F.lit(1)), "pct", few_groups=not many)
    got = {r.k: r.pct for r in share.collect()}
    counts = Counter(k for _, k, _, _ in rows)
    for k, n in counts.items():
        assert got[k] == pytest.approx(100 * n / len(rows), abs=0.051)
    within = w.share_within(df, ["d"], ["k"], F.count(F.lit(1)), "pct").collect()
    sums = defaultdict(float)
    for r in within:
        sums[r.k] += r.pct
    assert all(abs(s - 100) < 2.1 for s in sums.values())


def test_top_k_with_ties_uses_the_tie_break(spark):
    df = spark.createDataFrame([(i, 1) for i in range(10)] + [(99, 0)], "id int, x int").repartition(3)
    got = [r.id for r in o.top_k(df, ["-x"], 3, tie_break="id").collect()]
    assert got == [0, 1, 2]
    assert [r.id for r in o.top_k(df, ["-x"], 3, cond=F.col("x") == 0).collect()] == [99]


def test_unions_counts_and_scalars(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert sorted(tuple(r) for r in sets.union_sources(a, b).collect()) == [(1, "x"), (2, "y")]
    assert [tuple(r) for r in sets.table_counts({"b": b, "a": a}).collect()] == [("a", 1), ("b", 1)]
    higher = sets.compare_scalars((b, F.max("n")), (a, F.max("n")), ">")
    assert a.select(higher.alias("h")).first().h is True


def test_joins_keep_and_default(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    got = {r.k: r.v for r in j.attach_labels(left, right, "k", {"v": 7}).collect()}
    assert got == {"a": 1, "b": 7}
    assert j.star_join(left, [right], "k").count() == 1
    valued = j.with_reference_value(left, right, F.max("v"), "top")
    assert {r.top for r in valued.collect()} == {1}
    index = j.index_against_mean(spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double"), "x", "i")
    assert sorted(r.i for r in index.collect()) == [0.0, 0.75, 2.25]


def test_sparse_keys_and_groups_need_no_single_task(spark):
    rng = random.Random(4)
    keys = sorted(rng.sample(range(10**9), 600))
    rows = [("hot" if i % 3 else "b", k, float(i % 11)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, n long, v double").repartition(3)
    out = w.moving_avg(w.running_sum(df, "v", "n", "s", by=["k"]), "v", "n", "m", 3, by=["k"])
    got = {(r.k, r.n): (r.s, r.m) for r in out.collect()}
    for name in ("hot", "b"):
        mine = [(n, v) for k, n, v in rows if k == name]
        for i, (n, _) in enumerate(mine):
            last = [v for _, v in mine[max(0, i - 2) : i + 1]]
            assert got[name, n] == (pytest.approx(sum(v for _, v in mine[: i + 1])), pytest.approx(sum(last) / len(last)))


@pytest.mark.parametrize("values,mean", [([1e-9, 3e-9], 2e-9), ([1e17, 2e17], 1.5e17), ([float("nan"), 1.0], None)])
def test_means_of_any_size(spark, values, mean):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = summary_stats(df, ["x"]).first().mean
    assert got != got if mean is None else got == pytest.approx(mean)


def test_slices_follow_the_number_of_rows(spark, monkeypatch):
    from gatefold.operators import prefix

    sizes, real = [], prefix._sliced

    def seen(df):
        made = real(df)
        sizes.append([r["count"] for r in made.groupBy("_slice").count().collect()])
        return made

    monkeypatch.setattr(prefix, "_sliced", seen)
    rows = spark.range(3000).select(F.col("id").alias("at"), F.lit("hot").alias("g"), F.lit(1).cast("long").alias("one"))
    made = prefix.prefix_sums(rows, ["g"], ["at"], ["one"], slice_rows=100)
    assert made.where("one_before <> at OR one_total <> 3000").count() == 0 and made.count() == 3000
    assert len(sizes) == 2 and max(sizes[0]) > 300 > max(sizes[1]) and len(sizes[1]) >= 25
    sizes.clear()
    assert prefix.prefix_sums(rows.limit(50), ["g"], ["at"], ["one"]).count() == 50 and len(sizes) == 1
    assert prefix.prefix_sums(rows.limit(0), [], ["at"], ["one"]).count() == 0
