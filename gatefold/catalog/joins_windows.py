"""Joins, windows, sorting, unions and subqueries."""

from pyspark.sql import functions as F

from .. import roles
from ..functions import count_where, flag_to_int, mean_of, n_rows, pct, round_to
from ..operators import grouping as g
from ..operators import joins as j
from ..operators import ordering as o
from ..operators import sets
from ..operators import windows as w
from ..oracle import rounded as R
from ..plans.gold import LABEL_DEFAULTS
from ..session import scratch_dir
from ..sources.files import stream_table
from ..sources.layers import append_delivery
from ..streaming.jobs import union_streams
from .registry import query


# ---------------------------------------------------------------- joins


@query(
    "join_left_agg",
    """SELECT customer_id, initial_segment, total_spend, games_attended, total_discount_received
        FROM dim_customer LEFT JOIN ticket_agg USING (customer_id) LEFT JOIN promo_agg USING (customer_id)""",
)
def _(t):
    sales = g.agg_customer(t("fact_tickets"), roles.AS_OF).select(
        "customer_id", "total_spend", "games_attended"
    )
    promos = g.agg_customer_promo(t("bridge_promo")).select("customer_id", "total_discount_received")
    people = t("dim_customer").select("customer_id", "initial_segment")
    return j.left_agg_join(people, [sales, promos], "customer_id")


@query(
    "join_left_enrich",
    """SELECT ticket_id, f.game_id, f.game_date, f.season_phase, g.game_date AS dim_game_date, g.season_phase AS dim_season_phase
        FROM fact_tickets f LEFT JOIN dim_game g ON f.game_id = g.game_id""",
)
def _(t):
    joined = j.enrich(t("fact_tickets"), t("dim_game"), "game_id", ["game_date", "season_phase"])
    return joined.select(
        "ticket_id", "game_id", "game_date", "season_phase", "dim_game_date", "dim_season_phase"
    )


@query(
    "join_left_cohort",
    """SELECT t.customer_id, first_purchase_date, total_games, second_purchase_date, acquisition_channel, tenure_days
        FROM customer_timeline t LEFT JOIN second_visit USING (customer_id) LEFT JOIN dim_customer USING (customer_id)""",
)
def _(t):
    fact = t("fact_tickets")
    line = g.timeline(fact).select("customer_id", "first_purchase_date", "total_games")
    people = t("dim_customer").select("customer_id", "acquisition_channel", "tenure_days")
    return j.cohort_join(line, g.nth_visit(fact, 2), people, "customer_id")


@query(
    "join_left_labels",
    """SELECT customer_id, frequency_games, churn_flag, returned_30d, is_one_and_done FROM fan_features""",
)
def _(t):
    features = t("customer_360").select(
        "customer_id", F.coalesce("games_attended", F.lit(0)).alias("frequency_games")
    )
    wanted = ["churn_flag", "returned_30d", "is_one_and_done"]
    labels = t("retention_cohort").select(
        "customer_id", *[flag_to_int(c).alias(c) for c in wanted]
    )
    return j.attach_labels(features, labels, "customer_id", {c: LABEL_DEFAULTS[c] for c in wanted})


@query(
    "join_inner_fact_dim",
    f"""SELECT g.season_phase, count(*) AS tickets, {R("sum(ticket_price)", 2)} AS revenue
        FROM fact_tickets f JOIN dim_game g ON f.game_id = g.game_id GROUP BY 1""",
)
def _(t):
    fact = t("fact_tickets").select("game_id", "ticket_price")
    return j.fact_by_event(
        fact, t("dim_game"), "game_id", "season_phase",
        [n_rows().alias("tickets"), F.sum("ticket_price").alias("revenue")],
        [F.sum("tickets").alias("tickets"), round_to(F.sum("revenue"), 2).alias("revenue")],
    )


@query(
    "join_inner_fact_customer",
    """SELECT ticket_id, customer_id, acquisition_channel, is_season_holder
        FROM fact_tickets JOIN dim_customer USING (customer_id) WHERE is_promo_ticket""",
)
def _(t):
    joined = j.fact_by_customer(
        t("fact_tickets"), t("dim_customer"), "customer_id",
        ["acquisition_channel", "is_season_holder"], F.col("is_promo_ticket"),
    )
    return joined.select("ticket_id", "customer_id", "acquisition_channel", "is_season_holder")


@query(
    "join_multiway_inner",
    """SELECT customer_id, risk_tier, segment_label, f.frequency_games, c.revenue_net, r.total_games
        FROM ml_churn_scores JOIN ml_fan_segments USING (customer_id) JOIN fan_features f USING (customer_id)
        JOIN customer_360 c USING (customer_id) JOIN retention_cohort r USING (customer_id)""",
)
def _(t):
    return j.star_join(
        t("ml_churn_scores").select("customer_id", "risk_tier"),
        [
            t("ml_fan_segments").select("customer_id", "segment_label"),
            t("fan_features").select("customer_id", "frequency_games"),
            t("customer_360").select("customer_id", "revenue_net"),
            t("retention_cohort").select("customer_id", "total_games"),
        ],
        "customer_id",
    )


@query(
    "join_two_way_inner",
    """SELECT customer_id, risk_tier, segment_label FROM ml_churn_scores JOIN ml_fan_segments USING (customer_id)""",
)
def _(t):
    return j.star_join(
        t("ml_churn_scores").select("customer_id", "risk_tier"),
        [t("ml_fan_segments").select("customer_id", "segment_label")], "customer_id",
    )


@query(
    "join_scores_segments_left",
    f"""SELECT s.segment_label, count(*) AS fans, {R("avg(c.churn_probability)", 3)} AS avg_churn_prob
        FROM ml_churn_scores c LEFT JOIN (SELECT * FROM ml_fan_segments WHERE segment_label <> 'Casual Fan') s USING (customer_id) GROUP BY 1""",
)
def _(t):
    named = t("ml_fan_segments").filter(F.col("segment_label") != "Casual Fan")
    return j.left_join_then_profile(
        t("ml_churn_scores"), named.select("customer_id", "segment_label"), "customer_id",
        "segment_label",
        [n_rows().alias("fans"), mean_of("churn_probability", 3).alias("avg_churn_prob")],
    )


@query(
    "join_ref_scalar",
    """SELECT customer_id, last_purchase_date, (SELECT max(game_date) FROM dim_game) AS last_event FROM customer_timeline""",
)
def _(t):
    line = g.timeline(t("fact_tickets")).select("customer_id", "last_purchase_date")
    return j.with_reference_value(line, t("dim_game"), F.max("game_date"), "last_event")


# ---------------------------------------------------------------- windows


@query("win_running_sum", "SELECT game_id, game_number, cumulative_revenue, wins_to_date FROM game_revenue")
def _(t):
    base = t("game_revenue").select("game_id", "game_number", "gross_revenue", "result_numeric")
    gross = F.coalesce("gross_revenue", F.lit(0.0)).cast("decimal(18,4)")
    summed = w.running_sum(base, gross, "game_number", "cumulative_revenue")
    both = w.running_sum(summed, "result_numeric", "game_number", "wins_to_date")
    return both.select(
        "game_id", "game_number", round_to("cumulative_revenue", 2).alias("cumulative_revenue"), "wins_to_date"
    )


@query(
    "win_running_sum_rows",
    """SELECT ticket_id, CAST(sum(ticket_price) OVER (ORDER BY game_date, ticket_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS revenue_to_date
        FROM fact_tickets""",
)
def _(t):
    rows = t("fact_tickets").select("ticket_id", "game_date", "ticket_price")
    total = w.running_sum_scalable(rows, "ticket_price", ["game_date", "ticket_id"], "revenue_to_date")
    return total.select("ticket_id", "revenue_to_date")


@query("win_moving_avg", "SELECT game_id, game_number, fill_rate_3game_avg FROM game_revenue")
def _(t):
    base = t("dim_game").select("game_id", "game_number", "arena_fill_pct")
    smooth = w.moving_avg(base, "arena_fill_pct", "game_number", "fill_rate_3game_avg", 3, digits=3, width=16)
    return smooth.select("game_id", "game_number", "fill_rate_3game_avg")


@query("win_index_vs_mean", "SELECT game_id, revenue_index FROM game_revenue")
def _(t):
    base = t("game_revenue").select("game_id", "gross_revenue")
    return j.index_against_mean(base, "gross_revenue", "revenue_index").select("game_id", "revenue_index")


@query(
    "win_rank",
    """SELECT ticket_id, customer_id, CAST(rank() OVER (PARTITION BY customer_id ORDER BY game_date) AS INTEGER) AS purchase_rank
        FROM fact_tickets""",
)
def _(t):
    rows = t("fact_tickets").select("ticket_id", "customer_id", "game_date")
    return w.rank_in(rows, ["customer_id"], "game_date", "purchase_rank").drop("game_date")


@query(
    "win_dense_rank",
    """SELECT ticket_id, customer_id, CAST(dense_rank() OVER (PARTITION BY customer_id ORDER BY game_date) AS INTEGER) AS visit_number
        FROM fact_tickets""",
)
def _(t):
    rows = t("fact_tickets").select("ticket_id", "customer_id", "game_date")
    return w.dense_rank_in(rows, ["customer_id"], "game_date", "visit_number").drop("game_date")


@query(
    "win_pct_of_total",
    f"""SELECT purchase_channel, {R("CAST(sum(ticket_price) AS DOUBLE) * 100 / CAST(sum(sum(ticket_price)) OVER () AS DOUBLE)", 1)} AS pct_of_revenue
        FROM fact_tickets GROUP BY 1""",
)
def _(t):
    return w.share_of_total(
        t("fact_tickets"), ["purchase_channel"], F.sum("ticket_price"), "pct_of_revenue", few_groups=True
    )


@query(
    "win_pct_within_group",
    f"""SELECT season_phase, section_tier, {R("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY season_phase)", 1)} AS pct_within_phase
        FROM fact_tickets GROUP BY 1, 2""",
)
def _(t):
    return w.share_within(
        t("fact_tickets"), ["section_tier"], ["season_phase"], n_rows(), "pct_within_phase"
    )


# ---------------------------------------------------------------- order, top-k, sets, subqueries


@query(
    "sort_by_agg",
    """SELECT season_phase, count(*) AS games FROM dim_game GROUP BY 1 ORDER BY min(game_number)""",
)
def _(t):
    return o.order_by_agg(
        t("dim_game"), ["season_phase"], [n_rows().alias("games")], F.min("game_number")
    )


@query(
    "sort_multi",
    """SELECT acquisition_channel, segment_label, count(*) AS fan_count
        FROM dim_customer JOIN ml_fan_segments USING (customer_id) GROUP BY 1, 2 ORDER BY 1, 3 DESC""",
)
def _(t):
    people = t("dim_customer").select("customer_id", "acquisition_channel")
    joined = people.join(t("ml_fan_segments").select("customer_id", "segment_label"), "customer_id")
    counts = joined.groupBy("acquisition_channel", "segment_label").agg(n_rows().alias("fan_count"))
    return o.order_by(counts, ["acquisition_channel", "-fan_count"])


@query(
    "topk_watchlist",
    """SELECT customer_id, churn_probability, risk_tier FROM ml_churn_scores
        WHERE risk_tier = 'High' ORDER BY churn_probability DESC, customer_id LIMIT 20""",
)
def _(t):
    scores = t("ml_churn_scores").select("customer_id", "churn_probability", "risk_tier")
    return o.top_k(
        scores, ["-churn_probability"], 20, cond=F.col("risk_tier") == "High", tie_break="customer_id"
    )


COUNTED = ["raw_events", "raw_customers", "raw_tickets", "raw_promotions", "fact_tickets"]


@query(
    "union_all_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED),
)
def _(t):
    return sets.table_counts({n: t(n) for n in COUNTED})


@query(
    "union_streams",
    """SELECT customer_id, full_name, 'seed' AS origin FROM raw_customers
        UNION ALL SELECT customer_id, full_name, 'new' FROM raw_customers_stream""",
)
def _(t):
    """Sign-ups stream from the first run on; past customers join as a second source later."""
    root = scratch_dir(t.spark, "union_streams")
    tables = {"new": "raw_customers_stream", "seed": "raw_customers"}
    half = F.xxhash64("customer_id", "full_name") >= 0
    deliveries = [("new", half), ("seed", half), ("new", ~half), ("seed", ~half)]
    known: list[str] = []
    for name, part in deliveries:
        rows = t(tables[name]).select("full_name", "customer_id").where(part)
        append_delivery(rows, root, "bronze", name)
        known += [name] if name not in known else []
        sources = {n: stream_table(t.spark, root, "bronze", n) for n in known}
        union_streams(sources, f"{root}/out", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/out").select("customer_id", "full_name", F.col("source").alias("origin"))


PROMO_RATE = "(SELECT count(*) FILTER (is_promo_ticket) * CAST(100 AS DOUBLE) / count(*) FROM fact_tickets WHERE season_phase = '{}')"


@query(
    "subq_scalar",
    f"""SELECT count(*) AS events, {PROMO_RATE.format("slump")} > {PROMO_RATE.format("hot_start")} AS slump_discounts_more FROM dim_game""",
)
def _(t):
    def share(phase):
        return t("fact_tickets").filter(F.col("season_phase") == phase), pct("is_promo_ticket", 8)

    higher = sets.compare_scalars(share("slump"), share("hot_start"), ">")
    events = t("dim_game").agg(n_rows().alias("events"))
    return events.withColumn("slump_discounts_more", higher)


@query(
    "subq_derived",
    """SELECT segment_label, high_risk FROM (
        SELECT segment_label, count(*) FILTER (risk_tier = 'High') AS high_risk, min(segment_id) AS pos
        FROM ml_fan_segments JOIN ml_churn_scores USING (customer_id) GROUP BY 1) ORDER BY pos""",
)
def _(t):
    joined = t("ml_fan_segments").select("customer_id", "segment_id", "segment_label").join(
        t("ml_churn_scores").select("customer_id", "risk_tier"), "customer_id"
    )
    counts = joined.groupBy("segment_label").agg(
        count_where(F.col("risk_tier") == "High").alias("high_risk"), F.min("segment_id").alias("pos")
    )
    return o.project_after(counts, "pos")
