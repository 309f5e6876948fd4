"""Role mapping: the driver's star schema in the roles events, customers, tickets, promotions.

Whole tables are mapped. Past sales come from lineitem with orders and part, new drops from
the purchase rows of ``events``; customers are ``customer`` and ``supplier`` accounts (which
never buy) and, as new sign-ups, the users of ``events``. An event is a calendar month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.expressions import assign_phase, map_values
from .plans.silver import MONEY, SEASON_PHASES

# The user log starts in 2024; it is moved back so that it falls into the sales period.
LOG_SHIFT_DAYS = 9000
AS_OF = "2001-11-30"

# Section ranks of this star schema; ECONOMY stays unmapped on purpose.
TIER_RANKS = {"PROMO": 5, "LARGE": 4, "MEDIUM": 3, "STANDARD": 2, "SMALL": 1}
CHANNELS = ("automobile", "building", "furniture", "household", "corporate")
SALES_CHANNELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "mobile_app")
DEEP, MODERATE = 0.09, 0.07


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _number(date: Column) -> Column:
    return ((F.year(date) - 1995) * 12 + F.month(date)).cast("bigint")


def _game_id(number: Column) -> Column:
    return F.concat(F.lit("EV-"), F.lpad(number.cast("string"), 3, "0"))


def _phase(number: Column) -> Column:
    return assign_phase(number, SEASON_PHASES)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ship month; the house is as full as the month is busy."""
    lines = table(spark, sf_dir, "lineitem")
    number = _number(F.col("l_shipdate"))
    months = (
        lines.groupBy(number.alias("game_number"))
        .agg(
            F.max(F.last_day(F.col("l_shipdate").cast("date"))).alias("game_date"),
            F.count(F.lit(1)).alias("attendance"),
            F.count_if(F.col("l_linestatus") == "F").alias("home_score"),
        )
        .withColumn("away_score", F.col("attendance") - F.col("home_score"))
    )
    # A window over one row per calendar month: the lines are scanned once.
    busiest = F.max("attendance").over(Window.partitionBy()).cast("double")
    n = F.col("game_number")
    return months.select(
        _game_id(n).alias("game_id"),
        "game_number",
        "game_date",
        F.concat(F.lit("Guest "), F.month("game_date").cast("string")).alias("opponent"),
        (~F.month("game_date").isin(6, 12)).alias("is_home_game"),
        F.lit("Main Hall").alias("arena"),
        "home_score",
        "away_score",
        F.when(F.col("home_score") >= F.col("away_score"), F.lit("W")).otherwise(F.lit("L")).alias("result"),
        "attendance",
        (F.col("attendance").cast("double") / busiest).alias("arena_fill_pct"),
        F.lit("regular").alias("season_type"),
        _phase(n).alias("season_phase"),
        (n == 77).alias("is_jersey_night"),
        (n == 23).alias("is_star_injury_game"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed customers: retail customers and corporate accounts, with untidy names."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.lower("c_mktsegment").alias("acquisition_channel"),
    )
    accounts = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("customer_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
        F.lit("corporate").alias("acquisition_channel"),
    )
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("nation"),
            F.lower("r_name").alias("initial_segment"),
            F.when(F.col("r_name") == "EUROPE", F.lit("MT")).otherwise(F.lit("ID")).alias("state"),
        )
    )
    channel = F.col("acquisition_channel")
    name = (
        F.when(channel == "machinery", F.upper("name"))
        .when(channel == "building", F.concat(F.lit("  "), F.col("name"), F.lit("  ")))
        .otherwise(F.col("name"))
    )
    email = F.concat(F.translate("name", "#", "."), F.lit("@Example.COM"))
    balance = F.col("balance")
    return customers.unionByName(accounts).join(places, "nation", "left").select(
        "customer_id",
        name.alias("full_name"),
        F.when(balance >= -900, email).alias("email"),
        F.concat(F.lit("555-"), F.col("customer_id")).alias("phone"),
        F.lpad(F.col("nation").cast("string"), 5, "0").alias("zip_code"),
        "state",
        "acquisition_channel",
        "initial_segment",
        (balance >= 8000).alias("is_season_holder"),
        F.date_add(F.lit("1994-06-01").cast("date"), F.floor((balance + 1000) / 20).cast("int")).alias("signup_date"),
        balance.between(5000, 5500).alias("is_jersey_night_acq"),
        (balance < -500).alias("is_deeply_lapsed"),
    )


def raw_customers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New sign-ups: one row per user of the event log."""
    first_seen = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.min(F.col("ts").cast("date")).alias("seen"),
            F.min("event_type").alias("kind"),
            F.max("value").alias("top"),
        )
    )
    user = F.col("user_id").cast("string")
    return first_seen.select(
        F.concat(F.lit("U-"), user).alias("customer_id"),
        F.concat(F.lit("new user "), user).alias("full_name"),
        F.concat(F.lit("U"), user, F.lit("@Example.COM")).alias("email"),
        F.concat(F.lit("556-"), user).alias("phone"),
        F.lit("00099").alias("zip_code"),
        F.lit("ID").alias("state"),
        F.col("kind").alias("acquisition_channel"),
        F.lit("digital").alias("initial_segment"),
        (F.col("top") >= 200).alias("is_season_holder"),
        F.date_sub("seen", LOG_SHIFT_DAYS).alias("signup_date"),
        F.lit(False).alias("is_jersey_night_acq"),
        F.lit(False).alias("is_deeply_lapsed"),
    )


def _sold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    number = _number(F.col("l_shipdate"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "*",
        number.alias("game_number"),
        F.concat_ws(
            "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        ).alias("ticket_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
    )


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed tickets: every order line, for the event of its ship month."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    n = F.col("game_number")
    price = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return _sold_lines(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "ticket_id",
        "customer_id",
        _game_id(n).alias("game_id"),
        F.last_day(F.col("l_shipdate").cast("date")).alias("game_date"),
        F.col("p_type").alias("section_tier"),
        F.col("l_linenumber").cast("int").alias("seat_row"),
        F.col("l_quantity").cast("int").alias("seat_number"),
        price.cast(MONEY).alias("ticket_price"),
        F.col("o_orderpriority").alias("purchase_channel"),
        F.col("o_orderdate").cast("date").alias("purchase_ts"),
        (F.col("l_discount") > 0.05).alias("is_promo_ticket"),
        (n == 77).alias("is_jersey_night_game"),
        ((n == 77) & (F.col("o_orderpriority") == "1-URGENT")).alias("is_lapsed_reactivation"),
        _phase(n).alias("season_phase"),
    )


def raw_tickets_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New ticket drops: purchases of the event log, some of them broken."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    day = F.date_sub(F.col("ts").cast("date"), LOG_SHIFT_DAYS)
    bought = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    rows = bought.select("event_id", "user_id", "value", k.alias("k"), day.alias("day"))
    n = _number(F.col("day"))
    k = F.col("k")
    tier = (
        F.when(k < 20, "SMALL").when(k < 40, "STANDARD").when(k < 60, "MEDIUM")
        .when(k < 80, "LARGE").otherwise("ECONOMY")
    )
    return rows.select(
        F.when(k != 11, F.concat(F.lit("E-"), F.col("event_id").cast("string"))).alias("ticket_id"),
        F.when(k != 22, F.concat(F.lit("U-"), F.col("user_id").cast("string"))).alias("customer_id"),
        F.when(k != 33, _game_id(n)).alias("game_id"),
        F.last_day("day").alias("game_date"),
        tier.alias("section_tier"),
        F.lit("GA").alias("seat_row"),
        k.cast("string").alias("seat_number"),
        F.when(k != 44, (F.col("value") - 5).cast(MONEY)).alias("ticket_price"),
        F.lit("mobile_app").alias("purchase_channel"),
        F.col("day").alias("purchase_ts"),
        (k >= 70).alias("is_promo_ticket"),
        F.lit(False).alias("is_jersey_night_game"),
        F.lit(False).alias("is_lapsed_reactivation"),
        _phase(n).alias("season_phase"),
    )


def raw_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every discounted line above five percent; returned lines were not redeemed."""
    n = F.col("game_number")
    amount = F.col("l_extendedprice") * F.col("l_discount")
    return _sold_lines(spark, sf_dir).filter(F.col("l_discount") > 0.05).select(
        F.concat(F.lit("P-"), F.col("ticket_id")).alias("promo_id"),
        "ticket_id",
        "customer_id",
        _game_id(n).alias("game_id"),
        F.col("l_returnflag").alias("promo_type"),
        F.col("l_discount").alias("discount_pct"),
        F.col("l_extendedprice").alias("face_value"),
        amount.cast(MONEY).alias("discount_amount"),
        (F.col("l_returnflag") != "R").alias("redeemed"),
        _phase(n).alias("season_phase"),
    )


# ---------------------------------------------------------------- closed-form scores


def rule_scores(features: DataFrame) -> DataFrame:
    """Churn scores from a closed formula, so that a SQL engine can reproduce them."""
    from .functions import risk_tier, round_to

    raw = F.lit(0.95) - F.lit(0.012) * F.col("frequency_games") + F.lit(0.2) * F.col("promo_rate")
    p = round_to(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)), 4)
    return features.select("customer_id", p.alias("churn_probability")).select(
        "customer_id",
        "churn_probability",
        risk_tier("churn_probability").alias("risk_tier"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("scored_at"),
        F.lit("rule_v1").alias("model_version"),
        F.lit("rule_churn").alias("model_name"),
    )


# Fixed order of the five segment names.
SEGMENT_IDS = {
    "Season Core": 0, "High Value New": 1, "Casual Fan": 2, "Promo Hunter": 3, "Lapsed": 4,
}


def rule_segments(features: DataFrame) -> DataFrame:
    """Segments from an ordered rule list over the features."""
    label = (
        F.when(F.col("recency_days") > 240, F.lit("Lapsed"))
        .when(F.col("promo_sensitivity") >= 0.45, F.lit("Promo Hunter"))
        .when(F.col("frequency_games") >= 33, F.lit("Season Core"))
        .when(F.col("tenure_days") < 2500, F.lit("High Value New"))
        .otherwise(F.lit("Casual Fan"))
    )
    return features.select("customer_id", label.alias("segment_label")).select(
        "customer_id",
        map_values("segment_label", SEGMENT_IDS).alias("segment_id"),
        "segment_label",
        F.lit(0.0).alias("distance_to_centroid"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("scored_at"),
        F.lit("rule_v1").alias("model_version"),
        F.lit("rule_segments").alias("model_name"),
    )
