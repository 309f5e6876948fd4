"""Marts and the silver tables they rest on."""

from .. import roles
from ..plans import gold, silver
from .registry import query

Q = "SELECT * FROM {}"


@query("mart_dim_game", Q.format("dim_game"))
def _(t):
    return silver.build_dim_game(t("raw_events"))


@query("mart_dim_customer", Q.format("dim_customer"))
def _(t):
    return silver.build_dim_customer(t("raw_customers"), t("raw_customers_stream"), roles.AS_OF)


@query("mart_fact_tickets", "SELECT * REPLACE (CAST(ticket_price AS DOUBLE) AS ticket_price) FROM fact_tickets")
def _(t):
    return silver.build_fact(t("raw_tickets"), t("raw_tickets_stream"), roles.TIER_RANKS)


@query("mart_bridge_promo", Q.format("bridge_promo"))
def _(t):
    return silver.build_bridge_promo(t("raw_promotions"), roles.DEEP, roles.MODERATE)


@query("mart_quarantine", Q.format("quarantine_tickets"))
def _(t):
    return silver.build_quarantine(t("raw_tickets_all"))


@query("mart_customer_360", Q.format("customer_360"))
def _(t):
    return gold.customer_360(t("dim_customer"), t("fact_tickets"), t("bridge_promo"), roles.AS_OF, events=t("dim_game"))


@query("mart_game_revenue", Q.format("game_revenue"))
def _(t):
    return gold.game_revenue(t("dim_game"), t("fact_tickets"), t("bridge_promo"))


@query("mart_retention_cohort", Q.format("retention_cohort"))
def _(t):
    return gold.retention_cohort(t("fact_tickets"), t("dim_customer"), t("dim_game"))


@query(
    "mart_retention_cohort_365",
    """SELECT * REPLACE (days_since_last > 365 AS churn_flag, total_spend >= 2000000 AS is_high_value)
       FROM retention_cohort""",
)
def _(t):
    return gold.retention_cohort(
        t("fact_tickets"), t("dim_customer"), t("dim_game"), churn_days=365, high_value=2000000
    )


@query("mart_fan_features", Q.format("fan_features"))
def _(t):
    return gold.fan_features(t("customer_360"), t("retention_cohort"))
