"""Data-quality operators over every ticket as landed."""

from pyspark.sql import functions as F

from .. import roles
from ..functions import count_where, n_rows
from ..operators import quality as dq
from ..plans import silver
from .registry import query

GOOD = "ticket_id IS NOT NULL AND customer_id IS NOT NULL AND game_id IS NOT NULL AND coalesce(ticket_price > 0, FALSE)"
RAW = ["ticket_id", "customer_id", "game_id", "ticket_price"]
RULES = {**silver.TICKET_DROP_RULES, **silver.ticket_warn_rules(tuple(roles.TIER_RANKS), roles.SALES_CHANNELS)}
SECTIONS = ", ".join(f"'{s}'" for s in roles.TIER_RANKS)
CHANNELS = ", ".join(f"'{s}'" for s in roles.SALES_CHANNELS)
RULE_SQL = {
    "ticket_id_not_null": "ticket_id IS NOT NULL",
    "customer_id_not_null": "customer_id IS NOT NULL",
    "game_id_not_null": "game_id IS NOT NULL",
    "price_positive": "ticket_price > 0",
    "valid_section_tier": f"section_tier IN ({SECTIONS})",
    "valid_purchase_channel": f"purchase_channel IN ({CHANNELS})",
}
REPORT = " UNION ALL ".join(
    f"SELECT '{n}' AS rule, count(*) AS total_rows, count(*) FILTER (({c}) IS NOT TRUE) AS violations FROM raw_tickets_all"
    for n, c in RULE_SQL.items()
)


@query("dq_expect_warn", REPORT)
def _(t):
    """Counts observed while every row is written through, read back as a table."""
    watched, observed = dq.expect(t("raw_tickets_all"), RULES)
    watched.write.format("noop").mode("overwrite").save()
    seen = observed.get
    rows = [(r, seen["rows_seen"], seen[r]) for r in RULES]
    return t.spark.createDataFrame(rows, "rule string, total_rows long, violations long")


@query(
    "dq_expect_drop",
    f"SELECT ticket_id, customer_id, game_id, CAST(ticket_price AS DOUBLE) AS ticket_price FROM raw_tickets_all WHERE {GOOD}",
)
def _(t):
    return dq.expect_or_drop(t("raw_tickets_all"), silver.TICKET_DROP_RULES).select(*RAW)


@query("dq_violation_report", REPORT)
def _(t):
    return dq.dq_report(t("raw_tickets_all"), RULES)


@query("dq_quarantine", "SELECT ticket_id, customer_id, game_id, ticket_price, quarantine_reason FROM quarantine_tickets")
def _(t):
    return dq.quarantine(t("raw_tickets_all"), silver.QUARANTINE_REASONS).select(*RAW, "quarantine_reason")


@query(
    "dq_split",
    f"""SELECT ticket_id, customer_id, game_id, CAST(ticket_price AS DOUBLE) AS ticket_price,
        CASE WHEN {GOOD} THEN 'good' WHEN ticket_id IS NULL THEN 'ticket_id_not_null' WHEN customer_id IS NULL THEN 'customer_id_not_null'
             WHEN game_id IS NULL THEN 'game_id_not_null' ELSE 'price_positive' END AS outcome FROM raw_tickets_all""",
)
def _(t):
    good, bad = dq.split(t("raw_tickets_all"), silver.TICKET_DROP_RULES)
    return good.select(*RAW, F.lit("good").alias("outcome")).unionByName(
        bad.select(*RAW, F.col("failed_rule").alias("outcome"))
    )


NULLABLE = ["ticket_id", "customer_id", "game_id", "ticket_price", "section_tier"]


@query(
    "dq_null_check",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM raw_tickets_all" for c in NULLABLE),
)
def _(t):
    return dq.null_counts(t("raw_tickets_all"), NULLABLE)


@query(
    "dq_assertions",
    """SELECT 1 AS sort_order, 'tickets loaded' AS check_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM raw_tickets_all
        UNION ALL SELECT 2, 'no ticket without price', CASE WHEN count(*) FILTER (ticket_price IS NULL) = 0 THEN 'PASS' ELSE 'WARN' END FROM raw_tickets_all
        UNION ALL SELECT 3, 'events numbered from 1', CASE WHEN min(game_number) = 1 THEN 'PASS' ELSE 'FAIL' END FROM dim_game""",
)
def _(t):
    tickets = dq.checks_from(
        t("raw_tickets_all"),
        [
            (1, "tickets loaded", n_rows() > 0, "PASS", "FAIL"),
            (2, "no ticket without price", count_where(F.col("ticket_price").isNull()) == 0, "PASS", "WARN"),
        ],
    )
    events = dq.check(t("dim_game"), "events numbered from 1", F.min("game_number") == 1, order=3)
    return dq.scorecard([events, tickets], keep_order=True)


# Accepted values of the mapped tables.
ACCEPTED = {"sections": tuple(roles.TIER_RANKS), "channels": roles.SALES_CHANNELS}
WARNED = {
    "dim_game": "dim_game", "dim_customer": "dim_customer", "fact_tickets": "fact_tickets",
    "bridge_promo": "bridge_promo", "raw_customers": "raw_customers_stream", "raw_tickets": "raw_tickets_stream",
}


def warn_sql(rules: str, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) AS total_rows, count(*) FILTER (({c}) IS NOT TRUE) AS violations FROM {table}"
        for n, c in silver.warn_rules(rules, **ACCEPTED).items()
    )


def _warned(rules: str, table: str):
    @query(f"dq_warn_{rules}", warn_sql(rules, table))
    def _(t):
        """Warn-only expectations of the table, counted while its rows are written through."""
        watched, observed = silver.with_expectations(t(table), rules, **ACCEPTED)
        watched.write.format("noop").mode("overwrite").save()
        seen = observed.get
        rows = [(r, seen["rows_seen"], seen[r]) for r in silver.warn_rules(rules, **ACCEPTED)]
        return t.spark.createDataFrame(rows, "rule string, total_rows long, violations long")


for _rules, _table in WARNED.items():
    _warned(_rules, _table)
