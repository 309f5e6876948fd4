import pytest
from pyspark.sql import functions as F

from gatefold.operators import quality as dq
from gatefold.plans.silver import QUARANTINE_REASONS, TICKET_DROP_RULES

SCHEMA = "ticket_id string, customer_id string, game_id string, ticket_price double"
ROWS = [
    ("t1", "c1", "g1", 0.01),
    (None, "c2", "g1", 5.0),
    (None, None, "g1", 5.0),
    ("t4", None, "g1", 5.0),
    ("t5", "c5", None, 5.0),
    ("t6", "c6", "g1", 0.0),
    ("t7", "c7", "g1", -1.0),
    ("t8", "c8", "g1", None),
]


@pytest.fixture
def tickets(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_drop_keeps_only_fully_valid_rows(tickets, rows_of):
    assert rows_of(dq.expect_or_drop(tickets, TICKET_DROP_RULES), "ticket_id") == [("t1",)]


def test_warn_keeps_rows_and_counts_null_as_violation(spark, tickets):
    kept, seen = dq.expect(tickets, TICKET_DROP_RULES)
    assert kept.count() == len(ROWS)
    assert seen.get == {
        "rows_seen": 8, "ticket_id_not_null": 2, "customer_id_not_null": 2,
        "game_id_not_null": 1, "price_positive": 3,
    }


def test_report_has_one_row_per_rule(tickets, rows_of):
    assert rows_of(dq.dq_report(tickets, TICKET_DROP_RULES)) == [
        ("customer_id_not_null", 8, 2), ("game_id_not_null", 8, 1),
        ("price_positive", 8, 3), ("ticket_id_not_null", 8, 2),
    ]


def test_quarantine_takes_first_reason_and_skips_unknown_price(tickets, rows_of):
    got = rows_of(dq.quarantine(tickets, QUARANTINE_REASONS).groupBy("quarantine_reason").count())
    assert got == [("invalid_price", 2), ("null_customer_id", 1), ("null_game_id", 1), ("null_ticket_id", 2)]


def test_split_loses_no_row(tickets):
    good, bad = dq.split(tickets, TICKET_DROP_RULES)
    assert good.count() == 1 and bad.count() == 7
    reasons = {r.ticket_id: r.failed_rule for r in bad.collect()}
    assert reasons["t8"] == "price_positive"
    assert good.unionByName(bad.drop("failed_rule")).exceptAll(tickets).count() == 0


def test_null_counts(tickets, rows_of):
    assert rows_of(dq.null_counts(tickets, ["ticket_id", "ticket_price"])) == [
        ("ticket_id", 2), ("ticket_price", 1),
    ]


def test_scorecard_orders_and_hides_the_key(tickets):
    parts = [
        dq.check(tickets, "second", F.count(F.lit(1)) == 0, order=2, failed="WARN"),
        dq.checks_from(tickets, [(1, "first", F.count(F.lit(1)) == 8, "PASS", "FAIL")]),
    ]
    got = [tuple(r) for r in dq.scorecard(parts).collect()]
    assert got == [("first", "PASS"), ("second", "WARN")]
