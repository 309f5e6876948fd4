"""Every registered query with check SQL, compared with DuckDB on the smallest data set."""

import math
import os
import re

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402

SF = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in SOURCES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def shown(row):
    return tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)


# Rows of fitted models, which SQL cannot restate.
FITTED = {"ml_churn_table", "ml_importances_fitted", "ml_segments_fitted"}


def test_every_key_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    # the optional training-data operators have tests of their own where SQL cannot restate them
    optional = [n for n in QUERIES if n == "pipeline" or re.match(r"op\d+_", n)]
    assert set(QUERIES) - set(optional) - FITTED <= set(ORACLE)


def test_tables_of_fitted_models(spark):
    """One row per customer or input: probabilities with fitting tiers, named clusters, shares."""
    customers = QUERIES["mart_fan_features"](spark, SF).select("customer_id").toPandas().customer_id
    scores = QUERIES["ml_churn_table"](spark, SF).toPandas()
    assert sorted(scores.customer_id) == sorted(customers) and scores.churn_probability.between(0, 1).all()
    assert set(scores[scores.churn_probability < 0.4].risk_tier) <= {"Low"}
    assert set(scores[scores.churn_probability > 0.7].risk_tier) <= {"High"}
    segments = QUERIES["ml_segments_fitted"](spark, SF).toPandas()
    assert sorted(segments.customer_id) == sorted(customers) and (segments.distance_to_centroid >= 0).all()
    assert segments.groupby("segment_id").segment_label.nunique().eq(1).all() and segments.segment_label.notna().all()
    shares = QUERIES["ml_importances_fitted"](spark, SF).toPandas()
    assert len(shares) == 17 and shares.importance.sum() == pytest.approx(1) and shares.importance.is_monotonic_decreasing


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((shown(r[c] for c in cols) for r in df.collect()), key=repr)
    cursor = con.execute(ORACLE[name])
    header = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    at = [header.index(c) for c in cols]
    assert sorted(header) == cols
    assert got == sorted((shown(r[i] for i in at) for r in cursor.fetchall()), key=repr)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types


def test_entry_gives_phases(spark):
    rows = contract.entry(spark).collect()
    assert [r.phase_order for r in rows] == sorted(r.phase_order for r in rows) and len(rows) >= 4
