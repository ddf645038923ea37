"""The registered queries on the smallest tables, next to DuckDB."""

import os
import re

import pytest

from checks.compare import compare, connect
from checks.oracles import oracle_sql
from patronage.plans.registry import queries

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = oracle_sql()

# Values of these depend on starts and splits, or on a fit; rows beside them hold what is true of any.
WITHOUT_STATEMENT = {
    "c3_buying_model", "c4_spend_model", "c5_predicted_purchases", "c6_predicted_clv", "c12_boosted_predictions",
    "c13_holdout_errors", "c14_cross_validation", "c15_feature_importance", "d7_fitted_histogram", "d9_fitted_describe", "g5_inertia_sweep",
    "g6_silhouette_sweep", "g7_optimal_k", "g8_fit_clusters", "g9_cluster_profiles", "g10_pca_projection",
}

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_query_has_a_statement_or_a_reason():
    assert set(queries()) == set(STATEMENTS) | WITHOUT_STATEMENT
    assert not set(STATEMENTS) & WITHOUT_STATEMENT
    assert all(re.fullmatch(r"[sqergchd]\d+_[a-z0-9_]+", name) for name in queries())


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_duckdb(spark, db, name):
    equal, text = compare(spark, db, FOLDER, name, STATEMENTS[name])
    assert equal, text


@needs_data
def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows and abs(sum(r.pct_customers for r in rows) - 100) < 1
