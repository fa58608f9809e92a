"""Every query with SQL gives the rows of DuckDB."""

import re

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract

SQL = contract.oracle_sql()
QUERIES = contract.queries()


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_only_model_queries_lack_sql():
    own = {q for q in QUERIES if not re.match(r"op\d+_|pipeline$", q)}
    assert own - set(SQL) == {
        "confusion_matrix", "feature_importance", "page_predictions", "page_risk_zones", "risk_zones",
        "run_summary", "score_all", "severity_accuracy", "severity_predictions",
    }


def test_entry_returns_states(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["state", "total_accidents", "avg_severity", "cities_count"]
    assert rows.count() == 7


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), connect(small), SQL[name]) == []
