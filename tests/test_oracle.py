"""Every catalogue query against its DuckDB oracle on the smallest fixture."""

import pytest

from fixture_paths import SF_SMALL
from ehrspark.plans.catalog import QUERIES
from ehrspark.plans.oracle import ORACLES
from ehrspark.plans.verify import compare, duck_connection

ORACLE_NAMES = [n for n in QUERIES if n in ORACLES]


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, con)
    assert res["status"] == "match", res


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and df.columns == ["condition_source_concept_id", "condition_source_value", "icd10"]
    assert set(e.oracle_sql()) <= set(e.queries())
