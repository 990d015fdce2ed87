"""Every registered query against its SQL twin, over the whole tables."""

import compare
import pytest

import __spark_entry__ as contract
from claimloom.plans.catalog import QUERIES
from claimloom.plans.oracle import ORACLE


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def tables(request):
    sf_dir = f"/root/testdata/{request.param}"
    con = compare.connect(sf_dir)
    yield sf_dir, con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_its_twin(spark, tables, key):
    sf_dir, con = tables
    assert compare.differences(QUERIES[key](spark, sf_dir), con, ORACLE[key]) == []


def test_entry_is_the_lazy_monthly_summary(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["year", "month", "claim_amount_category", "num_claims"]
    rows = df.collect()
    assert len(rows) == 202
    assert [(r.year, r.month) for r in rows] == sorted((r.year, r.month) for r in rows)
