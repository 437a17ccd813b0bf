import __spark_entry__ as contract
import pytest

from energy_mart.checks import catalogue
from energy_mart.checks.compare import compare

SMALL = "/root/testdata/sf0.001"


def test_entry_is_a_company_by_month_matrix(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 13 and df.count() > 0


def test_every_query_has_sql():
    assert set(catalogue.oracle_sql()) == set(catalogue.queries())
    assert set(catalogue.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, SMALL, name)["problems"] == []
