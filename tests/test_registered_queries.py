"""Every registered query against its SQL, and the figures two engines agreed on before."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import oracle_queries
from orderloom import catalogue
from tests.oracle_check import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert catalogue.queries().keys() == oracle_queries.oracle_sql().keys()
    assert catalogue.queries().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query_matches_its_sql(spark, duck, name):
    assert differences(spark, duck, name, SF_DIR) is None


def test_entry_gives_the_known_winner(spark):
    row = contract.entry(spark).first()
    assert (row.sku, row.units_sold, row.revenue) == ("SKU-00000163", 81, Decimal("106431.65"))


def test_known_totals(spark):
    mart = contract.queries()["mart_monthly"](spark, SF_DIR)
    totals = mart.agg(F.count("*"), F.sum("units_delivered"), F.sum("revenue_delivered"), F.sum("distinct_orders"))
    assert tuple(totals.first()) == (4950, 52460, Decimal("107153290.52"), 5942)
    latest = contract.queries()["latest_items_by_key"](spark, SF_DIR)
    delivered = F.when(F.col("line_status") == "DELIVERED", F.col("line_total"))
    found = latest.agg(F.count("*"), F.count_if(F.col("line_status") == "RETURNED"), F.sum(delivered))
    assert tuple(found.first()) == (6000, 1446, Decimal("96005557.23"))
    assert contract.queries()["collapse_exact_items"](spark, SF_DIR).count() == 6479
