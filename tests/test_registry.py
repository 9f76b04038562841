import pytest
from compare import duckdb_over, spark_rows, sql_rows

import __spark_entry__ as driver
from shelfline.oracles import ORACLES
from shelfline.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"

# These write 1,300 to 2,500 day folders each; the driver compares them as well, and
# test_storage covers whole runs on small feeds.
SLOW = {"layer_run_counts", "layer_run_lineage", "catalog_summary", "silver_versions", "incremental_rebuild"}


@pytest.fixture(scope="module")
def con():
    return duckdb_over(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_its_twin(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    columns, expected = sql_rows(con, ORACLES[name])
    assert sorted(df.columns) == columns
    assert spark_rows(df) == expected
