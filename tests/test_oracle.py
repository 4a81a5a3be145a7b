import pytest

import __spark_entry__ as entry_points
from presswork.plans import catalog
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(entry_points.queries()[name](spark, SF_DIR), con, entry_points.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["article_page_extract_all", "reporter_cards_all"])
def test_page_queries_read_every_document(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert entry_points.queries()[name](spark, SF_DIR).count() == documents


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
