import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare

BODY = "<html><body><article><h1>{}</h1><p>{}</p></article><footer>&copy; x &middot; y</footer></body></html>"


@pytest.mark.parametrize("name", ["html_extract", "html_extract_full"])
def test_titles_cut_inside_a_reference(spark, tmp_path, name):
    """The text after the title goes on where the cut was: "&" and "And" are no reference."""
    pairs = [(f"Title {cut}", word) for cut in ("&", "&a", "&amp", "&quot") for word in ("And the", "Re", "le", "_x", "Été")]
    rows = [(i, "u", BODY.format(*pair)) for i, pair in enumerate(pairs)] + [(99, "u", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    found = entry_points.queries()[name](spark, str(tmp_path))
    assert compare(found, con, entry_points.oracle_sql()[name]) is None
