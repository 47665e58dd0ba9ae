"""The registered queries of the text operators on the given tables."""

import __spark_entry__ as entry
import compare
import pytest

from plumbline.llm import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", catalog.oracle_sql())
def test_query_agrees_with_its_sql(spark, name):
    assert compare.difference(spark, compare.connect(SF), SF, name) is None


def test_queries_and_the_pipeline_are_registered():
    names = entry.queries()
    assert set(catalog.queries()) | {"pipeline"} <= set(names)
    assert "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", ["op3_secret_scan", "op6_license_scan", "op9_line_dedup"])
def test_one_row_per_document(spark, name):
    found = entry.queries()[name](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
