"""The corpus queries against their SQL, and the rows they owe."""

import pytest

import __spark_entry__ as driver
from compare import connect, difference
from kerbside.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert difference(queries.queries()[name](spark, SF_DIR), con, queries.oracle_sql()[name]) is None
    con.close()


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in driver.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in driver.queries()
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", ["op4_token_counts", "op6_secret_scan", "op7_quality_rules", "op8_packing", "op10_source_mix",
    "op11_merkle_manifest", "op12_fill_middle", "op13_license_scan"])
def test_every_document_is_in_the_result(spark, name):
    ids = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id")
    got = queries.queries()[name](spark, SF_DIR).select("doc_id").distinct()
    assert got.count() == ids.count() == got.join(ids, "doc_id").count()
