"""Every operator's query on a sample table, against its SQL where there is some."""

import duckdb
import pytest

from brandtrack.llm import queries as q
from star_data import sorted_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_check_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = q.queries()[name](spark, SF)
    expected = con.sql(q.oracle_sql()[name])
    assert spark_rows(df) == sorted_rows(expected.fetchall(), expected.columns)


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_other_queries_have_a_row_for_every_document_or_page(spark, name):
    rows = q.queries()[name](spark, SF).count()
    table = {"op5_extract_html": "pages"}.get(name, "documents")
    whole = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert rows == whole if name != "op6_decontaminate" else 0 < rows < whole


def test_native_operators_run_no_python(spark):
    from star_data import plan_of

    for name in ("op3_quality_rules", "quality_ablations", "op4_mix_sources", "op8_chat_format", "op9_shards"):
        plan = plan_of(q.queries()[name](spark, SF))
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
