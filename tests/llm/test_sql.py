"""The queries that SQL can express, beside their SQL on the smallest tables."""

import pytest

from quarryline.llm.queries import QUERIES, SQL
from tools.check import connect, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_and_sql_agree(spark, name):
    got = QUERIES[name](spark, FOLDER)
    result = connect(FOLDER).execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, result.fetchall())


def test_mix_shares_in_sql_with_null_sources_and_ids(spark, tmp_path):
    """Sources that stop at their limit, a null source, empty texts."""
    from quarryline.llm import mixing

    rows = [(k, "w " * (k % 7), s) for k, s in enumerate(["a"] * 60 + ["b"] * 3 + ["c"] * 40 + [None] * 25)]
    rows += [(500, None, "a"), (501, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    theirs = {r[0]: (r[1], r[2], r[3], r[5]) for r in db.execute(SQL["op5_pareto_mix"]).fetchall()}
    mixed = mixing.mix_copies(mixing.sizes_of(docs)).collect()
    assert {r["id"]: (r["size"], r["source_size"], round(r["target"], 3), r["copies"]) for r in mixed} == theirs
