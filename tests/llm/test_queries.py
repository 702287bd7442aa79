import duckdb
import pytest

import __spark_entry__ as entry
from wordspace.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(ready, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](ready, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_registered_queries():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
