"""One query of each part of the document model against DuckDB."""

import duckdb
import pytest
from leafgraph.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: One query of each part; the others are held against DuckDB by the same comparison outside the tests.
CHOSEN = "components coverage_stats validation_report heading_report conflict_resolution conversation_coverage page_html_attributes".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def canonical(rows):
    return sorted([tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in row) for row in rows])


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(f"select {', '.join(columns)} from ({ORACLE_SQL[name]}) q").fetchall()
    assert canonical(got.select(*columns).collect()) == canonical(want)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys() and len(QUERIES) > 70
