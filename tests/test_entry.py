import duckdb
import pytest

import __spark_entry__ as entry_points
from catalog.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
FAST = ["indicators", "latest_n", "seed_prices", "counter_rate", "chunk_corpus", "nearest", "stream_summary", "flatten_news"]


def test_entry_has_a_stable_schema(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["Date", "Ticker"] and df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_its_sql(spark, name):
    import tools_compare as compare

    db = duckdb.connect()
    for table in "supplier nation lineitem events documents embeddings benchmark labels pages conversations".split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = entry_points.queries()[name](spark, SF)
    got = compare.rows_of(df.columns, df.collect())
    result = db.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == compare.rows_of(names, result.fetchall())
