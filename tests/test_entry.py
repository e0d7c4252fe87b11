"""The registered queries against their SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def shown(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return f"{float(v) + 0.0:.5f}" if not isinstance(v, (bool, str)) else str(v)

    return sorted(tuple(shown(r[i]) for i in order) for r in values)


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_is_its_sql(spark, small, sql, name):
    got = entry.queries()[name](spark, small)
    want = sql.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "row_id", "col_id", "text"] and df.count() > 0


def test_rows_only_queries(spark, small):
    for name in ("tabular_lines", "invoice_tables", "correction_candidates"):
        assert entry.queries()[name](spark, small).count() > 0
