"""The driver contract: entry() runs, every oracle belongs to a query, and a
sample of queries agrees with DuckDB on sf0.001."""

import importlib.util
import os

import duckdb
import pytest

from contentlake.sources.tables import TABLE_NAMES

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert df.count() > 0
    assert "child_id" in df.columns


def test_oracles_belong_to_queries():
    m = _entry()
    assert set(m.oracle_sql()) <= set(m.queries())


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        if isinstance(v, float):
            return round(v, 6)
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["get_document", "get_children", "doc_to_columns_all",
                                  "query_all_pages", "create_document", "path_array_predicate",
                                  "get_acl", "op_result_kind", "upload_chunked", "attr_merge",
                                  "doc_to_columns_templated", "path_validate", "get_audit_json",
                                  "get_document_json"])
def test_matches_duckdb(spark, name):
    m = _entry()
    df = m.queries()[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(m.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, res.fetchall())
