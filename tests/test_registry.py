"""The correctness gate at sf0.001: every registered query equals its DuckDB
oracle (column names, row count, value multiset); adapters agree too."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from daypulse import fixtures as fx
from daypulse.plans import queries as core
from tools.check_oracles import _kinds, _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in fx.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _compare(s_cols, s_rows, d_cols, d_rows):
    assert sorted(s_cols) == sorted(d_cols)
    assert _kinds(s_cols, s_rows) == _kinds(d_cols, d_rows) or not s_rows
    assert len(s_rows) == len(d_rows)
    assert Counter(_rows(s_cols, s_rows)[0]) == Counter(_rows(d_cols, d_rows)[0])


def test_every_query_has_an_oracle():
    """Those of the library; the optional llm queries have tests of their own."""
    assert set(core.queries()) <= set(entry.queries())
    assert set(core.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(core.queries()) >= 60


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    _compare(df.columns, s_rows, d_cols, cur.fetchall())


ADAPTERS = {
    "client_log": lambda s: fx.client_log(fx.table(s, SF, "events")),
    "user_day_sparse": lambda s: fx.user_day_sparse(fx.table(s, SF, "orders")),
    "page_view": lambda s: fx.page_view(fx.table(s, SF, "pages")),
    "event_json": lambda s: fx.event_json(fx.table(s, SF, "events")),
    "server_line": lambda s: fx.server_line(fx.table(s, SF, "events")),
    "payment": lambda s: fx.payment(fx.table(s, SF, "lineitem")),
    "refund": lambda s: fx.refund(fx.table(s, SF, "lineitem")),
    "signup": lambda s: fx.signup(fx.table(s, SF, "part")),
    "student": lambda s: fx.student(fx.table(s, SF, "events")),
    "geo_range": lambda s: fx.geo_range(fx.table(s, SF, "nation"), fx.table(s, SF, "region")),
}


@pytest.mark.parametrize("name", sorted(ADAPTERS))
def test_adapter_matches_sql(spark, con, name):
    df = ADAPTERS[name](spark)
    cur = con.execute(fx.ADAPTER_SQL[name])
    _compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cur.description],
             cur.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["date", "app_id"]
    assert df.count() > 0
