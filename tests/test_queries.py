"""Every driver query against its DuckDB oracle on the smallest tables; the flagship entry runs."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemart import plans
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

ORACLE, QUERIES = plans.ORACLE, plans.QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["stt", "edt", "cur_date", "province_id", "province_name", "order_amount", "order_count"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.sql(ORACLE[name]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_to_json_rows(spark):
    out = QUERIES["to_json_rows"](spark, SF_SMALL)
    rows = out.collect()
    n = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert len(rows) == 2 * n
    assert all(r.value.startswith('{"c_custkey":') for r in rows)
    assert any('"segment":null' in r.value for r in rows if r.keeps_nulls) or \
        all('"segment":null' not in r.value for r in rows if not r.keeps_nulls)


def test_search_keyword_window(spark):
    """Brute force on the small tables: every search row's words, counted per window."""
    from tidemart.functions.tokenize import _segment
    from tidemart.plans.windows import SEARCH_DICTIONARY
    got = {(r.stt, r.keyword): r.keyword_count for r in QUERIES["search_keyword_window"](spark, SF_SMALL).collect()}
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_type = 'click'").collect()
    from tidemart.plans.tables import SEARCH_WORDS
    import json as _json
    want = {}
    words = frozenset(SEARCH_DICTIONARY)
    for r in ev:
        item = SEARCH_WORDS[_json.loads(r.props)["k"] % len(SEARCH_WORDS)]
        start = r.ts.replace(second=r.ts.second - r.ts.second % 10, microsecond=0).strftime("%Y-%m-%d %H:%M:%S")
        for w in _segment(item, words, 5):
            want[(start, w)] = want.get((start, w), 0) + 1
    assert got == want
