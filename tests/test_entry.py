"""Driver contract: entry() smoke run, query / oracle key agreement, one oracle check at sf0.001."""

import duckdb

import __spark_entry__ as entry
from vocalstat.plans import driver


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"lang", "source", "s_cnt", "c_freq", "g_items", "dom_cnt"} <= set(df.columns)


def test_oracle_keys_are_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert all(name in o for name in driver.QUERIES)


def test_some_queries_match_duckdb(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels", "events", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("char_stats_by_lang", "demographics_matrix", "vote_stats"):
        s = entry.queries()[name](spark, sf)
        cols = sorted(s.columns)
        got = sorted(tuple(r[c] for c in cols) for r in s.collect())
        cur = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in cur.description]
        idx = [names.index(c) for c in cols]
        exp = sorted(tuple(r[i] for i in idx) for r in cur.fetchall())
        assert got == exp, name
