"""The driver's gate at sf 0.001: every key against its DuckDB statement."""
import os
import sys

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_every_key_matches_oracle(spark):
    from courtview.registry import oracle_statements as oracle_sql
    from courtview.registry import query_table as queries
    from tools.oracle_check import duck, out_of_order, rows_of, type_diff
    con = duck(SF_SMALL)
    sqls = oracle_sql()
    failures = []
    for key, fn in queries().items():
        df = fn(spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
        if key not in sqls:
            continue
        res = con.execute(sqls[key])
        cols = [d[0] for d in res.description]
        if type_diff(df, res):
            failures.append((key, "types"))
        if sorted(cols) != sorted(df.columns) or rows_of(df.columns, rows) != rows_of(cols, res.fetchall()):
            failures.append(key)
        if out_of_order(con, key, df.columns, rows):
            failures.append((key, "row order"))
    assert failures == []


def test_row_orders():
    """A swapped pair is seen, ties are not; only registered keys have an order, every ORDER BY key of the reports among them."""
    import duckdb
    from courtview.registry import query_table as queries
    from oracle.row_orders import ROW_ORDERS
    from tools.oracle_check import out_of_order
    con, cols = duckdb.connect(), ["team", "total_views"]
    assert out_of_order(con, "v_views_by_team", cols, [("b", 9), ("c", 5), ("a", 5), ("d", None)]) == 0
    assert out_of_order(con, "v_views_by_team", cols, [("c", 5), ("b", 9), ("d", None)]) == 2
    assert out_of_order(con, "v_views_by_team", cols, [("d", None), ("b", 9)]) == 2
    marks = [("t", "High Engagement", "x", m, v) for m, v in (("view_count", 3.0), ("engagement_rate", 9.0))]
    more = [("u", "High Engagement", "x", m, v) for m, v in (("view_count", 4.0), ("engagement_rate", 1.0))]
    names = ["video_title", "monitoring_priority", "team", "measure_name", "measure_value"]
    assert out_of_order(con, "v_priority_videos", names, more + marks) == 0 and out_of_order(con, "v_priority_videos", names, marks + more) == 4
    assert set(ROW_ORDERS) <= set(queries())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["team", "conference"]


def test_contract_keys():
    from courtview.registry import oracle_statements as oracle_sql
    from courtview.registry import query_table as queries
    q, o = set(queries()), set(oracle_sql())
    assert o <= q
    assert q == o
    assert all(isinstance(v, str) and v.strip() for v in oracle_sql().values())
