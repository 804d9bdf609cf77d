"""The pipeline's stages against plain versions, and its registration."""

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


def test_stages(spark):
    import corpus_pipeline as P
    from courtview.llm.common import read_table, write_scratch
    docs = read_table(spark, SF_SMALL, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    bench = [r.text for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    for name, stage in P.STAGES:
        docs, _ = write_scratch(stage(spark, docs, SF_SMALL), f"test-{name}")
        rows = docs.collect()
        after = {r.doc_id: r.text for r in rows}
        if name != "shard":
            assert docs.columns == columns
        if name == "near_duplicates":
            ids = sorted(before)
            prints = [brute.fingerprint(before[i]) for i in ids]
            roots = brute.components(len(ids), lambda i, j, p=prints: (p[i] ^ p[j]).bit_count() <= 2)
            assert sorted(after) == sorted({ids[r] for r in roots})
        if name == "decontaminate":
            assert sorted(after) == sorted(i for i, t in before.items() if not any(b in t for b in bench))
        if name == "mix":
            assert set(Counter(r.doc_id for r in rows).values()) <= {1, 2, 3}
        if name == "shard":
            counts = Counter(r.shard for r in rows)
            assert max(counts.values()) - min(counts.values()) <= 1
        before = after if name != "mix" else before


def test_run_leaves_only_its_result(spark):
    import corpus_pipeline as P
    from courtview.llm.common import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    had = set(os.listdir(folder))
    rows = P.run(spark, SF_SMALL).collect()
    left = set(os.listdir(folder)) - had
    assert rows and len(left) == 1 and left.pop().startswith("pipeline-shard-")


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{i}_" for i in range(1, 11)} <= {n[:n.index("_") + 1] for n in names if n.startswith("op")} and "pipeline" in names


def test_topk_matches_sql(spark):
    import duckdb

    import __spark_entry__ as entry
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = sorted(con.execute(entry.oracle_sql()["op4_topk_search"]).fetchall())
    assert sorted(tuple(r) for r in entry.queries()["op4_topk_search"](spark, SF_SMALL).collect()) == want
