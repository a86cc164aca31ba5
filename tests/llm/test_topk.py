"""Top-k search against brute force: ties, repeated ids, empty, short, null and non-finite vectors."""

import math
import random
from collections import defaultdict

import duckdb
import pytest
from blotter.llm.queries import op10_topk_search
from blotter.llm.topk_search import top_k
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<double>, bundle string, score string, batch string, rank string"


def brute(rows, queries, k):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = defaultdict(list)
    for q, v in fine:
        if queries(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q)[:k]
            out[q].append([(i, -s) for s, i in scored])
    return {q: sorted(lists) for q, lists in out.items()}


def found(df, name="vec_id"):
    """Per query its lists; rows that repeat an id are answered once each."""
    rows = defaultdict(list)
    for r in df.collect():
        rows[r["query_id"]].append((r["rank"], r[name], r["score"]))
    out = {}
    for q, some in rows.items():
        n = max(sum(1 for s in some if s[0] == k) for k in {s[0] for s in some})
        some = sorted(some)
        out[q] = [[(i, s) for _, i, s in some[j::n]] for j in range(n)]
    return out


def check(spark, rows, every=3, k=5, **kw):
    df = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], SCHEMA)
    got = found(top_k(df, df.filter(F.col("vec_id") % every == 0), k, **kw))
    want = {q: lists for q, lists in brute(rows, lambda q: q % every == 0, k).items() if any(lists)}
    assert set(got) == set(want)
    for q in want:
        assert sorted(got[q]) == want[q], q


@pytest.mark.parametrize("block", [1, 3, 128])
def test_random_and_awkward_vectors(spark, block):
    r = random.Random(block)
    rows = [(i, [r.choice([0.0, 0.5, -0.5, r.uniform(-1, 1)]) for _ in range(r.choice([4, 4, 4, 2, 6]))]) for i in range(60)]
    rows += [(100, []), (102, []), (103, None), (105, [1.0, None]), (108, [float("nan"), 1.0]), (111, [float("inf")]), (None, [1.0] * 4), (114, [1e6] * 4), (-3, [0.25] * 4)]
    check(spark, rows, block_rows=block, blocks_per_bundle=4, queries_per_batch=5)


def test_ties_go_to_the_smaller_id(spark):
    check(spark, [(i, [1.0, 0.0]) for i in range(30)], block_rows=4, blocks_per_bundle=2)


def test_rows_that_repeat_an_id(spark):
    rows = [(i, [0.1 * i, 1.0]) for i in range(8)] + [(4, [9.0, 9.0]), (4, [9.0, 9.0]), (6, [3.0, 3.0])]
    check(spark, rows, every=3, k=4, block_rows=2)


def test_few_or_no_vectors(spark):
    check(spark, [(0, [1.0]), (1, [2.0])])
    check(spark, [(0, [1.0])])
    check(spark, [])
    check(spark, [(0, []), (3, []), (4, [])])


def test_long_vectors(spark):
    r = random.Random(1)
    check(spark, [(i, [r.uniform(-1, 1) for _ in range(5000)]) for i in range(12)])


def test_query_on_the_whole_table(spark):
    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.001/embeddings.parquet'").fetchall()
    assert found(op10_topk_search(spark, "/root/testdata/sf0.001")) == brute(rows, lambda q: q % 50 == 0, 5)
