import random
import re

import numpy as np
import pytest
from blotter.llm import path_join
from blotter.llm.components import components
from blotter.llm.path_join import near_duplicates
from blotter.llm.words import shingle_sets, word_hashes
from helpers import AWKWARD, docs


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}


def brute(rows, width, percent=80):
    """{doc_id: (size, component)} by comparing all pairs."""
    ids = [i for i, _ in rows]
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if ids[a] is not None and ids[b] is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    smallest = {}
    for k, i in enumerate(ids):
        if i is not None:
            smallest[root(k)] = min(i, smallest.get(root(k), i))
    return sorted((i is None, i or 0, len(s), smallest[root(k)] if i is not None else None) for k, (i, s) in enumerate(zip(ids, sets)))


def found(frame, width, **kw):
    rows = near_duplicates(frame, width=width, **kw).collect()
    for r in rows:
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows)


def corpus(seed, groups=12, copies=15, words=60, edits=4):
    """Groups of copies with a few changed words, so some pairs of a group are linked and others are not."""
    r = random.Random(seed)
    rows, ids = [], list(range(1, groups * copies + 1))
    r.shuffle(ids)
    for _ in range(groups):
        base = [f"w{r.randint(0, 5000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randint(0, edits)):
                text[r.randrange(words)] = f"x{r.randint(0, 9 ** 9)}"
            rows.append((ids.pop(), " ".join(text)))
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_awkward_documents(spark, width):
    rows = AWKWARD
    assert found(docs(spark, rows), width) == brute(rows, width)


def test_groups_that_are_linked_in_chains(spark):
    rows = corpus(1)
    assert found(docs(spark, rows), 2) == brute(rows, 2)


def test_large_and_loose_nodes_are_split(spark, monkeypatch):
    # Half of every text is shared by all, and nodes count as large from four members on.
    monkeypatch.setattr(path_join, "SMALL_NODE", 3)
    shared = " ".join(f"s{k}" for k in range(25))
    rows = [(i, f"{shared} {t}") for i, t in corpus(2, groups=25, copies=4, words=40, edits=3)]
    assert found(docs(spark, rows), 2) == brute(rows, 2)


def test_many_copies_of_one_text(spark):
    rows = [(i, "the same text again and again") for i in range(1, 400)] + [(1000, "the same text again and again now")]
    assert found(docs(spark, rows), 2) == brute(rows, 2)


def test_none(spark):
    assert near_duplicates(docs(spark, AWKWARD).limit(0)).count() == 0
    rows = [(1, None), (2, "")]
    assert found(docs(spark, rows), 2) == [(False, 1, 0, 1), (False, 2, 0, 2)]


def test_recall_at_the_threshold_by_the_tree_alone():
    """Two sets of similarity 0.8 meet in a node in nearly every draw of sets."""
    r = np.random.default_rng(1)
    met, n = 0, 400
    for _ in range(n):
        x = r.integers(0, 2 ** 63, 900).astype(np.uint64)
        a, b = np.sort(x[:800]), np.sort(np.concatenate([x[:711], x[811:900]]))     # 711 of 889
        sig = path_join.signatures([a, b])
        nodes = [np.concatenate([path_join.mix(np.arange(1, 5, dtype=np.uint64))])] * 2
        for _ in range(path_join.FIRST_DEPTH):
            nodes = [path_join._children(v, np.repeat(sig[k:k + 1], len(v), axis=0)).ravel() for k, v in enumerate(nodes)]
        met += bool(set(nodes[0].tolist()) & set(nodes[1].tolist()))
    assert met >= n - 2


def test_words_and_sets_of_long_texts(monkeypatch):
    from blotter.llm import words

    texts = ["A bb  ccc\n" * 50, "", None or "", "x" * 500, "é " * 300, "tail"]
    whole = [v.tolist() for v in shingle_sets(texts, 2)]
    counts = np.diff(word_hashes(texts)[1]).tolist()
    monkeypatch.setattr(words, "PART_BYTES", 64)
    assert [v.tolist() for v in shingle_sets(texts, 2)] == whole
    assert counts == [len(t.split()) for t in texts]


def test_components_against_union_find(spark):
    r = random.Random(7)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a bigint, b bigint"))[0].collect()}
    up = {v: v for e in links for v in e}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v
    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    linked = {v for a, b in links if a != b for v in (a, b)}
    assert got == {v: root(v) for v in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint"))[0].count() == 0


def test_large_components_are_asked_in_several_tasks(spark, monkeypatch):
    # Cells of two comparisons: both sides of the last confirmation are dealt and copied.
    monkeypatch.setattr(path_join, "COMPARED", 2)
    rows = corpus(4, groups=6, copies=25, words=40, edits=5)
    assert found(docs(spark, rows), 2) == brute(rows, 2)


def test_filter_before_a_join_loses_nothing(spark):
    from blotter.llm.common import likely_in

    wanted = list(range(-500, 40000, 7))
    rows = spark.range(-1000, 60000).selectExpr("id AS k", "id AS llm_id").union(spark.sql("SELECT CAST(NULL AS BIGINT), 1"))
    left = likely_in(rows, "k", spark.createDataFrame([(w,) for w in wanted], "w bigint"))
    assert left.columns == ["k", "llm_id"]
    got = [r["k"] for r in left.collect() if r["k"] is not None]
    assert set(wanted) <= set(got) and len(got) == len(set(got)) and len(got) < len(wanted) * 1.2
    assert likely_in(rows, "k", spark.createDataFrame([], "w bigint")).count() == 0


def test_wide_columns_are_neither_kept_nor_moved_longer_than_read(spark, monkeypatch):
    # Signatures are deleted once the nodes are known; of the full sets only those compared are shuffled.
    written, plans = {}, {}
    write, drop = path_join.write_table, path_join.remove

    def writing(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        if name in ("near-best", "near-sets", "near-asked", "near-more"):
            assert not [n for n, columns in written.values() if "minwise" in columns], name
        table, at = write(df, name)
        written[at] = name, df.columns
        return table, at

    def removing(session, *paths):
        for p in paths:
            written.pop(p, None)
        drop(session, *paths)

    monkeypatch.setattr(path_join, "write_table", writing)
    monkeypatch.setattr(path_join, "remove", removing)
    rows = corpus(4, groups=6, copies=25, words=40, edits=5)
    assert found(docs(spark, rows), 2) == brute(rows, 2)
    assert "near-best" in plans and all("llm_word" in plans[n] for n in ("near-star", "near-more", "near-members"))
    assert [n for n, _ in written.values()] == ["near-result"]


def test_only_links_between_components_are_followed_again(spark, monkeypatch):
    # The driver had to run all rounds over all links twice.
    asked, follow = [], path_join.components

    def following(links):
        asked.append({(r["a"], r["b"]) for r in links.collect()})
        return follow(links)

    monkeypatch.setattr(path_join, "components", following)
    rows = corpus(4, groups=6, copies=25, words=40, edits=5)
    assert found(docs(spark, rows), 2) == brute(rows, 2)
    first, again = asked
    roots = {v["component"] for v in follow(spark.createDataFrame(sorted(first), "a bigint, b bigint"))[0].collect()}
    linked = {x for link in first for x in link}
    assert again and not again & first and len(again) < len(first)
    assert all(x in roots or x not in linked for link in again for x in link)


def test_ids_shared_by_several_texts_stay_single_rows(spark):
    rows = corpus(5, groups=4, copies=20, words=40, edits=5)
    rows += [(i, t + " and more") for i, t in rows[::4]]
    got = near_duplicates(docs(spark, rows), width=2).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)


def test_listings_of_written_tables_are_not_cached(spark, monkeypatch):
    from blotter.llm import common
    from pyspark.sql import DataFrameReader

    seen, read = [], DataFrameReader.parquet
    before = spark.conf.get(common.LISTINGS)

    def reading(self, *paths, **options):
        seen.append(spark.conf.get(common.LISTINGS))
        return read(self, *paths, **options)

    monkeypatch.setattr(DataFrameReader, "parquet", reading)
    table, at = common.write_table(spark.range(10), "listed")
    assert seen == ["0"] and spark.conf.get(common.LISTINGS) == before
    assert table.count() == 10
    common.remove(spark, at)


def test_words_are_worked_on_in_parts_of_half_a_megabyte():
    # Each part takes some forty times its bytes, in each worker, and the tables of powers sixteen.
    from blotter.llm import words

    assert words.PART_BYTES <= 1 << 19 and words._powers(words.PART_BYTES + 1)[0].nbytes < 1 << 23
