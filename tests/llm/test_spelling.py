import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import pytest
from blotter.llm import spelling
from blotter.llm.queries import op12_spelling
from blotter.llm.spelling import spelling_variants
from helpers import AWKWARD, docs
from pyspark.sql import functions as F

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edit_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def words_of(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute(rows):
    n = words_of(rows)
    near = defaultdict(set)
    # Words that agree without one code point, or are the other without one: an exact filter before edit_one.
    slots = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            slots[w[:k] + w[k + 1:]].add(w)
    for short, group in slots.items():
        group = group | ({short} if short in n else set())
        for a in group:
            near[a] |= {b for b in group if edit_one(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    out = {r[0]: r[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def misspelled(seed, size):
    """Texts of a few stems and their edits, some edits of edits."""
    r = random.Random(seed)
    letters = "abcdeàéÿZ÷×"
    stems = ["".join(r.choice(letters) for _ in range(r.randint(5, 9))) for _ in range(12)]
    pool = [(s, 700) for s in stems]
    for weight in (60, 8):
        for s, w in list(pool):
            for _ in range(3):
                k = r.randrange(len(s) + 1)
                pool.append((r.choice([s[:k] + r.choice(letters) + s[k:], s[:k] + s[k + 1:], s[:k] + r.choice(letters) + s[k + 1:]]), weight))
    words = r.choices([s for s, _ in pool], [w for _, w in pool], k=size)
    return [(i, r.choice([" ", "1", "\n", "·", "٠"]).join(words[i::300])) for i in range(300)]


@pytest.mark.parametrize("crowded", [spelling.CROWDED, 3, 0])
def test_random_misspellings(spark, crowded):
    rows = misspelled(3, 20_000)
    want = brute(rows)
    assert any(v[1] not in (w, v[0]) for w, v in want.items()), "no chain of forms"
    assert found(spelling_variants(docs(spark, rows), crowded=crowded)) == want


def test_one_reduced_word_for_all(spark):
    """All letters of one symbol: every word of a length shares its reduced word."""
    r = random.Random(4)
    same = [c for c in spelling.LETTERS if spelling.symbol_of(c) == "1"]
    vocab = sorted({"".join(r.choice(same) for _ in range(6)) for _ in range(300)})
    rows = [(i, " ".join(vocab[i % 7:] * 6)) for i in range(3)]
    for crowded in (1, 10_000):
        assert found(spelling_variants(docs(spark, rows), crowded=crowded)) == brute(rows)


def test_awkward_rows(spark):
    rows = [*AWKWARD, (13, "ÀÉÎõü " * 9), (14, "Straße straße STRASSE " * 7), (None, "nullid nullid"), (15, "nullid nullid nullid " + "x" * 200_000),
            (15, "ab" * 40_000 + " abcdef"), (2**62, "abcdef " * 20_000)]
    assert found(spelling_variants(docs(spark, rows))) == brute(rows)
    assert spelling_variants(docs(spark, rows).limit(0)).count() == 0
    nulls = docs(spark, rows).withColumn("text", F.lit(None).cast("string"))
    assert spelling_variants(nulls).count() == 0


def test_cut_texts_are_as_whole(spark, monkeypatch):
    rows = misspelled(5, 4_000)
    monkeypatch.setattr(spelling, "CHUNK_CHARS", 11)
    assert found(spelling_variants(docs(spark, rows))) == brute(rows)


def test_query_on_the_whole_table(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    assert found(op12_spelling(spark, "/root/testdata/sf0.01")) == brute(rows)


def test_no_python_in_the_plan(spark):
    words = spelling.vocabulary(spelling.runs(docs(spark, AWKWARD)))
    plan = spelling.near_words(words)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_only_the_crowded_words_are_broadcast(spark, tmp_path, monkeypatch):
    # Spark sizes a neighbourhood as the few words it is made of, and would broadcast its many rows.
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.createDataFrame([(w, n) for w, n in (("summer", 900), ("sumer", 7), ("summers", 20), ("winter", 50))], "word string, n bigint").write.parquet(f"{tmp_path}/words")
    words = spark.read.parquet(f"{tmp_path}/words")
    plan = plan_of(spelling.near_words(words))
    assert plan.count("SortMergeJoin") == 2
    joins = re.findall("BroadcastHashJoin .*", plan)
    assert joins and all("LeftAnti, BuildRight" in j or "LeftSemi, BuildRight" in j for j in joins)

    written, write = [], spelling.write_table
    monkeypatch.setattr(spelling, "write_table", lambda df, name: written.append(plan_of(df)) or write(df, name))
    grouped, _ = write(spelling.forms(words, spelling.near_words(words)), "grouped")
    roots = {r["word"]: r["root"] for r in spelling.with_roots(grouped).collect()}
    assert roots == {"summer": "summer", "sumer": "summer", "summers": "summer", "winter": "winter"}
    assert sum("SortMergeJoin" in p for p in written) >= 2 and not any("BroadcastHashJoin" in p for p in written)
