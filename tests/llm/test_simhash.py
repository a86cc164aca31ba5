import hashlib
import random

from blotter.llm.queries import op3_simhash
from blotter.llm.simhash import BITS, edited, fingerprint_documents, fingerprints, with_next, within_radius
from helpers import AWKWARD, docs
from pyspark.sql import functions as F


def brute_edits(rows):
    """Documents by id (nulls first, then by text), each with its edited text."""
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    out = []
    for k, (some, i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        q = len(t) // 4
        e = t[:len(t) - q] + after[:q]
        out.append((i if some else None, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def test_next_documents_and_edits(spark):
    r = random.Random(4)
    rows = [*AWKWARD, *((r.randint(-50, 10 ** 12), " ".join(r.choice(["aa", "bé", "😀", "c"]) for _ in range(r.randint(0, 30)))) for _ in range(300))]
    got = [(x["doc_id"], x["n_chars"], x["edited_sha256"]) for x in fingerprint_documents(docs(spark, rows).repartition(5)).collect()]
    assert sorted(got, key=key) == sorted(brute_edits(rows), key=key)


def test_one_row_and_none(spark):
    got = fingerprint_documents(docs(spark, [(1, "abcd efgh")])).collect()
    assert got[0]["edited_sha256"] == hashlib.sha256(b"abcd efab").hexdigest() and got[0]["near_next"] == 1.0
    assert fingerprint_documents(docs(spark, AWKWARD).limit(0)).count() == 0
    assert with_next(docs(spark, [(5, "x"), (5, "y")])).filter("ghost = 0").count() == 2


def test_equal_texts_have_equal_prints_and_likeness_is_a_likeness(spark):
    rows = [(i, t) for i, t in AWKWARD if i is not None]
    by = {}
    for x in fingerprint_documents(docs(spark, rows)).collect():
        by.setdefault(x["doc_id"], []).append((x["f0"], x["f1"]))
        assert 0 <= x["near_edited"] <= 1 and 0 <= x["near_next"] <= 1
    assert len(set(by[5] + by[7])) == 1 and set(by[1] + by[2] + by[3]) == {(0, 0)} and by[8] != by[9]


def test_edited_texts_are_nearer_than_next_ones(spark):
    f = op3_simhash(spark, "/root/testdata/sf0.01")
    plan = f._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
    rows = f.collect()
    assert len(rows) == 1000 and all(len(r["fingerprint"]) == BITS // 4 for r in rows)
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 970
    assert sum(r["near_next"] for r in rows) / 1000 < 0.2 < 0.6 < sum(r["near_edited"] for r in rows) / 1000


def test_votes_against_brute_force(spark):
    # The sign of each bit's weighted votes, from Spark's own hash of each term.
    text = "alpha beta gamma delta beta alpha beta"
    words = text.split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    hashes = spark.createDataFrame([(p,) for p in pairs], "t string").select("t", F.xxhash64("t").alias("h"), F.xxhash64("t", F.lit(1)).alias("g")).collect()
    want = []
    for half in ("h", "g"):
        bits = 0
        for b in range(64):
            if sum((1 if r[half] >> b & 1 else -1) * len(r["t"]) for r in hashes) > 0:
                bits |= 1 << b
        want.append(bits)
    got = fingerprints(spark.createDataFrame([(1, text)], "id int, text string"), ["id"]).first()
    assert [got["f0"] & (2 ** 64 - 1), got["f1"] & (2 ** 64 - 1)] == want


def test_all_prints_within_the_radius(spark):
    r = random.Random(6)
    signed = lambda v: v - 2 ** 64 if v >= 2 ** 63 else v
    base = [r.getrandbits(128) for _ in range(30)]
    prints = list(base)
    for b in base:
        for n in (1, 3, 4, 5, 8):
            v = b
            for bit in r.sample(range(128), n):
                v ^= 1 << bit
            prints += [v, v]
    frame = lambda vs: spark.createDataFrame([(signed(v & (2 ** 64 - 1)), signed(v >> 64)) for v in vs], "f0 bigint, f1 bigint")
    for radius in (0, 3, 4):
        got = {(x["q0"], x["q1"], x["f0"], x["f1"], x["distance"]) for x in within_radius(frame(base), frame(prints), radius).collect()}
        want = {(*frame_row(a, signed), *frame_row(b, signed), (a ^ b).bit_count()) for a in set(base) for b in set(prints) if (a ^ b).bit_count() <= radius}
        assert got == want
    assert within_radius(frame(base).limit(0), frame(prints), 3).count() == 0


def frame_row(v, signed):
    return signed(v & (2 ** 64 - 1)), signed(v >> 64)


def test_edited_expression(spark):
    d = spark.createDataFrame([("abcdefgh", "XY"), ("abc", "XY"), ("", "XY"), ("äöüßäöüß", "12345")], "a string, b string")
    assert [r[0] for r in d.select(edited(F.col("a"), F.col("b"))).collect()] == ["abcdefXY", "abc", "", "äöüßäö12"]
