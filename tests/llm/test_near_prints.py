import random

from blotter.llm.queries import op3_simhash
from blotter.llm.simhash import RADIUS, fingerprint_documents, near_counts, within_radius
from helpers import AWKWARD, docs


def signed(v):
    return v - 2 ** 64 if v >= 2 ** 63 else v


def brute(prints, radius):
    """{print: (others within the radius, distance of the nearest)} of distinct prints."""
    out = {}
    for a in prints:
        near = [d for b in prints if 0 < (d := (a ^ b).bit_count()) <= radius]
        out[a] = (len(near), min(near, default=None))
    return out


def test_counts_against_brute_force(spark):
    r = random.Random(8)
    prints = [0]
    for b in [r.getrandbits(128) for _ in range(25)]:
        prints.append(b)
        for n in (1, 2, 3, 4, 5, 6):
            prints += [v := b ^ sum(1 << k for k in r.sample(range(128), n)), v]
    frame = spark.createDataFrame([(signed(v & (2 ** 64 - 1)), signed(v >> 64)) for v in prints], "f0 bigint, f1 bigint")
    for radius in (0, 3, 4, 7):
        got = {(x["f1"] % 2 ** 64) << 64 | x["f0"] % 2 ** 64: (x["near_prints"], x["nearest"]) for x in near_counts(frame, radius).collect()}
        assert got == brute(set(prints), radius)
        # Every pair once, though several tables bring it together.
        pairs = [tuple(x) for x in within_radius(frame, frame, radius).collect()]
        assert len(pairs) == len(set(pairs)) == sum(1 + n for n, _ in got.values())


def near_of_query(spark, sf_dir):
    rows = op3_simhash(spark, sf_dir).collect()
    want = brute({int(x["fingerprint"], 16) for x in rows}, RADIUS)
    assert all((x["near_prints"], x["nearest"]) == want[int(x["fingerprint"], 16)] for x in rows)
    return rows


def test_the_query_finds_near_texts_that_are_no_neighbours(spark, tmp_path):
    r = random.Random(9)
    text = lambda: " ".join(f"w{r.randint(0, 10 ** 6)}" for _ in range(400))
    base = text()
    rows = [*AWKWARD, *((k, text()) for k in range(100, 130)), (200, base), (300, base + " end"), (400, base)]
    rows += [(k, text()) for k in range(201, 240)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = near_of_query(spark, str(tmp_path))
    assert len(got) == len(rows)
    near = {x["doc_id"]: x["near_prints"] for x in got if x["doc_id"]}
    assert near[200] == near[300] == near[400] == 1 and near[100] == near[201] == 0


def test_the_query_over_a_table(spark):
    assert len(near_of_query(spark, "/root/testdata/sf0.01")) == 1000
    plan = fingerprint_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


def test_no_documents(spark, tmp_path):
    docs(spark, AWKWARD).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert op3_simhash(spark, str(tmp_path)).count() == 0
