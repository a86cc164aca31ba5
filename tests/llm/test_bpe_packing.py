import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from blotter.llm.byte_bpe import CHUNK_CHARS, encode, encode_documents, encoding_digests, load_ranks, safe_pieces
from blotter.llm.token_packing import SEQUENCE, Plan, count_out, fill_patterns, load_vocabulary, pack, sequences
from helpers import AWKWARD, docs
from tokenizers import Tokenizer

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["  a  b", "a b\n c", " x", "x ", "it's  5 o'clock\t x", "\n\n a", "é ü　 z", "a \n b", "<|endoftext|> hi", "a\u00a0 b", "\u2028 x", "😀"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_cuts_are_safe():
    r, enc = random.Random(1), load_ranks(MULTI)
    for _ in range(200):
        text = "".join(r.choice([" ", "  ", "a", "B", "1", ".", "\n", "é", "'s", "\u00a0", "\u3000", "😀"]) for _ in range(r.randint(0, 200)))
        pieces = list(safe_pieces(text, 5))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_round_trip_of_documents(spark):
    rows = [*AWKWARD, *((100 + i, t) for i, t in enumerate(TEXTS)), (200, "no space" * 20000), (201, "word " * (CHUNK_CHARS // 2))]
    enc = load_ranks(MULTI)
    want = sorted((i or 0, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    got = encode_documents(docs(spark, rows), MULTI).collect()
    assert sorted((r["doc_id"] or 0, list(r["ids"]), bytes(r["decoded"])) for r in got) == want
    sums = encoding_digests(docs(spark, rows), MULTI).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in sums) == sorted(
        (i, len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha(raw)) for i, ids, raw in want)
    assert encoding_digests(docs(spark, rows).limit(0), MULTI).count() == 0


def test_vocabulary_gives_the_tokenizers_ids(reference):
    enc = load_vocabulary(JSON)
    for t in [*TEXTS, *(t or "" for _, t in AWKWARD)]:
        assert encode(enc, t) == reference(t)


def test_patterns_fill_exactly_and_stay_within_the_histogram():
    r = random.Random(2)
    for size, most in ((16, 30), (64, 400), (256, 5000)):
        histogram = {n: r.randint(0, most * 4 // n) for n in range(1, size + 1)}      # short ones are many
        left = dict(histogram)
        for pattern, times in fill_patterns(histogram, size):
            assert times > 0 and sum(n * c for n, c in pattern.items()) == size
            for n, c in pattern.items():
                left[n] -= c * times
        assert min(left.values()) >= 0
        total = sum(n * c for n, c in histogram.items())
        packed = [*fill_patterns(histogram, size), *count_out(left, size)]
        assert sum(t for _, t in packed) <= 1.02 * total / size + 1
    assert fill_patterns({}, 16) == [] and count_out({3: 2}, 4) == [({3: 1}, 2)]


def test_plan_puts_every_rank_somewhere():
    histogram = {n: (n * 7) % 11 for n in range(1, 17)}
    plan, used = Plan(histogram, 16), {}
    for n, have in histogram.items():
        for s in plan.sequence(n, np.arange(have)) if have else []:
            used[int(s)] = used.get(int(s), 0) + n
    assert max(used.values()) <= 16 and set(used) == set(range(plan.sequences))


def check(rows, got, reference):
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*reference(t or ""), 1])
    per_sequence = {}
    for r in got:
        own = [x for x in ids[r["doc_id"]] if len(x) == r["doc_tokens"]]
        part = lambda x: zlib.crc32(np.asarray(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
        assert r["ids_crc32"] in [part(x) for x in own]
        per_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in per_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= SEQUENCE
    assert sum(r["length"] for r in got) == sum(len(x) for v in ids.values() for x in v)


def test_packs_awkward_documents(spark, reference):
    rows = [*AWKWARD, *((100 + i, t) for i, t in enumerate(TEXTS))]
    got = pack(docs(spark, rows), JSON).collect()
    check(rows, got, reference)
    assert pack(docs(spark, rows).limit(0), JSON).count() == 0


def test_packs_a_table_with_little_padding(spark, reference):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = pack(d, JSON)
    got = pieces.collect()
    check([(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()], got, reference)
    lengths = {}
    for r in got:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    padding = sum(0 if n & (n - 1) == 0 else SEQUENCE - n for n in lengths.values())
    assert padding <= 0.01 * sum(lengths.values()) + SEQUENCE
    # The sequences themselves: documents' ids in order, padded.
    texts = {r["doc_id"]: [*reference(r["text"]), 1] for r in d.select("doc_id", "text").collect()}
    by = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        by.setdefault(r["sequence_id"], []).extend(texts[r["doc_id"]][r["start"]:r["start"] + r["length"]])
    for r in sequences(d, pieces, JSON).collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        want = by[r["sequence_id"]]
        assert ids[:len(want)] == want and (len(ids) == len(want) if len(want) & (len(want) - 1) == 0 else len(ids) == SEQUENCE)
