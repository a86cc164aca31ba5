import zlib

import corpus_pipeline as p
import numpy as np
import public_tokenizers
import pytest
from blotter.llm.byte_bpe import CHUNK_CHARS
from blotter.llm.queries import op8_token_packing
from blotter.llm.token_packing import encode_added, load_vocabulary, pack, sequences
from helpers import AWKWARD, docs
from tokenizers import Tokenizer

JSON = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [f"{END} hi", f"a{END}b", f"a  {END}  b", f"{END}{END}", f"it{END}'s \n{END}\n", "<|endoftext|", f"<|endof{END}text|>",
         f"word {END} " * (CHUNK_CHARS // 8), f"x{END}" * (CHUNK_CHARS // 8)]
ROWS = [*AWKWARD, *((100 + k, t) for k, t in enumerate(TEXTS))]


@pytest.fixture(scope="module")
def contract():
    """The library as it comes: added tokens in a text have their own ids."""
    t = Tokenizer.from_file(JSON)
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_quoted_added_tokens_have_their_own_ids(contract):
    enc = load_vocabulary(JSON)
    assert encode_added(enc, TEXTS[0]) == [50256, 23105] and encode_added(enc, TEXTS[1]) == [64, 50256, 65]
    for t in [*TEXTS, *(t or "" for _, t in AWKWARD)]:
        assert encode_added(enc, t) == contract(t)


def pieces_of(rows, contract):
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([*contract(t or ""), 1])
    return want


def same_ids(got, want):
    for r in got:
        own = [x for x in want[r["doc_id"]] if len(x) == r["doc_tokens"]]
        assert r["ids_crc32"] in [zlib.crc32(np.asarray(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) for x in own]
    assert sum(r["length"] for r in got) == sum(len(x) for v in want.values() for x in v)


def test_op8_and_the_pipeline_pack_the_contracts_ids(spark, tmp_path, contract):
    frame = docs(spark, ROWS)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    want = pieces_of(ROWS, contract)
    same_ids(op8_token_packing(spark, str(tmp_path)).collect(), want)
    same_ids(dict(p.STAGES)["packing"](spark, frame, str(tmp_path)).collect(), want)


def test_sequences_hold_them_too(spark, contract):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    frame = docs(spark, rows)
    pieces = pack(frame, JSON, added=True)
    held = sum(np.frombuffer(bytes(r["ids"]), "<u4").tolist().count(50256) for r in sequences(frame, pieces, JSON, added=True).collect())
    assert held == sum(contract(t).count(50256) for t in TEXTS) > len(TEXTS)
