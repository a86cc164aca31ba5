"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Long texts are cut at safe boundaries before encoding, so no single call
works on an unbounded string: a single space between two characters that
are not white space always starts a new match of the split pattern (a
match holds at most one leading space, and only runs of white space match
across several), so the pieces' ids joined are the ids of the whole text.
A long run of white space, on which the split pattern's lookahead would
backtrack through the whole run, is one match but for its last character,
and all of it at the text's end: it is merged as one, without the pattern.
Decoding returns raw bytes; single ids need not be valid UTF-8.

Defined results: a null text is empty; an empty text has no ids, and the
digests of no bytes; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import map_batches, texts

CHUNK_CHARS = 32_768
SAFE = re.compile(r"(?<=\S) (?=\S)")
# What the split pattern takes for white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = re.compile(f"[{WHITE}]{{2048,}}")


@lru_cache(maxsize=4)
def load_ranks(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The encoding of a rank file (base64 token and rank per line); one per Python worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """Pieces of ``text`` of about ``size`` characters, cut where a match must start.

    Without such a place a piece is longer: the cut is only made where it
    can't change the ids.
    """
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def runs_apart(text: str, added: Iterable[str] = ()) -> Iterator[tuple[str, bool]]:
    """(piece, whether it is one match of white space) of ``text``: long runs of white space on their own.

    A run's last character goes with what follows, unless that is the end or
    one of the ``added`` tokens, which are cut out before the pattern is used.
    """
    at = 0
    for m in LONG_RUN.finditer(text):
        last = m.end() == len(text) or any(text.startswith(a, m.end()) for a in added)
        end = m.end() if last else m.end() - 1
        if m.start() > at:
            yield text[at:m.start()], False
        yield text[m.start():end], True
        at = end
    if at < len(text):
        yield text[at:], False


def pieces(text: str, added: Iterable[str] = ()) -> Iterator[tuple[str, bool]]:
    """``runs_apart`` with other pieces cut to a bounded length where that is safe."""
    for part, run in runs_apart(text, added):
        if run:
            yield part, True
        else:
            yield from ((piece, False) for piece in safe_pieces(part))


def run_ids(encoding: tiktoken.Encoding, run: str) -> list[int]:
    """The ids of one match."""
    return encoding._encode_single_piece(run.encode("utf-8"))


def encode(encoding: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= CHUNK_CHARS:
        return encoding.encode_ordinary(text)
    return [i for piece, run in pieces(text) for i in (run_ids(encoding, piece) if run else encoding.encode_ordinary(piece))]


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
                     pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id_col, ids, decoded): the ids of every text, and the bytes they decode to."""
    def start():
        encoding = load_ranks(ranks_path, pattern)

        def run(batch: pa.RecordBatch) -> dict:
            ids = [encode(encoding, t) for t in texts(batch, text_col)]
            return {"ids": ids, "decoded": [encoding.decode_bytes(i) for i in ids]}
        return run

    return map_batches(docs.select(id_col, text_col), [id_col], start,
                       {"ids": pa.list_(pa.int32()), "decoded": pa.binary()})


def encoding_digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
                     pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of what ``encode_documents`` returns.

    Computed where the ids are made, so neither they nor the decoded bytes leave the Python worker.
    """
    def start():
        encoding = load_ranks(ranks_path, pattern)

        def run(batch: pa.RecordBatch) -> dict:
            counts, digests, back = [], [], []
            for text in texts(batch, text_col):
                ids = encode(encoding, text)
                counts.append(len(ids))
                digests.append(hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest())
                back.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
            return {"n_tokens": counts, "ids_sha256": digests, "decoded_sha256": back}
        return run

    return map_batches(docs.select(id_col, text_col), [id_col], start,
                       {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()})
