"""Packing of token sequences by cutting-stock column generation.

Documents are tokenised (byte-level BPE, then an end id) and packed into
sequences of ``SEQUENCE`` tokens:

* whole sequences are cut off long documents first; what is left of each is
  shorter than a sequence and stays in one piece;
* those rests are counted by length class, ``CLASS_WIDTH`` lengths to a
  class, rounded up. The histogram (``SEQUENCE`` / ``CLASS_WIDTH`` numbers,
  whatever the input's size) goes to a linear program over patterns, the
  ways to fill a sequence. Its columns are generated: a dynamic program
  over the classes' shadow prices (an unbounded knapsack) finds the
  cheapest patterns, until none is worth adding. Rounded down, the solution
  says how many sequences to fill by each pattern; the rests that rounding
  leaves are counted out largest first;
* the documents of each class are ranked, and a rank says which pattern's
  which sequence it goes to: plain arithmetic in every task, on a table of
  patterns of bounded size. A window over each sequence (at most
  ``SEQUENCE`` pieces) then lays its pieces end to end.

What is padded is what rounding up to a class adds, a few tokens a
sequence, and the end of the last few sequences.

Ranks are dense per class: rows are numbered within each task's part of a
table written once, and a part's first number per class is a sum over the
counts of the parts before; a length that a third of all documents have is
no bottleneck.

Defined results: a null text is empty, an empty text is the end id alone;
repeated rows are packed each; without rows there are no sequences. An added
token of the vocabulary that a text quotes (``<|endoftext|>``) has its own id
with ``added``, as the tokenizers library gives by default; without it the
token is ordinary text.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import encode, pieces, run_ids
from .common import map_batches, texts, write_table

SEQUENCE = 2048
CLASS_WIDTH = 8
END_ID = 1
# The linear program stops when no pattern could still improve it by this share.
GAP = 0.002
PER_ROUND = 64          # columns added between two pricings
ROUNDS = 400

# Fixed value: the pattern by which byte-level BPE of this kind splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# --- tokens -----------------------------------------------------------------

def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or 256 and up in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> tiktoken.Encoding:
    """The encoding of a tokenizers JSON file of a byte-level BPE, run by tiktoken (several times as fast).

    Both merge the pair of lowest rank first, so the ids are the same if the
    file's merges make its ids in order; that is checked here. Added tokens
    must be found alike by both, and in pieces of a text: without white
    space, and none within another.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, byte_of = spec["model"], _byte_of()
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    if model["type"] != "BPE" or "ByteLevel" not in json.dumps(spec["pre_tokenizer"]) or ids != sorted(set(ids)):
        raise ValueError(f"{path}: not a byte-level BPE whose merges make its ids in order")
    if (any(t[k] for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip"))
            or any(len(a.split()) != 1 or a != a.strip() for a in added) or any(a != b and a in b for a in added for b in added)):
        raise ValueError(f"{path}: added tokens that take in their surroundings, hold white space or one another")
    return tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)


def encode_added(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """Like ``encode``, but added tokens in the text have their own ids."""
    added = encoding.special_tokens_set
    return [i for piece, run in pieces(text, added) for i in (run_ids(encoding, piece) if run else encoding.encode(piece, allowed_special="all"))]


def token_crcs(ids: bytes) -> tuple[list[int], int]:
    """CRC-32 of each whole sequence at the front of a document's ids, and of the rest."""
    step, n = 4 * SEQUENCE, len(ids) // (4 * SEQUENCE)
    view = memoryview(ids)
    return [zlib.crc32(view[k * step:(k + 1) * step]) for k in range(n)], zlib.crc32(view[n * step:])


def _ids(encoding: tiktoken.Encoding, text: str, added: bool) -> bytes:
    """A document's ids with the end id, as little-endian unsigned 32-bit integers."""
    return np.asarray([*(encode_added if added else encode)(encoding, text), END_ID], "<u4").tobytes()


def tokenized(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """(id_col, ids): each document's ids with the end id, as bytes."""
    def start():
        encoding = load_vocabulary(vocabulary)

        def run(batch: pa.RecordBatch) -> dict:
            return {"ids": [_ids(encoding, t, added) for t in texts(batch, text_col)]}
        return run

    return map_batches(docs.select(id_col, text_col), [id_col], start, {"ids": pa.binary()})


MEASURED = {"tokens": pa.int64(), "wholes": pa.int64(), "rest": pa.int64(), "size": pa.int64(), "crcs": pa.list_(pa.int64()),
            "rest_crc": pa.int64(), "part": pa.int64(), "rest_rank": pa.int64(), "whole_rank": pa.int64()}


def _measured(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, added: bool) -> DataFrame:
    """(id_col, *MEASURED): lengths and digests, made where the ids are, and the numbers of a row within its part.

    ``size`` is the rest's class; ``rest_rank`` counts the rows before it in
    the part with the same class, ``whole_rank`` the whole sequences before
    it in the part.
    """
    def start():
        encoding = load_vocabulary(vocabulary)
        part, seen, wholes_seen = TaskContext.get().partitionId(), [0] * (SEQUENCE + 1), 0

        def run(batch: pa.RecordBatch) -> dict:
            nonlocal wholes_seen
            out: dict[str, list] = {k: [] for k in MEASURED}
            for text in texts(batch, text_col):
                ids = _ids(encoding, text, added)
                n, (crcs, rest_crc) = len(ids) // 4, token_crcs(ids)
                size = -(-(n % SEQUENCE) // CLASS_WIDTH)
                for k, v in zip(MEASURED, (n, len(crcs), n % SEQUENCE, size, crcs, rest_crc, part, seen[size], wholes_seen)):
                    out[k].append(v)
                seen[size] += 1
                wholes_seen += len(crcs)
            return out
        return run

    return map_batches(docs.select(id_col, text_col), [id_col], start, MEASURED)


# --- patterns ---------------------------------------------------------------

def _cheapest(prices: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The cost of the cheapest way to fill each size exactly, and the last length (index) of it, -1 where there is none."""
    cost, last = np.full(size + 1, np.inf), np.full(size + 1, -1, np.int64)
    cost[0] = 0.0
    for c in range(1, size + 1):
        fits = np.searchsorted(lengths, c, "right")
        if fits:
            total = cost[c - lengths[:fits]] + prices[:fits]
            k = int(total.argmin())
            if total[k] < np.inf:
                cost[c], last[c] = total[k], k
    return cost, last


def _pattern(last: np.ndarray, lengths: np.ndarray, size: int) -> dict[int, int]:
    """{index of a length: copies} of the cheapest way to fill ``size``."""
    a: dict[int, int] = {}
    while size > 0:
        k = int(last[size])
        a[k] = a.get(k, 0) + 1
        size -= int(lengths[k])
    return a


def fill_patterns(histogram: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({class: copies} that sum to ``size``) and how often to use each, within the histogram.

    Maximises the number of full sequences, by column generation with a
    revised simplex method, and rounds down.
    """
    lengths = np.array(sorted(n for n in histogram if 0 < n < size), np.int64)
    if not len(lengths):
        return []
    have = np.array([float(histogram[n]) for n in lengths])
    m = len(lengths)
    inverse, x = np.eye(m), have.copy()             # basis of slacks: nothing packed
    columns: list[np.ndarray | None] = [None] * m   # pattern of each basic variable; None: a slack
    gain = np.zeros(m)

    def enter(column: np.ndarray, worth: float, pattern: np.ndarray | None) -> None:
        rows = np.flatnonzero(np.abs(column) > 1e-11)
        able = rows[column[rows] > 1e-9]
        if worth - gain[rows] @ column[rows] < 1e-9 or not len(able):
            return
        ratio = np.maximum(x[able], 0.0) / column[able]
        r = int(able[ratio.argmin()])
        step = ratio.min()
        x[rows] -= step * column[rows]
        x[r] = step
        cols = np.flatnonzero(inverse[r])
        pivot = inverse[r, cols] / column[r]
        inverse[np.ix_(rows, cols)] -= np.outer(column[rows], pivot)
        inverse[r, cols] = pivot
        columns[r], gain[r] = pattern, worth

    for _ in range(ROUNDS):
        packed = np.flatnonzero(gain)
        prices = gain[packed] @ inverse[packed]
        priced = np.maximum(prices, 0.0)
        # Of equally cheap patterns those of fewer and so longer pieces.
        cost, last = _cheapest(priced + 1e-7, lengths, size)
        least = cost[size]
        if least == np.inf:
            break
        # Scaled so that every pattern costs at least 1, the prices are dual feasible: a bound on any solution.
        value, bound = gain[packed] @ x[packed], have @ lengths / size
        if least > 0.01:
            bound = min(bound, have @ (priced + 1e-7) / least)
        wrong = np.flatnonzero(prices < -1e-9)
        if not len(wrong) and (least >= 1.0 - 1e-6 or bound - value <= GAP * bound):
            break
        for k in wrong[np.argsort(prices[wrong])][:PER_ROUND]:
            enter(inverse[:, k].copy(), 0.0, None)
        # The cheapest pattern with each length, as long as they share none.
        through = priced + 1e-7 + cost[size - lengths]
        seen: set[int] = set()
        chosen = 0
        for k in np.argsort(through, kind="stable"):
            if through[k] >= 1.0 - 1e-6 or chosen == PER_ROUND:
                break
            if k in seen:
                continue
            a = _pattern(last, lengths, size - int(lengths[k]))
            a[k] = a.get(k, 0) + 1
            if seen.isdisjoint(a):
                seen.update(a)
                chosen += 1
                used = np.array(list(a))
                pattern = np.array([a[i] for i in used], float)
                enter(inverse[:, used] @ pattern, 1.0, np.stack([used, pattern]))
    left, out = have.copy(), []
    for r in np.argsort(-x, kind="stable"):
        if columns[r] is None:
            continue
        used, copies = columns[r][0].astype(np.int64), columns[r][1]
        times = int(min(np.floor(x[r] + 1e-9), (left[used] // copies).min()))
        if times > 0:
            left[used] -= times * copies
            out.append(({int(lengths[k]): int(c) for k, c in zip(used, copies)}, times))
    return out


def count_out(histogram: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns for what is left: the largest length first, filled up with the largest that fit."""
    left, out = {n: c for n, c in histogram.items() if c > 0}, []
    while left:
        pattern: dict[int, int] = {}
        room = size
        for n in sorted(left, reverse=True):
            if copies := min(room // n, left[n]):
                pattern[n] = copies
                room -= n * copies
        times = min(left[n] // c for n, c in pattern.items())
        out.append((pattern, times))
        for n, c in pattern.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return out


class Plan:
    """Which sequence the rest of each class and rank goes to; a table of bounded size that every task holds."""

    def __init__(self, histogram: dict[int, int], size: int = SEQUENCE // CLASS_WIDTH):
        self.patterns = fill_patterns(histogram, size)
        left = dict(histogram)
        for pattern, times in self.patterns:
            for n, copies in pattern.items():
                left[n] -= copies * times
        self.patterns += count_out(left, size)
        taken = dict.fromkeys(histogram, 0)
        slots: dict[int, list[tuple[int, int, int]]] = {}       # per class: (first rank, copies, first sequence)
        self.sequences = 0
        for pattern, times in self.patterns:
            for n, copies in pattern.items():
                slots.setdefault(n, []).append((taken[n], copies, self.sequences))
                taken[n] += copies * times
            self.sequences += times
        self.slots = {n: np.array(s, np.int64) for n, s in slots.items()}

    def sequence(self, size: int, ranks: np.ndarray) -> np.ndarray:
        """The sequences of the rests of one class with these ranks."""
        slots = self.slots[size]
        first, copies, sequence = slots[np.searchsorted(slots[:, 0], ranks, "right") - 1].T
        return sequence + (ranks - first) // copies


# --- packing ----------------------------------------------------------------

PIECES = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("sequence_id", pa.int64()), ("ids_crc32", pa.int64())]))


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece of a document."""
    measured, _ = write_table(_measured(docs, vocabulary, id_col, text_col, added), "pack-measured")
    counts, _ = write_table(measured.filter("rest > 0").groupBy("part", "size").agg(F.count(F.lit(1)).alias("n"))
                            .unionByName(measured.groupBy("part").agg(F.sum("wholes").alias("n"))
                                         .select("part", F.lit(0).cast("bigint").alias("size"), "n")), "pack-counts")
    # At most SEQUENCE / CLASS_WIDTH numbers.
    plan = Plan({r["size"]: r["n"] for r in counts.filter("size > 0").groupBy("size").agg(F.sum("n").alias("n")).collect()})

    # What the parts before have of each class and, as class 0, of whole sequences.
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "size", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")).alias("before"))
    of_rest = offsets.filter("size > 0").withColumnRenamed("before", "rest_before")
    of_whole = offsets.filter("size = 0").select("part", F.col("before").alias("whole_before"))
    rows = (measured.join(of_rest, ["part", "size"], "left").join(of_whole, "part")
            .select(id_col, "tokens", "rest", "size", "crcs", "rest_crc",
                    F.coalesce(F.col("rest_before") + F.col("rest_rank"), F.lit(0).cast("bigint")).alias("rank"),
                    (F.col("whole_before") + F.col("whole_rank")).alias("whole")))

    def start():
        def run(batch: pa.RecordBatch) -> dict:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            sequence = np.zeros(len(size), np.int64)
            for n in np.unique(size[size > 0]):
                sequence[size == n] = plan.sequence(int(n), rank[size == n])
            made = []
            for s, tokens, rest, crcs, crc, whole in zip(sequence.tolist(), *(batch.column(c).to_pylist() for c in ("tokens", "rest", "crcs", "rest_crc", "whole"))):
                pieces = [{"start": k * SEQUENCE, "length": SEQUENCE, "sequence_id": plan.sequences + whole + k, "ids_crc32": c} for k, c in enumerate(crcs)]
                if rest:
                    pieces.append({"start": tokens - rest, "length": rest, "sequence_id": s, "ids_crc32": crc})
                made.append(pieces)
            return {"p": made}
        return run

    pieces = (map_batches(rows, [id_col, "tokens"], start, {"p": PIECES})
              .select(F.col(id_col), F.col("tokens").alias("doc_tokens"), F.explode("p").alias("p")).select(id_col, "doc_tokens", "p.*"))
    # A sequence's pieces end to end: longest first, equal ones in any fixed order.
    laid = Window.partitionBy("sequence_id").orderBy(F.desc("length"), id_col, "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(laid), F.lit(0).cast("bigint")).alias("offset"))


def sequences(docs: DataFrame, pieces: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, for documents with unique ids.

    ``ids`` is padded with the end id to ``SEQUENCE`` unless its length is a power of two.
    ``added`` is that of the pieces.
    """
    tokens = tokenized(docs, vocabulary, id_col, text_col, added)
    cut = F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))")
    # A sequence holds at most SEQUENCE pieces.
    rows = (pieces.select(id_col, "start", "length", "sequence_id", "offset").join(tokens, id_col)
            .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", cut.alias("ids")))).alias("p"), F.sum("length").alias("n")))
    pad = F.expr(f"repeat('{END_ID:02x}000000', cast(if(bit_count(n) = 1, 0, {SEQUENCE} - n) as int))")
    return rows.select("sequence_id", F.concat(F.aggregate("p", F.lit(b""), lambda a, e: F.concat(a, e["ids"])), F.unhex(pad)).alias("ids"))
