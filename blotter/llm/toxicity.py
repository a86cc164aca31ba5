"""Toxicity scores of whole documents by a recurrent network over overlapping windows.

The network (``recurrent_net``: bidirectional gated recurrent units with
attention pooling over word and character inputs) is trained in one task, on
a bounded sample of labelled documents, and sent to the others; they score
every window of every document. A document is as toxic as its worst window:
its score is the largest window score, calibrated to a probability on the
sample.

The sample is at most ``per_class`` documents of each label, of at most
``max_chars`` characters, chosen by a hash of their id; only documents
whose CRC-32 of the id as text leaves a remainder other than 0 modulo
``FOLDS`` are ever learnt from. Text alone is an input of a score.

Defined results: a null text is empty; texts without words have a score
near 0; repeated rows have equal scores (up to rounding of sums); a document
labelled twice counts as toxic if one label says so; with no label of one
kind to learn from every score is 0.
"""

from __future__ import annotations

import pickle
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_one_task, labelled_sample, map_batches, texts
from .recurrent_net import STRIDE, WINDOW, Net, score_texts, train

FOLDS = 5
TEXT_CHARS = 500_000            # longer texts are scored in overlapping stretches
GROUP_CHARS = 250_000           # texts scored together
# The network's words: runs of ASCII letters and of anything beyond ASCII.
WORD = re.compile("[A-Za-z\x80-\U0010ffff]+")


def held_out(doc_id: Column) -> Column:
    """Documents that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, text, label) of the bounded sample."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    return labelled_sample(docs, known, per_class, max_chars, id_col, text_col)


def fitted(some: list[str], labels: list[int], epochs: int) -> tuple[Net | None, float, float]:
    """The net and its calibration; no net without both labels."""
    known = np.array(labels, np.int64)
    if len(set(labels)) != 2:
        return None, 1.0, 0.0
    net = train(some, known, epochs=epochs)
    return net, *calibration(worst_windows(net, some), known)


def stretches(text: str) -> list[str]:
    """A long text in stretches whose windows are together the windows of the text.

    Words are those of the network. A stretch ends where a window of the
    text does, and the next begins with the next window, so no stretch has a
    window that the text doesn't have; the last is at least a window long.
    """
    if len(text) <= TEXT_CHARS:
        return [text]
    starts, ends = array("q"), array("q")
    for m in WORD.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
    n, first, out = len(starts), 0, []
    while True:
        last = first + WINDOW               # words of the stretch end before this one
        while last + STRIDE <= n and ends[last + STRIDE - 1] - starts[first] <= TEXT_CHARS:
            last += STRIDE
        if last >= n or ends[-1] - starts[first] <= TEXT_CHARS:
            break
        out.append(text[starts[first]:starts[last]])
        first = last - WINDOW + STRIDE
    # The text's last window ends with it; one or two more windows of the grid may come twice.
    while first and first > n - WINDOW:
        first -= STRIDE
    return [*out, text[starts[first]:]] if n else [""]


def worst_windows(net: Net, some: list[str]) -> np.ndarray:
    """The largest window score of each text, with bounded memory."""
    pieces, owner = [], []
    for k, t in enumerate(some):
        for p in stretches(t):
            pieces.append(p)
            owner.append(k)
    best = np.full(len(some), -np.inf)
    a = 0
    while a < len(pieces):
        b, size = a + 1, len(pieces[a])
        while b < len(pieces) and size + len(pieces[b]) <= GROUP_CHARS:
            size += len(pieces[b])
            b += 1
        np.maximum.at(best, owner[a:b], score_texts(net, pieces[a:b]))
        a = b
    return best


def calibration(scores: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic fit of labels on scores (balanced classes, smoothed targets)."""
    up, down = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    weight = np.where(labels == 1, 0.5 / up, 0.5 / down)
    a, b = 1.0, 0.0
    x = np.stack([scores, np.ones_like(scores)], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * scores + b, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * np.array([a - 1.0, 0.0])
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, grad), -2, 2)
    return max(float(a), 1e-3), float(b)


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_chars: int = 20_000, epochs: int = 5,
                   keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(keep..., held_out, score, predicted) of every document; predicted is 1 from a score of 0.5."""
    sample = training_sample(docs, labels, per_class, max_chars, id_col, text_col)
    net, slope, offset = pickle.loads(in_one_task(sample, lambda some, known: pickle.dumps(fitted(some, known, epochs))))

    def start():
        def run(batch: pa.RecordBatch) -> dict:
            some = texts(batch, text_col)
            if net is None:
                score = np.zeros(len(some))
            else:
                score = 1 / (1 + np.exp(-np.clip(slope * worst_windows(net, some) + offset, -30, 30)))
            return {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}
        return run

    kept = list(dict.fromkeys([*keep, id_col]))
    out = map_batches(docs.select(*dict.fromkeys([*kept, text_col])), kept, start, {"score": pa.float64(), "predicted": pa.int32()})
    return out.select(*keep, held_out(F.col(id_col)).alias("held_out"), "score", "predicted")
