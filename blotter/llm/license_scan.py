"""License scans by diagonal voting.

Every text's rolling 3-word hashes are joined with the positions that the
same hashes have in the templates. A match at word ``p`` of a text and ``t``
of a template votes for the diagonal ``p - t``. Votes are summed per
diagonal; neighbouring diagonals, which an inserted or lost word shifts
apart, are merged; what has enough votes is a window of the text that is
then verified on the words themselves.

Base phrases are verified as equal, at every place. Notices are verified by
likeness: 2 * LCS / (words of the notice + words of the span), at least
``LIKE`` (0.9). Of qualifying spans that overlap, the likest stays (ties: the
longer notice, then the first place, then the first notice), so a notice
that is another one with a word more isn't taken for it. The vote threshold
and the drift that merges diagonals follow from ``LIKE`` and lose nothing:
a span as like has at most ``DRIFT`` * m words inserted or lost, each of
which breaks at most 3 of the m - 2 hashes of a notice of m words.

The template table is a constant of this module, so it may be broadcast. A
text's hashes leave the worker in rows of at most ``BLOCK`` words. Windows
are joined back to the texts they lie in: broadcast after a check of their
bytes, else by a shuffle.

Defined results: a null text is empty; a text without words has n_words 0,
no places, empty labels and score 0; rows that repeat an id and its text get
a row each, as do rows without id; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import checked_broadcast
from .common import map_batches, texts, write_table
from .license_templates import BASE_PHRASES, NOTICES
from .words import BASE, FOLD, U, mix, parts, prefix_sums, span_hashes

GRAM = 3
LIKE = 0.9
DRIFT = 2 * (1 - LIKE) / LIKE
BLOCK = 8192
MAX_BROADCAST_BYTES = 16 << 20
# A word's bytes are 0-9, A-Z, a-z, and those of code points from U+0080 on.
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Words:
    """The words of one text: their number, hashes, and the words of any stretch."""

    def __init__(self, text: str):
        self._parts = []
        hashes, count = [], 0
        for data, _ in parts([text]):
            folded = FOLD[data]
            inside = IN_WORD[data]
            edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            edge = np.concatenate([[0], edge]) if len(data) and inside[0] else edge
            starts, ends = edge[0::2], edge[1::2]
            hashes.append(span_hashes(prefix_sums(folded), starts, ends))
            self._parts.append((count, folded, starts, ends))
            count += len(starts)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, U)

    def __len__(self) -> int:
        return len(self.hashes)

    def grams(self) -> np.ndarray:
        out = np.full(max(0, len(self) - GRAM + 1), U(GRAM))
        with np.errstate(over="ignore"):
            for k in range(GRAM):
                out = mix(out * BASE + self.hashes[k:k + len(out)])
        return out.view(np.int64)

    def between(self, lo: int, hi: int) -> list[bytes]:
        out = []
        for first, folded, starts, ends in self._parts:
            a, b = max(lo - first, 0), min(hi - first, len(starts))
            out += [folded[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])] if a < b else []
        return out


class Template:
    """A phrase or notice with what verifying it needs."""

    def __init__(self, label: str, wording: str, base: bool):
        self.label, self.base = label, base
        words = Words(wording)
        self.words = words.between(0, len(words))
        self.grams = words.grams()
        m = len(self.words)
        self.drift = 0 if base else int(np.ceil(DRIFT * m))
        self.votes = len(self.grams) if base else max(1, m - GRAM + 1 - GRAM * self.drift)
        self.longest = m if base else int(m * (2 / LIKE - 1) + 1e-9)
        self.masks: dict[bytes, int] = {}
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def likest_end(self, words: list[bytes], at: int) -> tuple[float, int]:
        """The greatest likeness of a span that starts at ``at``, and its end (the first, if several)."""
        m, masks = len(self.words), self.masks
        full = state = (1 << m) - 1
        best, end = 0.0, at
        for b in range(at, min(at + self.longest, len(words))):
            mask = masks.get(words[b])
            if mask is None:
                continue
            # Bits that are 0 count the longest common subsequence so far.
            both = state & mask
            state = ((state + both) | (state - both)) & full
            like = 2 * (m - state.bit_count()) / (m + b + 1 - at)
            if like > best:
                best, end = like, b + 1
        return best, end


@lru_cache(maxsize=1)
def templates() -> tuple[Template, ...]:
    made = tuple(Template(label, wording, base) for base, group in ((True, BASE_PHRASES), (False, NOTICES)) for label, wording in group)
    assert all(len(t.words) >= GRAM for t in made)
    return made


def template_positions(spark: SparkSession) -> DataFrame:
    """(gram, template, at): where each template has each hash."""
    rows = [(int(g), i, at) for i, t in enumerate(templates()) for at, g in enumerate(t.grams)]
    return spark.createDataFrame(rows, "gram bigint, template int, at bigint")


def _gram_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "digest", "n_words", "first", "grams"]

    def packed(rows, like):
        ids, digests, counts, firsts, grams = zip(*rows)
        lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, grams)]).astype(np.int32), np.concatenate(grams))
        return pa.RecordBatch.from_arrays([pa.array(ids, like), pa.array(digests, pa.string()), pa.array(counts, pa.int64()),
                                           pa.array(firsts, pa.int64()), lists], names=names)

    for batch in batches:
        rows, held = [], 0
        kind = batch.schema.field("id").type
        for i, digest, text in zip(batch.column("id").to_pylist(), batch.column("digest").to_pylist(), texts(batch, "text")):
            words = Words(text)
            # One row a text that is there whatever matches.
            rows.append((i, digest, len(words), -1, np.zeros(1, np.int64)))
            grams = words.grams()
            for first in range(0, len(grams), BLOCK):
                rows.append((i, digest, len(words), first, grams[first:first + BLOCK]))
                held += BLOCK
                if held > 64 * BLOCK:
                    yield packed(rows, kind)
                    rows, held = [], 0
        if rows:
            yield packed(rows, kind)


def votes(docs: DataFrame) -> DataFrame:
    """(id, digest, n_words, template, diagonal, n) of ``docs`` (id, digest, text): n hashes match on a diagonal.

    One row more per distinct id and text has no template; its n is the number of rows that repeat them.
    """
    schema = T.StructType([docs.schema["id"], docs.schema["digest"], T.StructField("n_words", T.LongType()),
                           T.StructField("first", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType()))])
    blocks = docs.select("id", "digest", "text").mapInArrow(_gram_blocks, schema)
    grams = blocks.select("id", "digest", "n_words", "first", F.posexplode("grams").alias("k", "gram"))
    hits = (grams.join(F.broadcast(template_positions(docs.sparkSession)), "gram", "left")
                 .filter("first < 0 OR template IS NOT NULL"))
    real = F.col("first") >= 0
    return (hits.select("id", "digest", "n_words", F.when(real, F.col("template")).alias("template"),
                        F.when(real, F.col("first") + F.col("k") - F.col("at")).alias("diagonal"))
                .groupBy("id", "digest", "n_words", "template", "diagonal").agg(F.count(F.lit(1)).alias("n")))


def windows(marks: DataFrame) -> DataFrame:
    """(id, digest, windows) of texts with neighbouring diagonals whose votes suffice: arrays of (template, lo, hi)."""
    spark = marks.sparkSession
    facts = spark.createDataFrame([(i, len(t.words), t.drift, t.votes) for i, t in enumerate(templates())],
                                  "template int, size int, drift int, needed int")
    each = marks.filter("template IS NOT NULL").join(F.broadcast(facts), "template")
    key = ["id", "digest", "template"]
    # One text's diagonals of one template: no more than it has words.
    each = each.selectExpr("*", "lag(diagonal) OVER (PARTITION BY id, digest, template ORDER BY diagonal) AS before")
    each = each.selectExpr("*", "sum(CASE WHEN before >= diagonal - drift AND drift > 0 THEN 0 ELSE 1 END) "
                                "OVER (PARTITION BY id, digest, template ORDER BY diagonal) AS island")
    merged = (each.groupBy(*key, "island", "size", "drift", "needed")
                  .agg(F.min("diagonal").alias("lo"), F.max("diagonal").alias("hi"), F.sum("n").alias("n")).filter("n >= needed"))
    # A first word of the template may be lost and words put in: spans begin and end within the drift.
    span = F.struct("template", F.greatest(F.lit(0), F.col("lo") - F.col("drift")).alias("lo"), (F.col("hi") + F.col("size") + F.col("drift")).alias("hi"))
    return merged.groupBy("id", "digest").agg(F.collect_list(span).alias("windows"))


def verify(words: Words, spots: list[dict]) -> tuple[list[tuple[int, str]], list[tuple[float, int, int, str]]]:
    """(start, label) of all base places in the windows, and (likeness, start, end, label) of the notices that stay."""
    places, spans = set(), {}
    for spot in spots:
        t = templates()[spot["template"]]
        lo, stretch = spot["lo"], words.between(spot["lo"], spot["hi"])
        if t.base:
            if stretch == t.words:
                places.add((lo, t.label))
            continue
        for at, word in enumerate(stretch):
            if word in t.masks:
                like, end = t.likest_end(stretch, at)
                if like >= LIKE:
                    # A window's end may cut a span short; the likest of all windows counts.
                    k = (spot["template"], lo + at)
                    spans[k] = max(spans.get(k, (0.0, 0)), (like, -(lo + end)))
    stay: list[tuple[float, int, int, str]] = []
    for (i, start), (like, minus_end) in sorted(spans.items(), key=lambda x: (-x[1][0], -len(templates()[x[0][0]].words), x[0][1], x[0][0])):
        if all(start >= e or -minus_end <= s for _, s, e, _ in stay):
            stay.append((like, start, -minus_end, templates()[i].label))
    return sorted(places), stay


def _verified() -> "callable":
    def each(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in VERIFIED}
        for text, spots in zip(texts(batch, "text"), batch.column("windows").to_pylist()):
            places, spans = verify(Words(text), spots)
            base = sorted({label for _, label in places})
            out["n_base"].append(len(places))
            out["first_word"].append(places[0][0] if places else None)
            out["last_word"].append(places[-1][0] if places else None)
            out["base_labels"].append(",".join(base))
            out["labels"].append(",".join(sorted({*base, *(s[3] for s in spans)})))
            out["score"].append(1.0 if places else max([s[0] for s in spans], default=0.0))
            out["spans"].append([{"label": label, "first": a, "end": b, "like": like} for like, a, b, label in sorted(spans, key=lambda s: s[1])])
        return out

    return each


VERIFIED = {"n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(),
            "score": pa.float64(), "spans": pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("like", pa.float64())]))}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row of ``docs``.

    ``spans`` lists the notices that stay: label, first word, end and likeness.
    """
    own = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), F.col(text_col).alias("text"))
    marks, _ = write_table(votes(own), "license-marks")
    found, _ = write_table(windows(marks), "license-windows")
    small = checked_broadcast(found, max_bytes)
    spots = (small if small is not None else found).select(F.col("id").alias("found_id"), F.col("digest").alias("found_digest"), "windows")
    inside = own.join(spots, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("digest") == F.col("found_digest")))
    # Rows that repeat an id and its text have the same result: one is enough.
    checked = map_batches(inside.select("id", "digest", "text", "windows"), ["id", "digest"], _verified, VERIFIED).dropDuplicates(["id", "digest"])
    checked = checked.select(F.col("id").alias("found_id"), F.col("digest").alias("found_digest"), *VERIFIED)
    rows = marks.filter("template IS NULL").select("id", "digest", "n_words", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    out = rows.join(checked, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("digest") == F.col("found_digest")), "left")
    empty = F.lit("")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", empty).alias("base_labels"), F.coalesce("labels", empty).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"), "spans")
