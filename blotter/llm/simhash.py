"""Document fingerprints: SimHash, and all fingerprints within a Hamming radius.

A text's terms are its pairs of neighbouring words, each weighted by its
length (long pairs are rare ones). Every term's hash votes with its weight
on each bit; a bit of the fingerprint is set if the votes for it outweigh
those against. Votes are summed two bits to a long (32 bits each, which no
string can overflow), by one grouped aggregation of the exploded terms.

``within_radius`` finds all fingerprints within a radius by permuted block
tables: the bits are cut into blocks, and for each choice of ``exact``
blocks there is a table keyed by them. With ``radius + exact`` blocks, two
fingerprints within the radius agree in at least ``exact`` whole blocks, so
some table brings them together; the distance is then checked. A pair that
several tables bring together is taken from the first of them, so pairs need
no shuffle to be told apart. Equal fingerprints are one entry, so groups of
copies cost one lookup. ``near_counts`` sums the search up by fingerprint.

DataFrame functions only: no Python runs on the executors.

Defined results: a null text is empty; a text without a pair of words is
one term, its whole; a text without words has the fingerprint of all zero
bits; equal texts have equal fingerprints; repeated rows are fingerprinted
each; rows with a null id come first in the order of documents, rows that
share an id are ordered by text.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

BITS = 128
LANES = 0x0000000100000001          # two votes in one long
LOW = 0xFFFFFFFF
BUCKETS_PER_PARTITION = 4
RADIUS = 4                          # likeness 0.995 and more; 15 tables with keys of 42 bits and more


# --- fingerprints ----------------------------------------------------------

def terms(text: Column) -> Column:
    """Pairs of neighbouring words: those from the first word on, then those from the second on."""
    pairs = F.concat(F.regexp_extract_all(text, F.lit(r"\S+\s+\S+"), F.lit(0)),
                     F.regexp_extract_all(F.regexp_replace(text, r"^\s*\S+", ""), F.lit(r"\S+\s+\S+"), F.lit(0)))
    return F.when(F.size(pairs) > 0, pairs).otherwise(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)))


def _votes(term: Column) -> list[Column]:
    """Per 32 pairs of bits of the two hashes: the weighted votes, two to a long."""
    sums = []
    for half in range(BITS // 64):
        h = F.xxhash64(term) if half == 0 else F.xxhash64(term, F.lit(half))
        sums += [F.sum(F.shiftright(h, i).bitwiseAND(F.lit(LANES)) * F.length(term)).alias(f"v{half}_{i}") for i in range(32)]
    return [*sums, F.sum(F.length(term).cast("bigint")).alias("weight")]


def _word(half: int) -> Column:
    """64 bits of the fingerprint from the summed votes."""
    def bit(votes: Column, at: int) -> Column:
        return F.when(votes * 2 > F.col("weight"), F.shiftleft(F.lit(1).cast("bigint"), at)).otherwise(F.lit(0).cast("bigint"))

    out = F.lit(0).cast("bigint")
    for i in range(32):
        v = F.col(f"v{half}_{i}")
        out = out.bitwiseOR(bit(v.bitwiseAND(F.lit(LOW)), i)).bitwiseOR(bit(F.shiftrightunsigned(v, 32), i + 32))
    return out


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys..., f0, f1): the fingerprint of each row's text, as two longs. ``keys`` tell rows apart."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    voted = (texts.select(*keys, F.explode_outer(terms(t)).alias("term"))
                  .groupBy(*keys).agg(*_votes(F.col("term"))))
    return voted.select(*keys, *[F.coalesce(_word(h), F.lit(0).cast("bigint")).alias(f"f{h}") for h in range(BITS // 64)])


def as_hex(f0: Column, f1: Column) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(f)), 16, "0") for f in (f1, f0)])


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Number of differing bits."""
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(d: Column) -> Column:
    """The cosine of term weights that this distance estimates, not below 0; 1 for equal fingerprints."""
    return F.when(d == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.cos(F.lit(3.141592653589793) * d / BITS)))


# --- permuted block tables --------------------------------------------------

def _blocks(n: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of ``n`` blocks; none crosses the two longs."""
    per = n // 2
    cuts = [round(64 * i / per) for i in range(per + 1)]
    return [(64 * half + a, b - a) for half in range(2) for a, b in zip(cuts, cuts[1:])]


def _tables(radius: int, exact: int) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """The blocks, and the numbers of those that each table is keyed by."""
    n = radius + exact
    n += n % 2
    return _blocks(n), list(combinations(range(n), exact + (n - radius - exact)))


def _part(words: tuple[Column, Column], first: int, bits: int) -> Column:
    word = F.shiftrightunsigned(words[first // 64], first % 64)
    return word if bits == 64 else word.bitwiseAND(F.lit((1 << bits) - 1))


def _first_table(a: tuple[Column, Column], b: tuple[Column, Column], table: Column, radius: int, exact: int) -> Column:
    """Whether ``table`` is the first that brings two fingerprints together.

    It is if, of the blocks up to its last one, the two agree in its own only.
    """
    blocks, chosen = _tables(radius, exact)
    other = (a[0].bitwiseXOR(b[0]), a[1].bitwiseXOR(b[1]))
    agree = reduce(Column.bitwiseOR, [F.when(_part(other, *block) == 0, 1 << i).otherwise(0) for i, block in enumerate(blocks)])
    of_table = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), table + 1)
    return agree.bitwiseAND(of_table([(2 << max(c)) - 1 for c in chosen])) == of_table([sum(1 << i for i in c) for c in chosen])


def block_tables(prints: DataFrame, radius: int, exact: int = 2) -> DataFrame:
    """(f0, f1, table, key): every fingerprint once in each table."""
    blocks, chosen = _tables(radius, exact)
    words = (F.col("f0"), F.col("f1"))
    entries = [F.struct(F.lit(t).alias("table"), F.xxhash64(*[_part(words, *blocks[i]) for i in numbers]).alias("key"))
               for t, numbers in enumerate(chosen)]
    return prints.select("f0", "f1", F.explode(F.array(*entries)).alias("e")).select("f0", "f1", "e.table", "e.key")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int, exact: int = 2) -> DataFrame:
    """(q0, q1, f0, f1, distance): for every distinct query all distinct fingerprints within ``radius``.

    Both frames have f0 and f1. The query's own fingerprint is among them if ``prints`` has it.
    """
    q = block_tables(queries.select("f0", "f1").distinct(), radius, exact)
    q = q.select(F.col("f0").alias("q0"), F.col("f1").alias("q1"), F.col("table").alias("qt"), F.col("key").alias("qk"))
    p = block_tables(prints.select("f0", "f1").distinct(), radius, exact)
    of_query, of_print = (F.col("q0"), F.col("q1")), (F.col("f0"), F.col("f1"))
    near = distance(of_query, of_print)
    return (q.join(p, (F.col("qt") == F.col("table")) & (F.col("qk") == F.col("key")) & (near <= radius)
                   & _first_table(of_query, of_print, F.col("table"), radius, exact))
             .select("q0", "q1", "f0", "f1", near.cast("int").alias("distance")))


def near_counts(prints: DataFrame, radius: int = RADIUS, exact: int = 2) -> DataFrame:
    """(f0, f1, near_prints, nearest) of every distinct fingerprint.

    ``near_prints`` is the number of other distinct fingerprints within
    ``radius``, ``nearest`` the distance of the nearest (null if there is none).
    """
    return (within_radius(prints, prints, radius, exact).groupBy(F.col("q0").alias("f0"), F.col("q1").alias("f1"))
            .agg((F.count(F.lit(1)) - 1).alias("near_prints"), F.min(F.when(F.col("distance") > 0, F.col("distance"))).alias("nearest")))


# --- the next document, and edited texts -------------------------------------

def _bucket(i: Column, splits: list[int]) -> Column:
    """How many of the sorted ``splits`` are at most ``i``; looked up in two steps of about sqrt(n)."""
    if not splits:
        return F.lit(0)
    step = max(1, int(len(splits) ** 0.5))
    at_most = lambda a: F.size(F.filter(a, lambda s: s <= i))
    longs = lambda v: F.lit(v).cast("array<bigint>")
    full = at_most(longs(splits[step - 1::step])) * step
    return full + at_most(F.slice(longs(splits), full + 1, F.lit(step)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, row, id, text, ghost, next_text): every document and the text of the next by ascending id.

    After the last comes the first. Documents are dealt into buckets of
    neighbouring ids, whose bounds are quantiles of the ids; the first
    document of a bucket is also dealt, as a ghost, to the end of the bucket
    before. So one shuffle brings each text next to its successor, and no
    task sees more than its bucket. Rows come out dealt by bucket; ``row``
    orders them and tells them apart. Ghosts have no next text.
    """
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * shuffle_partitions(spark)
    i = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-2 ** 63).cast("bigint"))
    quantiles = docs.select(i.cast("double").alias("i")).approxQuantile("i", [k / buckets for k in range(1, buckets)], 0.1 / buckets)
    splits = sorted({int(q) for q in quantiles if abs(q) < 2 ** 63})
    d = docs.select(F.col(id_col).alias("id"), i.alias("i"), F.coalesce(text_col, F.lit("")).alias("text"))
    d = d.withColumn("own", _bucket(F.col("i"), splits))
    # One row per bucket, at most ``buckets``: the smallest id, and the bucket before (the last, for the first).
    firsts = sorted((r["own"], r["first"]) for r in d.groupBy("own").agg(F.min("i").alias("first")).collect())
    before = [(first, firsts[k - 1][0], int(k == 0)) for k, (_, first) in enumerate(firsts)]
    ghosts = spark.createDataFrame(before, "first bigint, before int, wrap int")
    place = lambda bucket, ghost, wrap: F.struct(bucket.cast("int").alias("bucket"), F.lit(ghost).alias("ghost"), wrap.alias("wrap"))
    own = place(F.col("own"), 0, F.lit(0))
    placed = (d.join(F.broadcast(ghosts), F.col("i") == F.col("first"), "left")
               .select("id", "i", "text", F.explode(F.when(F.col("first").isNull(), F.array(own))
                       .otherwise(F.array(own, place(F.col("before"), 1, F.col("wrap"))))).alias("p"))
               .select("id", "i", "text", "p.*"))
    order = Window.partitionBy("bucket").orderBy("ghost", "wrap", "i", "text")
    return (placed.withColumn("next_text", F.lead("text").over(order)).withColumn("row", F.row_number().over(order))
                  .select("bucket", "row", "id", "text", "ghost",
                          F.when(F.col("ghost") == 0, F.col("next_text")).alias("next_text")))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last quarter replaced by as much of the start of ``next_text``."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(next_text, F.lit(1), quarter))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, edited_sha256, f0, f1, e0, e1, near_edited, near_next) of every document.

    f is the fingerprint of the text, e that of its edited text (``edited``).
    """
    d = (with_next(docs, id_col, text_col)
         .withColumn("edited", edited(F.col("text"), F.col("next_text")))
         .select("bucket", "row", "id", "ghost", F.length("text").cast("bigint").alias("n_chars"),
                 F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                 F.posexplode(F.when(F.col("ghost") == 0, F.array("text", "edited")).otherwise(F.array("text"))).alias("which", "text")))
    # All of this happens where the bucket lies: the shuffle by bucket serves the aggregations and windows too.
    f = fingerprints(d, ["bucket", "row", "id", "ghost", "n_chars", "edited_sha256", "which"])
    pick = lambda which, c: F.max(F.when(F.col("which") == which, F.col(c)))
    rows = (f.groupBy("bucket", "row", "id", "ghost", "n_chars", "edited_sha256")
             .agg(pick(0, "f0").alias("f0"), pick(0, "f1").alias("f1"), pick(1, "f0").alias("e0"), pick(1, "f1").alias("e1")))
    order = Window.partitionBy("bucket").orderBy("row")
    rows = rows.withColumns({"n0": F.lead("f0").over(order), "n1": F.lead("f1").over(order)}).filter("ghost = 0")
    own, after, changed = [(F.col(a), F.col(b)) for a, b in (("f0", "f1"), ("n0", "n1"), ("e0", "e1"))]
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "f0", "f1", "e0", "e1",
                       likeness(distance(own, changed)).alias("near_edited"), likeness(distance(own, after)).alias("near_next"))
