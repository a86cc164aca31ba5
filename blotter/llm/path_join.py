"""MinHash near-duplicates by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with equal sets are
one class; from then on only classes are worked on. Each class has a
signature of minwise tokens (the smallest value of its set under each of
``COORDINATES`` hash functions), and a sketch of four bits of each.

In every tree a class descends from the root along ``BRANCHES`` minwise
tokens that the node chooses: a child is the node's path with the token's
value, so classes meet in a child if they share the token. Two classes of
similarity s share a child with probability 1 - (1-s)^2 or more; ``trees``
independent trees miss a pair at the threshold 0.8 with a probability under
1e-4. Nodes are split until they are small, or tight (at least half of the
members are so near the node's centre that splitting would not part them), or ``max_depth`` is reached; no node is ever dropped.

Candidates in final nodes are compared exhaustively, but never as all pairs
of a group of copies:

1. each class with its best centre among its nodes (at most one candidate
   per class); those confirmed on full sets join classes into components;
2. only members of a node that are in different components are compared
   further: a class asks every larger component that has a member near it in
   a node, and is joined to it if any of its members is similar enough. A
   semi-join on full sets answers that, so no pairs are written out. Where
   many ask a large component, the larger side is dealt over several tasks
   and the smaller one copied to each.

Two members of one component need no comparing, so what a group of n
copies costs is about n. All links are confirmed on full sets.

Defined results: a null text is empty; documents without words have the
empty set and link with nothing; with fewer words than a shingle the whole
sequence is the one shingle; repeated rows are copies; of rows that share a
doc_id but not the text each is judged by its text (but two sets whose
smallest id is the same one are taken as one class); a row with a null
doc_id links with nothing, has a null component and is kept.
Sets hold 64-bit hashes of shingles, classes 128-bit digests of sets.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import likely_in, map_batches, release, remove, texts, write_table
from .components import components
from .words import BASE, U, mix, shingle_sets

COORDINATES = 128
BRANCHES = 2
FIRST_DEPTH = 3
SMALL_NODE = 100
COMPARED = 4_000_000            # pairs of a component's members and those that ask it, in one task
MISSED = 1e-4
# Of the 128 tokens' sketches two sets of similarity s differ in 128 * (1 - s) * 15/16 (``sketch_near``).
# At 0.5, where splitting stops to pay, they differ in 60; a node that is not split loses nothing, whatever the threshold.
SKETCH_TIGHT = 60
SKETCH = [f"s{i}" for i in range(COORDINATES // 16)]
NIBBLES = 0x1111111111111111
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=U) * U(0xD1B54A32D192ED03))
_ODD = mix(_SEEDS) | U(1)


def sketch_near(percent: int) -> int:
    """In how many sketches sets at the threshold may differ and still be compared: the mean and five deviations (46 at 80)."""
    p = (1 - percent / 100) * 15 / 16
    return int(COORDINATES * p + 5 * (COORDINATES * p * (1 - p)) ** 0.5)


def trees_for(percent: int, max_depth: int) -> int:
    """How many trees miss a pair at the threshold with a probability under ``MISSED`` (4 at 80)."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent is {percent}; it must be over 0 and at most 100")
    s, missed = percent / 100, 0.0
    for _ in range(max_depth):
        missed = (1 - s + s * missed) ** BRANCHES
    return max(1, int(np.ceil(np.log(MISSED) / np.log(missed)))) if missed else 1


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens of non-empty sets, one row each (32 bits of every minimum)."""
    out = np.empty((len(sets), COORDINATES), np.uint32)
    if not sets:
        return out
    step = 1 << 16          # elements worked on at once, so they stay in cache
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flat = np.concatenate(sets)
    best = np.full((len(sets), COORDINATES), np.iinfo(np.uint64).max, U)
    with np.errstate(over="ignore"):
        for a in range(0, len(flat), step):
            part = flat[a:a + step]
            lo, hi = np.searchsorted(firsts, a, "right") - 1, np.searchsorted(firsts, a + len(part), "left")
            starts = np.maximum(firsts[lo:hi] - a, 0)
            for c in range(COORDINATES):
                np.minimum(best[lo:hi, c], np.minimum.reduceat((part ^ _SEEDS[c]) * _ODD[c], starts), out=best[lo:hi, c])
    out[:] = best >> U(32)
    return out


def set_table(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id_col, n_shingles, set_id, minwise, *SKETCH) of every row; for an empty set all but two are null."""
    def start():
        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("n_shingles", "set_id", "minwise", *SKETCH)}
            sets = shingle_sets(texts(batch, text_col), width)
            for a in range(0, len(sets), 512):
                some = sets[a:a + 512]
                sig = signatures([s for s in some if len(s)])
                four = (mix(sig) & U(15)).astype(np.uint8)
                sketch = np.ascontiguousarray(four[:, 0::2] | four[:, 1::2] << 4).view("<i8")
                row = iter(range(len(sig)))
                for s in some:
                    out["n_shingles"].append(len(s))
                    k = next(row) if len(s) else None
                    out["set_id"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    out["minwise"].append(sig[k].tobytes() if len(s) else None)
                    for i, c in enumerate(SKETCH):
                        out[c].append(int(sketch[k, i]) if len(s) else None)
            return out
        return run

    return map_batches(docs.select(id_col, text_col), [id_col], start,
                       {"n_shingles": pa.int64(), "set_id": pa.binary(), "minwise": pa.binary(), **dict.fromkeys(SKETCH, pa.int64())})


def _children(nodes: np.ndarray, minwise: np.ndarray) -> np.ndarray:
    """The ``BRANCHES`` children of each node to which a class with this signature goes (one row of either per node)."""
    with np.errstate(over="ignore"):
        cols = []
        first = mix(nodes) % U(COORDINATES)
        for k in range(BRANCHES):
            # Different coordinates, so that a class is in a child once.
            at = ((first + U(k) * (U(1) + mix(~nodes) % U(COORDINATES // BRANCHES - 1))) % U(COORDINATES)).astype(np.int64)
            token = minwise[np.arange(len(nodes)), at]
            cols.append(mix(nodes * BASE + (at.astype(U) << U(32)) + token.astype(U)))
    return np.stack(cols, axis=1)


def _branch(rows: DataFrame, trees: int | None = None, depth: int = 1) -> DataFrame:
    """(path, rep) after ``depth`` more levels, from (path, rep, minwise) or, with ``trees``, from the roots."""
    def run(batches):
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            minwise = np.frombuffer(b"".join(batch.column("minwise").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            if trees:
                nodes = np.tile(mix(np.arange(1, trees + 1, dtype=U)), (len(reps), 1))
            else:
                nodes = batch.column("path").to_numpy().view(U).reshape(-1, 1)
            for _ in range(depth):
                wide = nodes.shape[1]
                nodes = _children(nodes.ravel(), np.repeat(minwise, wide, axis=0)).reshape(len(reps), -1)
            yield pa.RecordBatch.from_arrays([pa.array(nodes.ravel().view(np.int64)), pa.array(np.repeat(reps, nodes.shape[1]))], names=["path", "rep"])

    return rows.mapInArrow(run, "path bigint, rep bigint")


def _differing(a: str, b: str) -> Column:
    """Number of tokens whose sketches differ."""
    def each(c: str) -> Column:
        x = F.col(a + c).bitwiseXOR(F.col(b + c))
        for by in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, by))
        return F.bit_count(x.bitwiseAND(F.lit(NIBBLES)))

    return reduce(Column.__add__, [each(c) for c in SKETCH])


def _close(a: str, b: str, percent: int) -> Column:
    """Not excluded by set sizes or sketches."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (_differing(a, b) <= sketch_near(percent))


def _similar(a: str, b: str, percent: int) -> Column:
    """Whether two full sets, as arrays, are similar enough."""
    common = F.size(F.array_intersect(a, b))
    return common * 100 >= (F.size(a) + F.size(b) - common) * percent


def _named(df: DataFrame, prefix: str, *cols: str) -> DataFrame:
    return df.select("path", *[F.col(c).alias(prefix + c) for c in cols])


class _Join:
    """One run: classes, its final nodes, and what is confirmed so far.

    ``signed`` has the classes with their signatures and is written at
    ``signed_at``, which is deleted once the nodes are known.
    """

    def __init__(self, docs: DataFrame, classes: DataFrame, signed: DataFrame, signed_at: str, width: int, percent: int, trees: int, max_depth: int,
                 id_col: str, text_col: str):
        self.spark: SparkSession = docs.sparkSession
        self.docs, self.classes, self.signed = docs, classes, signed
        self.width, self.percent, self.trees, self.max_depth = width, percent, trees, max_depth
        self.id_col, self.text_col = id_col, text_col
        self.made = [signed_at]
        self._sets: DataFrame | None = None

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df, at = write_table(df, f"near-{name}")
        self.made.append(at)
        return df

    def nodes(self) -> DataFrame:
        """(path, rep, *SKETCH, n, centre) of the members of all final nodes that have two or more."""
        signed = self.signed.select("rep", "minwise", *SKETCH, "n")
        frontier = _branch(signed.select("rep", "minwise"), self.trees, FIRST_DEPTH)
        final: list[DataFrame] = []
        for depth in range(FIRST_DEPTH, self.max_depth + 1):
            # Dealt by path once, for the sizes and for the join with them: the join's own filters (nothing is null) would make a second shuffle.
            frontier = frontier.filter("path is not null and rep is not null").repartition("path")
            pick = F.xxhash64("path", "rep")
            sizes = frontier.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min(pick).alias("centre")).filter("size > 1")
            live = self.keep(frontier.join(sizes, "path").withColumn("centre", pick == F.col("centre"))
                             .join(signed.select("rep", *SKETCH, "n"), "rep"), "nodes")
            if depth == self.max_depth:
                final.append(live)
                break
            # A node is split if it is large and most members are not near its centre.
            big = live.filter(F.col("size") > SMALL_NODE)
            near = F.when(_differing("", "c_") <= SKETCH_TIGHT, 1.0).otherwise(0.0)
            loose = self.keep(big.join(_named(big.filter("centre"), "c_", *SKETCH), "path")
                              .groupBy("path").agg(F.avg(near).alias("near")).filter("near < 0.5").select("path"), "loose")
            if loose.isEmpty():
                final.append(live)
                break
            final.append(live.join(loose, "path", "left_anti"))
            parted = live.join(loose, "path", "left_semi").select("path", "rep")
            if depth == FIRST_DEPTH:
                # The classes that any deeper node can have.
                signed = self.keep(likely_in(signed, "rep", parted.select("rep")), "parted")
            frontier = _branch(parted.join(signed.select("rep", "minwise"), "rep"))
            release(self.spark)
        out = final[0]
        for f in final[1:]:
            out = out.unionByName(f)
        return out.select("path", "rep", *SKETCH, "n", "centre")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(rep, items) of the classes that share a node with another: their full sets, made anew from the texts."""
        if self._sets is None:
            release(self.spark)
            wanted = nodes.select(F.col("rep").alias(self.id_col)).distinct()
            # An inner join: a semi-join would be pushed below the filter, and every text shuffled.
            some = likely_in(self.docs.select(self.id_col, self.text_col), self.id_col, wanted).join(wanted, self.id_col)
            width, text_col = self.width, self.text_col

            def start():
                def run(batch: pa.RecordBatch) -> dict:
                    return {"items": [s.view(np.int64) for s in shingle_sets(texts(batch, text_col), width)]}
                return run
            self._sets = self.keep(map_batches(some, [self.id_col], start, {"items": pa.list_(pa.int64())})
                                   .withColumnRenamed(self.id_col, "rep"), "sets")
        return self._sets

    def confirmed(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) whose full sets are similar enough."""
        sets = likely_in(self.sets(nodes), "rep", pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))))
        left = sets.select(F.col("rep").alias("a"), F.col("items").alias("ia"))
        right = sets.select(F.col("rep").alias("b"), F.col("items").alias("ib"))
        return (pairs.select("a", "b").join(right, "b").join(left, "a")
                .filter(_similar("ia", "ib", self.percent)).select("a", "b").distinct())

    def components(self) -> DataFrame:
        """(node, component) of the classes that are linked to another, and of some that are not; the component is its smallest class."""
        nodes = self.keep(self.nodes(), "final")
        release(self.spark)
        # No later step reads signatures or the nodes on the way.
        remove(self.spark, *self.made[:-1])
        del self.made[:-1]
        # 1. Each class and the best centre among its nodes.
        star = (nodes.filter(~F.col("centre")).join(_named(nodes.filter("centre"), "c_", "rep", *SKETCH, "n"), "path")
                .filter(_close("", "c_", self.percent)).groupBy(F.col("rep").alias("a"))
                .agg(F.min(F.struct(_differing("", "c_").alias("d"), F.col("c_rep").alias("b"))).alias("best"))
                .select("a", "best.b"))
        links = self.keep(self.confirmed(self.keep(star, "best"), nodes), "star")
        comps, comps_at = components(links)
        self.made.append(comps_at)

        # 2. Classes in a node with a class of another component, and that component; asked from the smaller's side.
        size = comps.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        sketched = likely_in(self.classes.select("rep", *SKETCH, "n"), "rep", nodes.select("rep"))
        member = self.keep(sketched.join(comps.join(size, "component").withColumnRenamed("node", "rep"), "rep", "left")
                           .select("rep", *SKETCH, "n", F.coalesce("component", "rep").alias("comp"), F.coalesce("size", F.lit(1)).alias("size")), "members")
        where = nodes.select("path", "rep").join(member.select("rep", "comp"), "rep")
        mixed = where.groupBy("path").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("path")
        # A class is in a bounded number of nodes; two that share several are paired in the first of them only.
        paths = where.join(mixed, "path").groupBy("rep").agg(F.collect_list("path").alias("paths"))
        placed = self.keep(member.join(paths, "rep").withColumn("path", F.explode("paths")), "mixed")
        release(self.spark)
        smaller = (F.col("size") < F.col("o_size")) | ((F.col("size") == F.col("o_size")) & (F.col("comp") < F.col("o_comp")))
        single = _named(placed.filter("size = 1"), "o_", *SKETCH, "n", "comp", "size", "paths")
        once = F.array_min(F.array_intersect("paths", "o_paths")) == F.col("path")
        group = placed.filter("size > 1").drop("paths")
        # A component's members in a node lie in a ball about one of them: those whose distance to that one is too large are near none.
        middle = (group.groupBy("path", "comp", "size").agg(F.min(F.struct("rep", *SKETCH)).alias("m"), F.min("n").alias("lo"), F.max("n").alias("hi"))
                  .select("path", "comp", "size", "m.*", "lo", "hi"))
        reach = (group.join(_named(middle, "c_", "comp", *SKETCH), ["path"]).filter(F.col("comp") == F.col("c_comp"))
                 .groupBy("path", "comp").agg(F.max(_differing("", "c_")).alias("reach")))
        groups = _named(middle.join(reach, ["path", "comp"]), "o_", "comp", "size", *SKETCH, "lo", "hi", "reach")
        in_reach = ((F.col("n") * 100 >= F.col("o_lo") * self.percent) & (F.col("o_hi") * 100 >= F.col("n") * self.percent)
                    & (_differing("", "o_") <= sketch_near(self.percent) + F.col("o_reach")))
        asked = (placed.join(single, "path").filter(smaller & _close("", "o_", self.percent) & once).select("rep", "o_comp", "o_size")
                 .unionByName(
                     placed.drop("paths").join(groups, "path").filter(smaller & in_reach)
                     .join(group.select(F.col("path").alias("at"), *[F.col(c).alias("m_" + c) for c in ("comp", *SKETCH, "n")]),
                           (F.col("path") == F.col("at")) & (F.col("o_comp") == F.col("m_comp")) & _close("", "m_", self.percent), "left_semi")
                     .select("rep", "o_comp", "o_size"))
                 .distinct())
        asked = self.keep(asked, "asked")
        # A link to any member joins the two; the sets are compared within the join, so no pairs are made.
        cells = F.ceil(F.count(F.lit(1)) * F.col("o_size") / COMPARED).cast("int")
        dealt = (asked.groupBy("o_comp", "o_size").agg(cells.alias("cells"), (F.count(F.lit(1)) <= F.col("o_size")).alias("by_member"))
                 .select(F.col("o_comp").alias("of"), "cells", "by_member"))

        of_asked = member.join(dealt.select("of"), F.col("comp") == F.col("of"), "left_semi").select("rep")
        release(self.spark)
        sets = likely_in(self.sets(nodes), "rep", asked.select("rep").unionByName(of_asked))

        def cell(split: Column, key: str) -> Column:
            """The cells of a row: one by its hash, if its side is split, else all."""
            every = F.sequence(F.lit(0), F.col("cells") - 1)
            return F.explode(F.when(split, F.array(F.pmod(F.xxhash64(key), F.col("cells")).cast("int"))).otherwise(every))

        x = (asked.join(dealt, F.col("o_comp") == F.col("of")).select("rep", "o_comp", cell(~F.col("by_member"), "rep").alias("cell"))
             .join(member.select("rep", *SKETCH, "n"), "rep").join(sets, "rep"))
        y = (member.select(F.col("rep").alias("m_rep"), "comp", *[F.col(c).alias("m_" + c) for c in (*SKETCH, "n")])
             .join(dealt, F.col("comp") == F.col("of"))
             .join(sets.select(F.col("rep").alias("m_rep"), F.col("items").alias("m_items")), "m_rep")
             .select("comp", *["m_" + c for c in (*SKETCH, "n", "items")], cell(F.col("by_member"), "m_rep").alias("m_cell")))
        more = self.keep(x.join(y, (F.col("o_comp") == F.col("comp")) & (F.col("cell") == F.col("m_cell")) & _close("", "m_", self.percent)
                                & _similar("items", "m_items", self.percent), "left_semi")
                         .select(F.col("rep").alias("a"), F.col("o_comp").alias("b")).distinct(), "more")
        if more.isEmpty():
            return comps
        # Only these links join components, so no link within one is followed again.
        merged, merged_at = components(more.join(member.select(F.col("rep").alias("a"), "comp"), "a").select(F.col("comp").alias("a"), "b").distinct())
        self.made.append(merged_at)
        # Classes may share an id (rows that repeat one with another text).
        return (member.select(F.col("rep").alias("node"), "comp").distinct().join(merged.withColumnRenamed("node", "comp"), "comp", "left")
                .select("node", F.coalesce("component", "comp").alias("component")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, trees: int | None = None, max_depth: int = 10,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) of every row: its set's size, the smallest id of its component.

    ``trees`` is as many as ``percent`` needs, if not given.
    """
    trees = trees or trees_for(percent, max_depth)
    every, wide_at = write_table(set_table(docs, width, id_col, text_col), "near-docs")
    whole = every.filter(F.col("set_id").isNotNull() & F.col(id_col).isNotNull())
    # One class per distinct set; copies collapse in the map-side part of this aggregation.
    signed, signed_at = write_table(whole.groupBy("set_id").agg(F.min(F.struct(
        F.col(id_col).cast("bigint").alias("rep"), "minwise", *SKETCH, F.col("n_shingles").alias("n"))).alias("c"))
        .select("set_id", "c.*"), "near-signed")
    # Signatures are most of both tables; what is read to the end is written without them.
    every, every_at = write_table(every.drop("minwise", *SKETCH), "near-rows")
    classes, classes_at = write_table(signed.drop("minwise"), "near-classes")
    remove(docs.sparkSession, wide_at)
    release(docs.sparkSession)
    run = _Join(docs, classes.drop("set_id"), signed, signed_at, width, percent, trees, max_depth, id_col, text_col)
    comps = run.components()
    named = (classes.select("set_id", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .select("set_id", F.coalesce("component", "rep").alias("component")))
    # Few distinct sets hold many rows each, at most: a join that may split the rows of one.
    out = (every.join(named, "set_id", "left")
           .select(id_col, "n_shingles", F.when(F.col(id_col).isNotNull(), F.coalesce("component", F.col(id_col).cast("bigint"))).alias("component_id")))
    out, _ = write_table(out.withColumn("kept", F.col(id_col).cast("bigint").eqNullSafe(F.col("component_id"))), "near-result")
    remove(docs.sparkSession, every_at, classes_at, *run.made)
    del every, whole, signed, classes, run, comps, named
    release(docs.sparkSession)
    return out
