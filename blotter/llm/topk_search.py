"""Exact top-k search by inner product, block at a time.

Each component of a vector is quantised to an integer ``floor(scale * x)``.
Vectors are cut, in id order, into blocks of a fixed number of rows; a
block is stored as its forward index (ids and component matrix) with the
largest and smallest value of each component. For a query the sum over
components of the larger of ``q * max`` and ``q * min`` bounds every score
in the block. A query visits blocks in falling order of that bound, scores
each through its forward index, and stops as soon as the next bound is
below the k-th score found so far (an equal bound is still visited: it may
hold an equal score with a smaller id). Results are therefore exact.

In parallel: blocks are dealt into bundles of about ``blocks_per_bundle``
and queries into batches of ``queries_per_batch``. Every batch meets every
bundle in one group of that bounded size (queries against all rows, in
blocks), in two rounds: first each batch meets one bundle, which sets a
floor under each query's k-th score; then it meets all of them and skips
the blocks whose bound lies below. No group grows with the data.

Defined results: vectors that are null or hold a null or non-finite
component take no part, as queries or candidates; a shorter vector counts
as zero in the components it lacks, an empty one in all; ties go to the smaller
id; rows that repeat an id are candidates each (a query skips all rows
with its own id and is answered once per row); rows with a null id take
no part. Quantised values up to 2**20 are multiplied as doubles, which is
exact, larger ones as 64-bit integers; a score beyond 64 bits is undefined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

BLOCK_ROWS = 128
EXACT_DOUBLE = 2 ** 20


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, ints) of the vectors that take part."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col))
            .filter(F.col("id").isNotNull() & F.col(vector_col).isNotNull())
            .filter(fine)
            .select("id", F.transform(x, lambda v: F.floor(v * scale).cast("bigint")).alias("ints")))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix, shorter rows filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Runs of ``size`` rows of a partition as one row: ids, matrix, largest and smallest components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        names = ["ids", "matrix", "wide", "width", "top", "low"]

        def pack(part: pa.Table) -> pa.RecordBatch:
            part = part.combine_chunks()
            ids = part.column("id").combine_chunks().to_numpy(zero_copy_only=False).astype("<i8")
            m = _matrix(part.column("ints").combine_chunks())
            wide = bool(np.abs(m).max(initial=0) >= 2 ** 31)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids.tobytes()], pa.binary()), pa.array([m.astype("<i8" if wide else "<i4").tobytes()], pa.binary()),
                 pa.array([wide]), pa.array([m.shape[1]], pa.int32()), pa.array([m.max(axis=0).tolist()], pa.list_(pa.int64())),
                 pa.array([m.min(axis=0).tolist()], pa.list_(pa.int64()))], names=names)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= size:
                t = pa.Table.from_batches(held)
                whole = t.num_rows - t.num_rows % size
                for i in range(0, whole, size):
                    yield pack(t.slice(i, size))
                held = t.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            yield pack(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "ids binary, matrix binary, wide boolean, width int, top array<bigint>, low array<bigint>")


def _load(row: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    m = np.frombuffer(row["matrix"], "<i8" if row["wide"] else "<i4").astype(np.int64).reshape(len(ids), row["width"])
    return ids, np.pad(m, ((0, 0), (0, width - row["width"])))


def _better(score: np.ndarray, ids: np.ndarray, s: np.ndarray, i: np.ndarray, k: int):
    """The k best of two lists per query: higher score, then smaller id."""
    score, ids = np.concatenate([score, s], axis=1), np.concatenate([ids, i], axis=1)
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


NONE = np.iinfo(np.int64).min + 1


def _search(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, blocks: list[tuple], k: int):
    """Per query the k best (score, id) of ``blocks``, as far as not below its floor."""
    n = len(q_ids)
    score, ids = np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max)
    largest = max([1, int(np.abs(q).max(initial=0)), *(int(np.abs(m).max(initial=0)) for _, m, _, _ in blocks)])
    kind = np.float64 if largest <= EXACT_DOUBLE and q.shape[1] <= 2 ** 12 else np.int64
    up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
    bounds = np.stack([(up @ top.astype(kind) + down @ low.astype(kind)).astype(np.int64) for _, _, top, low in blocks], 1)
    q, mats = q.astype(kind), [m.astype(kind) for _, m, _, _ in blocks]
    order = np.argsort(-bounds, axis=1, kind="stable")
    active = np.arange(n)
    for r in range(len(blocks)):
        at = order[active, r]
        kth = np.maximum(score[active, k - 1], floor[active])
        going = bounds[active, at] >= kth        # else all further bounds are below it too
        active, at = active[going], at[going]
        if not len(active):
            break
        for b in np.unique(at):
            mine = active[at == b]
            s = (q[mine] @ mats[b].T).astype(np.int64)
            i = np.broadcast_to(blocks[b][0], s.shape)
            s = np.where(i == q_ids[mine, None], NONE, s)
            score[mine], ids[mine] = _better(score[mine], ids[mine], s, i, k)
    return score, ids


def _pair_search(k: int, seeds: bool):
    """The search of one group: a batch of queries and a bundle of blocks."""
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        batches, bundle = left.to_pylist(), right.to_pylist()
        found = []
        for batch in batches if bundle else []:
            width = max([batch["width"], *(b["width"] for b in bundle)])
            q_ids, q = _load(batch, width)
            low = np.frombuffer(batch["floor"], "<i8") if batch["floor"] else np.full(len(q_ids), NONE)
            fill = lambda v: np.pad(np.asarray(v, np.int64), (0, width - len(v)))
            score, ids = _search(q_ids, q, low, [(*_load(b, width), fill(b["top"]), fill(b["low"])) for b in bundle], k)
            if seeds:
                found.append({"batch": [batch["batch"]], "floor": [score[:, k - 1].astype("<i8").tobytes()]})
                continue
            row, j = np.nonzero((score > NONE) & (score >= low[:, None]))
            found.append({"batch": np.full(len(row), batch["batch"]), "row": row, "query_id": q_ids[row],
                          "id": ids[row, j], "score": score[row, j]})
        schema = SEEDS if seeds else FOUND
        return pa.concat_tables([pa.Table.from_pydict(f, schema=schema) for f in found] or [schema.empty_table()])
    return search


SEEDS = pa.schema({"batch": pa.int64(), "floor": pa.binary()})
FOUND = pa.schema({"batch": pa.int64(), "row": pa.int64(), "query_id": pa.int64(), "id": pa.int64(), "score": pa.int64()})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, blocks_per_bundle: int = 64,
          queries_per_batch: int = 1024) -> DataFrame:
    """(query_id, rank, id_col, score): each query's ``k`` highest scores among the other vectors.

    ``queries`` has the same two columns as ``vectors``.
    """
    spark = vectors.sparkSession
    # Document-range blocks: rows dealt in ranges of ids, in id order within each.
    in_order = lambda df: quantised(df, id_col, vector_col, scale).repartitionByRange("id").sortWithinPartitions("id")
    blocks, blocks_at = write_table(_packed(in_order(vectors), block_rows), "topk-blocks")
    batches, _ = write_table(_packed(in_order(queries), queries_per_batch)
                             .select(F.monotonically_increasing_id().alias("batch"), "ids", "matrix", "wide", "width"), "topk-queries")
    bundles = max(1, -(-blocks.count() // blocks_per_bundle))
    blocks = blocks.withColumn("bundle", F.pmod(F.xxhash64("ids"), F.lit(bundles)).cast("int"))
    pair = ["batch", "bundle"]
    meeting = lambda pairs: (blocks.join(pairs.select(F.col("batch").alias("for_batch"), F.col("bundle").alias("for_bundle")),
                                         F.col("bundle") == F.col("for_bundle"))
                             .drop("bundle").groupBy("for_batch", "for_bundle"))

    # A floor under each query's k-th score, from one bundle.
    first = batches.withColumn("bundle", F.pmod(F.xxhash64("batch"), F.lit(bundles)).cast("int")).withColumn("floor", F.lit(None).cast("binary"))
    seeds = (first.groupBy(*pair)
             .cogroup(meeting(first))
             .applyInArrow(_pair_search(k, True), "batch bigint, floor binary"))
    floors, _ = write_table(seeds, "topk-floors")

    every = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    found = (batches.join(floors, "batch", "left").select("*", every)
             .groupBy(*pair)
             .cogroup(meeting(batches.select("batch", every)))
             .applyInArrow(_pair_search(k, False), "batch bigint, row bigint, query_id bigint, id bigint, score bigint"))
    rank = F.row_number().over(Window.partitionBy("batch", "row").orderBy(F.desc("score"), "id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
