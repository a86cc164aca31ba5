"""Conversation structure repair: faults of turns, and the cheapest audit that mends them (``audit_dp``).

Rows are sorted by conversation and turn over ranges of all rows, so a
conversation that holds a third of them lies in many partitions. Each
partition is streamed once. A conversation wholly inside it is finished
there, in bounded memory; one that touches the partition's ends, or has
more than ``PIECE_ROWS`` rows or ``PIECE_CHARS`` characters, is written as
pieces. Pieces become summaries of constant size (cost and rank from every
state to every state), these are chained first per partition and
conversation and then per conversation, and each piece is solved again
with the states that the best way through all pieces gives it. What one
task holds of a conversation is a piece, a partition's summaries or one
summary a partition. Two things of a whole conversation can't be split:
its audit is one value of the result, and its digest is taken over its
repaired lines in order, piece after piece.

Damage follows the contract of the query: crc32 of ``conv_id:turn`` modulo
20 drops a row (0), empties its text (1), removes ``.!?`` from it (2),
repeats the row (3) or sets the role user (4).

Defined results: a null role or text is one space, a null turn or id counts
as one space in the damage's key; rows without id form one conversation;
null turns come first. Rows of one turn are ordered by role, then text (its
first 64 characters, then its MD5), so repeated rows are adjacent and all
but the first are duplicates. Roles count by their first character; a turn
is its own whatever its neighbours' numbers. ``gaps`` beyond a long is the
largest long. A conversation that loses all rows has zeros, an empty audit
and the digest of nothing; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from . import audit_dp
from .common import remove, write_table

PIECE_ROWS = 4096
PIECE_CHARS = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
LARGEST = (1 << 63) - 1
LEGAL = {"su", "ua", "au"}
RESULT = {"gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(),
          "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string()}
PIECE = {"part": pa.int32(), "seq": pa.int32(), "whole": pa.bool_(), "turns": pa.list_(pa.int64()), "roles": pa.list_(pa.string()),
         "texts": pa.list_(pa.string()), "marks": pa.list_(pa.binary())}


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage; a dropped row has 0 copies, a repeated one 2."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("kind"))
    kind, text = F.col("kind"), F.col("text")
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def in_order(rows: DataFrame) -> DataFrame:
    """``damaged`` rows sorted by conversation, turn, role and text over ranges that cut anywhere, even between equal rows."""
    keys = ["conv_id", "turn", "role", "head", "digest", "nth"]
    return (rows.withColumn("head", F.substring("text", 1, 64)).withColumn("digest", F.unhex(F.md5("text")))
                .withColumn("nth", F.monotonically_increasing_id())
                .repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "role", "text", "copies"))


def mark_of(role: str, text: str) -> bytes:
    """What equal rows share: a digest of role and text."""
    return hashlib.md5(f"{len(role)}:{role}:{text}".encode("utf-8", "surrogatepass")).digest()


def turn_of(role: str, text: str, repeated: bool) -> tuple[str, str]:
    """(fault, the turn's character for ``audit_dp``) of a row."""
    bare = text.rstrip(BLANKS)
    if not bare:
        return "blank", "x"
    if repeated:
        return "duplicate", "x"
    kind = role[0] if role[:1] in ("s", "u", "a") else "o"
    return ("truncated", kind.upper()) if bare[-1] not in ".!?" else ("", kind)


def illegal_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))


def sha256(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def gaps_of(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else min(LARGEST, high - low + 1 - distinct)


def finished(rows: list[tuple]) -> dict:
    """The result of one conversation's (turn, role, text) rows in order."""
    seen, turns, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
    for _, role, text in rows:
        fault, c = turn_of(role, text, (role, text) in seen)
        seen.add((role, text))
        count[fault] += 1
        turns.append(c)
    cost, audit = audit_dp.repair("".join(turns))
    lines, _ = audit_dp.lines([r[1:] for r in rows], audit)
    known = [r[0] for r in rows if r[0] is not None]
    return {"gaps": gaps_of(known[0] if known else None, known[-1] if known else None, len(set(known))), "blank": count["blank"],
            "duplicate": count["duplicate"], "truncated": count["truncated"], "illegal": illegal_pairs([r[1] for r in rows]),
            "cost": cost, "audit": audit, "repaired_sha256": sha256(lines)}


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations inside a sorted partition, pieces of the others."""
    part, seq, kind = TaskContext.get().partitionId(), 0, None
    ready: list[dict] = []
    size = 0

    def add(conv, rows, whole):
        nonlocal seq, size
        made = {"conv_id": conv, "part": part, "seq": seq, "whole": whole}
        if whole:
            made |= finished(rows)
        else:
            made |= {"turns": [r[0] for r in rows], "roles": [r[1] for r in rows], "texts": [r[2] for r in rows], "marks": [mark_of(r[1], r[2]) for r in rows]}
            size += sum(len(r[2]) for r in rows)
        seq += 1
        ready.append(made)

    def batch():
        nonlocal ready, size
        fields = {"conv_id": kind, **PIECE, **RESULT}
        out = pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in ready], t) for n, t in fields.items()], names=list(fields))
        ready, size = [], 0
        return out

    now, rows, chars, edge, begun = None, [], 0, True, False
    for got in batches:
        kind = got.schema.field("conv_id").type
        for conv, turn, role, text, copies in zip(*(got.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies"))):
            if begun and conv != now:
                add(now, rows, not edge)
                rows, chars, edge = [], 0, False
            now, begun = conv, True
            if len(rows) >= PIECE_ROWS or chars >= PIECE_CHARS:
                add(now, rows, False)
                rows, chars, edge = [], 0, True
            rows += [(turn, role, text)] * copies
            chars += len(text) * copies
            if len(ready) >= 4096 or size >= 4 * PIECE_CHARS:
                yield batch()
    if begun:
        add(now, rows, False)
        yield batch()


def _mapped(df: DataFrame, fields: dict[str, pa.DataType], fn: Callable[[dict], dict]) -> DataFrame:
    """``fn`` of every row; a few rows at a time, as each may be a piece."""
    schema = T.StructType([T.StructField(n, from_arrow_type(t)) for n, t in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 16):
                made = [fn(r) for r in batch.slice(k, 16).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([m[n] for m in made], t) for n, t in fields.items()], names=list(fields))

    return df.mapInArrow(run, schema)


def _flat(s: audit_dp.Summary) -> list[int]:
    return [x for row in s for pair in row for x in pair]


def _folded(flat: list[int]) -> audit_dp.Summary:
    return tuple(tuple((flat[8 * s + 2 * t], flat[8 * s + 2 * t + 1]) for t in audit_dp.STATES) for s in audit_dp.STATES)


def _turns(piece: dict) -> dict:
    """A piece's turns as characters, and their summary."""
    first = set(piece["firsts"] or ())
    count, turns = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, []
    for k, (role, text) in enumerate(zip(piece["roles"], piece["texts"])):
        fault, c = turn_of(role, text, k not in first)
        count[fault] += 1
        turns.append(c)
    line = "".join(turns)
    return {"part": piece["part"], "seq": piece["seq"], "line": line, "faults": [count["blank"], count["duplicate"], count["truncated"]],
            "summary": _flat(audit_dp.summary(line))}


def _chained(row: dict) -> dict:
    runs = [_folded(r["summary"]) for r in row["runs"]]
    total = runs[0]
    for run in runs[1:]:
        total = audit_dp.chain(total, run)
    return {"part": row["part"], "seq": row["seq"], "summary": _flat(total)}


def _routed(row: dict) -> dict:
    way = audit_dp.route([_folded(r["summary"]) for r in row["runs"]], row["entry"], row["end"])
    return {"legs": [{"part": r["part"], "seq": r["seq"], "entry": a, "end": b} for r, a, b in zip(row["runs"], way, way[1:])]}


LEGS = {"legs": pa.list_(pa.struct([("part", pa.int32()), ("seq", pa.int32()), ("entry", pa.int32()), ("end", pa.int32())]))}


def _solved(piece: dict) -> dict:
    cost, audit = audit_dp.solve(piece["line"], piece["entry"])[piece["end"]]
    lines, _ = audit_dp.lines(list(zip(piece["roles"], piece["texts"])), audit, piece["entry"])
    known = [t for t in piece["turns"] if t is not None]
    return {"conv_id": piece["conv_id"], "part": piece["part"], "seq": piece["seq"], "end": piece["end"], "cost": cost, "audit": audit,
            "faults": piece["faults"], "illegal": illegal_pairs(piece["roles"]), "first_role": piece["roles"][0] if piece["roles"] else None,
            "last_role": piece["roles"][-1] if piece["roles"] else None, "low": known[0] if known else None, "high": known[-1] if known else None,
            "distinct": len(set(known)), "lines": "\n".join(lines) if lines else None}


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations put together from their solved pieces, which come in order."""
    def made():
        end_cost, more = audit_dp.TAIL[end]
        for role in more:
            tail(f"{audit_dp.NAMES[role]}:")
        values = [now, gaps_of(low, high, distinct), *faults, illegal, cost + end_cost, "".join(audits) + "I" * len(more), digest.hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [kind, *RESULT.values()])], names=["conv_id", *RESULT])

    def tail(text):
        nonlocal written
        digest.update(("\n" + text if written else text).encode("utf-8", "surrogatepass"))
        written = True

    begun, now = False, None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for k in range(batch.num_rows):
            r = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
            if not begun or r["conv_id"] != now:
                if begun:
                    yield made()
                begun, now, digest, written, audits, cost, faults, illegal, last = True, r["conv_id"], hashlib.sha256(), False, [], 0, [0, 0, 0], 0, None
                low = high = None
                distinct = 0
            end, cost, illegal = r["end"], cost + r["cost"], illegal + r["illegal"]
            audits.append(r["audit"])
            faults = [a + b for a, b in zip(faults, r["faults"])]
            if r["first_role"] is not None:
                illegal += last is not None and last[:1] + r["first_role"][:1] not in LEGAL
                last = r["last_role"]
            if r["low"] is not None:
                distinct += r["distinct"] - (high == r["low"])
                low, high = r["low"] if low is None else low, r["high"]
            if r["lines"] is not None:
                tail(r["lines"])
    if begun:
        yield made()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation in ``rows`` after the damage.

    ``rows`` has conv_id, turn, role and text.
    """
    spark = rows.sparkSession
    ordered = in_order(damaged(rows))
    schema = T.StructType([ordered.schema["conv_id"], *(T.StructField(n, from_arrow_type(t)) for n, t in (PIECE | RESULT).items())])
    streamed, streamed_at = write_table(ordered.mapInArrow(_stream, schema), "repair-streamed")
    inside = streamed.filter("whole").select("conv_id", *RESULT)
    pieces = streamed.filter("NOT whole").select("conv_id", "part", "seq", "turns", "roles", "texts", "marks")
    at = F.struct("part", "seq", "k")
    seen = pieces.select("conv_id", "part", "seq", F.posexplode("marks").alias("k", "mark")).groupBy("conv_id", "mark").agg(F.min(at).alias("at"))
    firsts = seen.groupBy(F.col("at.part").alias("part"), F.col("at.seq").alias("seq")).agg(F.collect_list("at.k").alias("firsts"))
    key = {"part": pa.int32(), "seq": pa.int32()}
    flat = {**key, "summary": pa.list_(pa.int64())}
    faults = {"line": pa.string(), "faults": pa.list_(pa.int64())}
    marked, marked_at = write_table(_mapped(pieces.select("part", "seq", "roles", "texts").join(firsts, ["part", "seq"], "left"), {**flat, **faults}, _turns), "repair-turns")
    # A partition's pieces of a conversation, known by the first of them; then a conversation's partitions.
    run = F.struct("part", "seq", "summary")
    each = pieces.select("conv_id", "part", "seq").join(marked.select("part", "seq", "summary"), ["part", "seq"])
    local = each.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(run)).alias("runs"), F.min("seq").alias("seq"))
    local, local_at = write_table(local, "repair-local")
    totals = _mapped(local.select("part", "seq", "runs"), flat, _chained)
    over = local.select("conv_id", "part", "seq").join(totals, ["part", "seq"]).groupBy("conv_id").agg(F.sort_array(F.collect_list(run)).alias("runs"))

    def legs(df: DataFrame) -> DataFrame:
        return _mapped(df, LEGS, _routed).select(F.inline("legs"))

    parts = legs(over.select("runs", F.lit(audit_dp.START).alias("entry"), F.lit(None).cast("int").alias("end")))
    ways = legs(local.select("part", "seq", "runs").join(parts, ["part", "seq"]).select("runs", "entry", "end"))
    solved = {**key, "end": pa.int32(), "cost": pa.int64(), "audit": pa.string(), "faults": pa.list_(pa.int64()), "illegal": pa.int64(), "first_role": pa.string(),
              "last_role": pa.string(), "low": pa.int64(), "high": pa.int64(), "distinct": pa.int64(), "lines": pa.string()}
    kind = {"conv_id": to_arrow_type(ordered.schema["conv_id"].dataType)}
    done = _mapped(pieces.drop("marks").join(marked.select("part", "seq", "line", "faults"), ["part", "seq"]).join(ways, ["part", "seq"]), {**kind, **solved}, _solved)
    whole = T.StructType([ordered.schema["conv_id"], *(T.StructField(n, from_arrow_type(t)) for n, t in RESULT.items())])
    across = done.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_joined, whole)
    out, _ = write_table(inside.unionByName(across), "repair-result")
    remove(spark, streamed_at, marked_at, local_at)
    return out

