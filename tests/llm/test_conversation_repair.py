import hashlib
import random
import re
from itertools import product
from zlib import crc32

import duckdb
import pytest
from blotter.llm import audit_dp, conversation_repair
from blotter.llm.conversation_repair import repair_conversations
from blotter.llm.queries import op11_conversation_repair
from pyspark.sql import functions as F

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, whole string, copies string, `end` string"


def brute_audit(rows, faults):
    """Least (cost, audit, lines) by trying every state at every turn with whole strings, from the last turn on."""
    grammar = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(best, state, seen=()):
        options = [best[state]] if best[state] else []
        for c in "ua":
            to = grammar[state].get(c)
            if to is not None and to not in seen:
                more = inserted(best, to, (*seen, state))
                if more:
                    options.append((more[0] + 5, "I" + more[1], [{"u": "user:", "a": "assistant:"}[c], *more[2]]))
        return min(options) if options else None

    after = [inserted([(0, "", []), None, None, (0, "", [])], s) for s in range(4)]
    for (role, text), fault in reversed(list(zip(rows, faults))):
        now = []
        for s in range(4):
            options = [(after[s][0] + 2, "D" + after[s][1], after[s][2])]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role[:1] in grammar[s]:
                    n = after[grammar[s][role[:1]]]
                    options.append((n[0] + extra, "K" + n[1], [f"{role}:{text}", *n[2]]))
                for name in ("user", "assistant"):
                    if name[0] in grammar[s] and name != role:
                        n = after[grammar[s][name[0]]]
                        options.append((n[0] + extra + 1, "R" + n[1], [f"{name}:{text}", *n[2]]))
            now.append(min(options))
        after = [inserted(now, s) for s in range(4)]
    return after[0]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        own = [r for r in rows if r[0] == conv]
        for _, turn, role, text in own:
            kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind:
                text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
                kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in kept:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, lines = brute_audit([r[1:] for r in kept], faults)
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows, got=None):
    if got is None:
        got = repair_conversations(spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA))
    found = [tuple(r) for r in got.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    want = brute(rows)
    assert len(found) == len(want)
    for r in found:
        assert r[1:] == want[r[0]], r[0]
    return want


def random_rows(seed, convs, longest):
    r = random.Random(seed)
    texts = ["Hi.", "Yes", " ", "", "ok!", "Why?\n", "no\t", None, "a" * 70 + ".", "a" * 70 + "b."]
    roles = ["user", "assistant", "system", "tool", "User", "", None, "us", "a"]
    rows = []
    for c in range(convs):
        for t in range(r.randint(1, longest)):
            role = r.choices(roles, [6, 6, 3, 1, 1, 1, 1, 1, 1])[0] if r.random() < 0.5 else ("user", "assistant")[t % 2]
            rows.append((c, None if r.random() < 0.05 else t + r.choice([0, 0, 0, 2, -1]), role, r.choice(texts) if r.random() < 0.6 else f"Text {t}."))
    r.shuffle(rows)
    return rows


def test_dp_against_all_edits():
    turns = "xsuaoSUAO"
    role = {"x": "user", "s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for n in range(5):
        for line in map("".join, product(turns, repeat=n)) if n < 4 else ("".join(random.Random(i).choices(turns, k=12)) for i in range(800)):
            rows = [(role[c.lower()], str(i)) for i, c in enumerate(line)]
            cost, audit, lines = brute_audit(rows, ["blank" if c == "x" else "truncated" if c.isupper() else "" for c in line])
            assert audit_dp.repair(line) == (cost, audit), line
            got, state = audit_dp.lines(rows, audit)
            assert got == lines and state in (audit_dp.START, audit_dp.ASSISTANT)


def test_ties_survive_hash_collisions():
    for i in range(300):
        line = "".join(random.Random(i).choices("xsuaoSUAO", k=30))
        assert audit_dp.solve(line, modulus=2) == audit_dp.solve(line)


def test_chained_runs_are_as_one():
    r = random.Random(9)
    for _ in range(200):
        runs = ["".join(r.choices("xsuaoSUAO", k=r.randint(0, 9))) for _ in range(r.randint(1, 6))]
        total = audit_dp.summary(runs[0])
        for run in runs[1:]:
            total = audit_dp.chain(total, audit_dp.summary(run))
        assert total == audit_dp.summary("".join(runs))
        way = audit_dp.route([audit_dp.summary(x) for x in runs], audit_dp.START)
        audit = "".join(audit_dp.solve(x, a)[b][1] for x, a, b in zip(runs, way, way[1:]))
        cost, more = audit_dp.TAIL[way[-1]]
        assert audit + "I" * len(more) == audit_dp.repair("".join(runs))[1]


@pytest.mark.parametrize("rows_a_piece", [conversation_repair.PIECE_ROWS, 3])
def test_random_conversations(spark, monkeypatch, rows_a_piece):
    monkeypatch.setattr(conversation_repair, "PIECE_ROWS", rows_a_piece)
    check(spark, random_rows(rows_a_piece, 120, 14))


def test_a_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PIECE_ROWS", 50)
    rows = random_rows(1, 40, 9) + [(7, t % 900, ("user", "assistant", "system", "tool")[t * t % 4], f"T{t % 600}" + "." * (t % 3)) for t in range(3000)]
    rows += [(8, 5, "user", "same.")] * 1500 + [(None, None, "user", None)] * 700
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (2, 2**62, "user", "x" * 2_000_000 + "."), (2, -(2**62), "assistant", "y."), (None, 1, "system", "s."), (None, 2, "user", "é😀!"),
            (3, 1, "user", " "), (3, 1, "user", " "), (-5, 0, "assistant", "line\none.")]
    want = check(spark, rows)
    assert want[2][0] == 2**63 - 1 or want[2][0] == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(empty).count() == 0
    gone = [(c, 0, "user", "x.") for c in range(200) if crc32(f"{c}:0".encode()) % 20 == 0]
    assert {v for v in check(spark, gone).values()} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query_on_the_whole_table(spark):
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM '/root/testdata/sf0.01/conversations.parquet'").fetchall()
    check(spark, rows, op11_conversation_repair(spark, "/root/testdata/sf0.01"))
