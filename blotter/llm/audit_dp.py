"""The cheapest edits of a run of turns, ties to the ASCII-least audit, by a persistent dynamic program.

A turn is one character: ``x`` must be deleted; ``s``, ``u``, ``a``, ``o``
(system, user, assistant, other) may be kept or rewritten; a capital is the
same turn truncated. A state says what the turns kept so far end with:
``START`` (none), ``SYSTEM``, ``USER``, ``ASSISTANT``. A letter of an audit
and the state before it fix the state after it.

Per turn and state the program keeps one cheapest edit prefix, as a node
that links to the prefix it extends, so prefixes are shared. A node has its
ancestors 1, 2, 4, ... letters back and a rolling hash of its whole prefix.
Of equally cheap prefixes the least stays: both are lifted to the last
place where their hashes agree, and the letters that follow decide. Equal
hashes are verified on the letters. Of two equally cheap prefixes that end
in one state neither begins the other (what follows would be insertions
that lead back to the state, and those cost), so the order of prefixes is
the order of all audits that extend them.

Insertions belong to the turn they precede; those after the last turn are
added at the end. So a run's audits to different states never begin each
other, and runs can be solved apart and chained: ``summary`` gives the cost
from every state to every state, and the rank of its audit among those from
the same state; ``chain`` puts two summaries together.
"""

from __future__ import annotations

from functools import lru_cache

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INF = 1 << 60
# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# The state after a role, by the state before it.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
# What completes a conversation that ends in a state: the cost, and the roles inserted.
TAIL = {START: (0, ""), SYSTEM: (2 * INSERT, "ua"), USER: (INSERT, "a"), ASSISTANT: (0, "")}
NAMES = {"u": "user", "a": "assistant"}
MODULUS, FACTOR = (1 << 61) - 1, 0x1F3D5B79A2C4E687


class Prefixes:
    """Edit prefixes as nodes; node 0 is the empty prefix."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def extend(self, node: int, letter: str) -> int:
        new = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * FACTOR + ord(letter)) % self.modulus)
        back, step, at = [node], 0, node
        while step < len(self.up[at]):
            at = self.up[at][step]
            step += 1
            back.append(at)
        self.up.append(back)
        return new

    def lifted(self, node: int, depth: int) -> int:
        """The node's ancestor at ``depth``."""
        while self.depth[node] > depth:
            jump = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][min(jump, len(self.up[node]) - 1)]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _agree(self, a: int, b: int) -> bool:
        """Whether two prefixes of one depth are equal, letter by letter up to a shared node."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether ``a``'s letters come before ``b``'s."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, depth), self.lifted(b, depth)
        if self.hash[x] == self.hash[y]:
            return self.depth[a] < self.depth[b] if self._agree(x, y) else self.text(a) < self.text(b)
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if not self._agree(self.up[x][0], self.up[y][0]):
            return self.text(a) < self.text(b)
        return self.letter[x] < self.letter[y]


def _best(prefixes: Prefixes, options: list[tuple[int, int, str]]) -> tuple[int, int] | None:
    """(cost, node) of the cheapest of (cost, node, letter to add), ties to the least audit."""
    if not options:
        return None
    cost = min(o[0] for o in options)
    best = None
    for c, node, letter in options:
        if c == cost:
            new = prefixes.extend(node, letter) if letter else node
            if best is None or prefixes.less(new, best):
                best = new
    return cost, best


def solve(turns: str, entry: int = START, modulus: int = MODULUS) -> list[tuple[int, str] | None]:
    """Per state (cost, audit) of the best edits of ``turns`` that lead there from ``entry``; None if there are none."""
    prefixes = Prefixes(modulus)
    now: list[tuple[int, int] | None] = [None] * 4
    now[entry] = (0, 0)
    for turn in turns:
        if turn != "x":
            kept = [(now[s][0], now[s][1], "") if now[s] else None for s in STATES]
            into_user = [(now[s][0] + INSERT, now[s][1], "I") for s in (START, SYSTEM, ASSISTANT) if now[s]]
            now[USER] = _best(prefixes, ([kept[USER]] if kept[USER] else []) + into_user)
            now[ASSISTANT] = _best(prefixes, ([kept[ASSISTANT]] if kept[ASSISTANT] else []) + ([(now[USER][0] + INSERT, now[USER][1], "I")] if now[USER] else []))
        options: list[list[tuple[int, int, str]]] = [[] for _ in STATES]
        role, more = turn.lower(), TRUNCATED if turn.isupper() else 0
        for s in STATES:
            if now[s] is None:
                continue
            cost, node = now[s]
            options[s].append((cost + DELETE, node, "D"))
            if turn == "x":
                continue
            if s in AFTER[role]:
                options[AFTER[role][s]].append((cost + more, node, "K"))
            for to in "ua":
                if s in AFTER[to] and to != role:
                    options[AFTER[to][s]].append((cost + more + REROLE, node, "R"))
        now = [_best(prefixes, o) for o in options]
    return [(n[0], prefixes.text(n[1])) if n else None for n in now]


@lru_cache(maxsize=1 << 16)
def _short(turns: str) -> tuple[int, str]:
    return _whole(turns)


def _whole(turns: str) -> tuple[int, str]:
    found = [(f[0] + TAIL[s][0], f[1] + "I" * len(TAIL[s][1])) for s, f in enumerate(solve(turns)) if f]
    return min(found)


def repair(turns: str) -> tuple[int, str]:
    """(cost, audit) of the best edits of a whole conversation."""
    return _short(turns) if len(turns) <= 64 else _whole(turns)


def lines(rows: list[tuple[str, str]], audit: str, entry: int = START) -> tuple[list[str], int]:
    """The repaired ``role:text`` lines of (role, text) rows under an audit, and the state they lead to."""
    out, state, at = [], entry, 0
    for letter in audit:
        if letter == "D":
            at += 1
        elif letter == "K":
            role, text = rows[at]
            out.append(f"{role}:{text}")
            state = AFTER[role[:1]][state]
            at += 1
        else:
            to = "a" if state == USER else "u"
            out.append(f"{NAMES[to]}:{rows[at][1] if letter == 'R' else ''}")
            at += letter == "R"
            state = AFTER[to][state]
    return out, state


Summary = tuple[tuple[tuple[int, int], ...], ...]


def summary(turns: str) -> Summary:
    """Per state before and state after: (cost, rank of its audit among those from the same state)."""
    out = []
    for entry in STATES:
        found = solve(turns, entry)
        order = sorted((f[1], s) for s, f in enumerate(found) if f)
        rank = {s: r for r, (_, s) in enumerate(order)}
        out.append(tuple((f[0], rank[s]) if f else (INF, 0) for s, f in enumerate(found)))
    return tuple(out)


def chain(first: Summary, then: Summary) -> Summary:
    """The summary of two runs of turns, one after the other."""
    out = []
    for entry in STATES:
        ways = []
        for end in STATES:
            # Of equal costs the least audit: that of the first run decides, as none begins another.
            cost, rank, mid = min((first[entry][m][0] + then[m][end][0], first[entry][m][1], m) for m in STATES)
            ways.append((cost, rank, then[mid][end][1]) if cost < INF else None)
        order = {k: r for r, k in enumerate(sorted({(w[1], w[2]) for w in ways if w}))}
        out.append(tuple((w[0], order[w[1:]]) if w else (INF, 0) for w in ways))
    return tuple(out)


def route(runs: list[Summary], entry: int, end: int | None = None) -> list[int]:
    """The states before the first, between all, and after the last of ``runs`` on the best way from ``entry``.

    To ``end``; or to any state, its completion counted, if that is None.
    """
    left = [[TAIL[s][0] if end is None else (0 if s == end else INF) for s in STATES]]
    for run in reversed(runs):
        left.append([min(run[s][m][0] + left[-1][m] for m in STATES) for s in STATES])
    left.reverse()
    out = [entry]
    for k, run in enumerate(runs):
        s = out[-1]
        out.append(min((run[s][m][0] + left[k + 1][m], run[s][m][1], m) for m in STATES)[2])
    return out
