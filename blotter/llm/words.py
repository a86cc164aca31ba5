"""Words and their hashes, found in whole batches of texts at once.

Texts are worked on as UTF-8 bytes in numpy: white space and A-Z are ASCII,
so bytes are enough to find and fold words. A word's hash is a polynomial
over its bytes (prefix sums modulo 2**64), mixed with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PART_BYTES = 1 << 19            # bytes worked on at once: what bounds memory
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
# ASCII white space (space, and 0x09 to 0x0D).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    x = np.asarray(x, U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = U(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up, down = np.full(n, BASE, U), np.full(n, inverse, U)
        up[0] = down[0] = U(1)
        return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


_UP, _DOWN = _powers(PART_BYTES + 1)


def _grown(n: int) -> None:
    """Powers for a single word longer than a part."""
    global _UP, _DOWN
    if n > len(_UP):
        _UP, _DOWN = _powers(n)


def parts(texts: list[str], limit: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, number of text of each byte run's end) in parts cut at white space, each about ``limit`` long (``PART_BYTES``).

    Yields the bytes of one or more texts, each followed by a space, with
    the end of each text's run; a text longer than a part comes in several.
    """
    limit = limit or PART_BYTES
    held: list[bytes] = []
    owners: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") + b" "
        while len(raw) > limit:
            cut = max(raw.rfind(b" ", 0, limit), raw.rfind(b"\n", 0, limit)) + 1 or _next_space(raw, limit)
            if held:
                yield _joined(held, owners)
                held, owners, size = [], [], 0
            yield _joined([raw[:cut]], [i])
            raw = raw[cut:]
        if size + len(raw) > limit and held:
            yield _joined(held, owners)
            held, owners, size = [], [], 0
        held.append(raw)
        owners.append(i)
        size += len(raw)
    if held:
        yield _joined(held, owners)


def _next_space(raw: bytes, limit: int) -> int:
    cuts = [c for c in (raw.find(b" ", limit), raw.find(b"\n", limit)) if c >= 0]
    return min(cuts) + 1 if cuts else len(raw)


def _joined(held: list[bytes], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(held), np.uint8)
    return data, np.stack([np.cumsum([len(h) for h in held]), np.array(owners)])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes that end with white space."""
    space = SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def prefix_sums(folded: np.ndarray) -> np.ndarray:
    _grown(len(folded) + 1)
    out = np.zeros(len(folded) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum((folded.astype(U) + U(1)) * _UP[:len(folded)], out=out[1:], dtype=U)
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * _DOWN[starts] + (ends - starts).astype(U))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts in order, and where each text's words begin (one more entry than texts)."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    for data, (ends, owners) in parts(texts):
        starts, stops = word_spans(data)
        hashes.append(span_hashes(prefix_sums(FOLD[data]), starts, stops))
        np.add.at(counts, owners, np.diff(np.searchsorted(starts, np.concatenate([[0], ends]))))
    begin = np.concatenate([[0], np.cumsum(counts)])
    return np.concatenate(hashes) if hashes else np.zeros(0, U), begin


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words; of all its words, if fewer."""
    words, begin = word_hashes(texts)
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(begin[:-1], begin[1:]):
            n, w = b - a, min(width, b - a)
            if not n:
                out.append(np.zeros(0, U))
                continue
            h = np.full(n - w + 1, U(w))
            for k in range(w):
                h = mix(h * BASE + words[a + k:a + k + len(h)])
            out.append(np.unique(h))
    return out
