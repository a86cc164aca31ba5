"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words: a word's vector is the sum of a row for the word itself
and rows for its character 4- and 5-grams (with the word's borders), all
from one table by hash, so words never seen are known by their parts. Two
gated recurrent layers read a window of ``WINDOW`` words in either
direction; attention weighs their states, and a logistic unit scores the
pooled state. Training is by backpropagation through time with Adam; the
window is the example.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .words import FOLD, U, mix, parts, prefix_sums, span_hashes, word_spans

WINDOW, STRIDE = 32, 24         # words; windows overlap by the difference
ROWS = 1 << 17                  # of the input table
INPUT, HIDDEN = 12, 8
GRAMS = (4, 5)                  # characters (UTF-8 bytes), borders included
BATCH = 512                     # windows scored at once
PART = 1 << 18                  # bytes whose words are read at once: each makes about a dozen rows
F32 = np.float32
BORDER = np.array([32], np.uint8)
WORDLESS = -10.0                # the score of a text without words: nothing speaks for label 1


@dataclass
class Net:
    table: np.ndarray                       # (ROWS, INPUT)
    wx: np.ndarray                          # (2, INPUT, 3 * HIDDEN): update, reset, candidate; forward and backward
    wh: np.ndarray                          # (2, HIDDEN, 3 * HIDDEN)
    b: np.ndarray                           # (2, 3 * HIDDEN)
    attend: np.ndarray                      # (2 * HIDDEN, HIDDEN)
    query: np.ndarray                       # (HIDDEN,)
    out: np.ndarray                         # (2 * HIDDEN,)
    bias: np.ndarray                        # (1,)

    def parameters(self) -> dict[str, np.ndarray]:
        return self.__dict__


def new_net(seed: int = 1) -> Net:
    r = np.random.default_rng(seed)
    n = lambda *shape, by=1.0: (r.standard_normal(shape) * by).astype(F32)
    # Parts never seen in training add nothing to a word.
    return Net(np.zeros((ROWS, INPUT), F32), n(2, INPUT, 3 * HIDDEN, by=INPUT ** -0.5), n(2, HIDDEN, 3 * HIDDEN, by=HIDDEN ** -0.5),
               np.zeros((2, 3 * HIDDEN), F32), n(2 * HIDDEN, HIDDEN, by=HIDDEN ** -0.5), n(HIDDEN, by=0.5),
               n(2 * HIDDEN, by=0.3), np.zeros(1, F32))


# --- inputs -----------------------------------------------------------------

@dataclass
class Words:
    """The words of several texts: rows of the input table, and where words, texts begin."""
    rows: np.ndarray            # table rows of all words, those of a word together
    first: np.ndarray           # first row of each word; one more than words
    text_first: np.ndarray      # first word of each text; one more than texts


def read_words(texts: list[str]) -> Words:
    """Words are runs between white space with A-Z lower-cased and anything but letters cut from both ends' hash.

    Bytes other than ASCII letters and those of longer characters count as
    borders, so ``word,`` and ``word`` share their grams.
    """
    rows, sizes, counts = [], [], np.zeros(len(texts), np.int64)
    for data, (ends, owners) in parts(texts, PART):
        folded = FOLD[data]
        letter = ((folded >= 97) & (folded <= 122)) | (folded >= 128)
        # With a border before the first word and after the last.
        clean = np.concatenate([BORDER, np.where(letter, folded, BORDER), BORDER])
        starts, stops = word_spans(clean)
        np.add.at(counts, owners, np.diff(np.searchsorted(starts, np.concatenate([[0], ends + 1]))))
        if not len(starts):
            continue
        sums = prefix_sums(clean)
        n = stops - starts
        # Grams begin anywhere from the border before the word, and end by the border after it.
        per = [np.maximum(n + 2 - g + 1, 0) for g in GRAMS]
        size = 1 + sum(per)
        first = np.concatenate([[0], np.cumsum(size)])
        hashes = np.empty(first[-1], U)
        hashes[first[:-1]] = span_hashes(sums, starts, stops)
        done = first[:-1] + 1
        low = starts - 1
        for g, k in zip(GRAMS, per):
            word = np.repeat(np.arange(len(k)), k)
            step = np.arange(len(word)) - np.repeat(np.cumsum(k) - k, k)
            at = low[word] + step
            hashes[done[word] + step] = span_hashes(sums, at, at + g) ^ U(g)
            done = done + k
        rows.append((mix(hashes) % U(ROWS)).astype(np.int32))
        sizes.append(size)
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    return Words(np.concatenate(rows) if rows else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(size)]),
                 np.concatenate([[0], np.cumsum(counts)]))


def word_vectors(net: Net, words: Words, begin: int, end: int) -> np.ndarray:
    """Vectors of words ``begin`` to ``end``."""
    if begin == end:
        return np.zeros((0, INPUT), F32)
    a, b = words.first[begin], words.first[end]
    return np.add.reduceat(net.table[words.rows[a:b]], words.first[begin:end] - a, axis=0)


def windows(n_words: int) -> np.ndarray:
    """Starts of the overlapping windows that cover ``n_words`` words; one, which is empty, for none."""
    if n_words <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n_words - WINDOW, STRIDE), n_words - WINDOW)


# --- the network ---------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * (np.tanh(F32(0.5) * x) + F32(1))


def _forward(net: Net, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Scores (logits) of windows; x (T, B, INPUT), mask (T, B). ``keep`` gets what backpropagation needs."""
    steps, n, _ = x.shape
    states = np.empty((steps, n, 2 * HIDDEN), F32)
    trace: list[list] = [[], []]
    for d in (0, 1):
        gates = x @ net.wx[d] + net.b[d]
        h = np.zeros((n, HIDDEN), F32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            g, m = gates[t], mask[t][:, None]
            zr = _sigmoid(g[:, :2 * HIDDEN] + h @ net.wh[d][:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN:] + (r * h) @ net.wh[d][:, 2 * HIDDEN:])
            new = h + m * z * (c - h)
            if keep is not None:
                trace[d].append((t, h, z, r, c, m))
            h = new
            states[t, :, d * HIDDEN:(d + 1) * HIDDEN] = h
    u = np.tanh(states @ net.attend)
    e = np.where(mask > 0, u @ net.query, F32(-1e9))
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", w, states)
    if keep is not None:
        keep += [trace, states, u, w, pooled]
    return pooled @ net.out + net.bias[0]


def _backward(net: Net, x: np.ndarray, keep: list, d_score: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters other than the table, and of x."""
    trace, states, u, w, pooled = keep
    g = {k: np.zeros_like(v) for k, v in net.parameters().items() if k != "table"}
    g["bias"][0], g["out"] = d_score.sum(), pooled.T @ d_score
    d_pooled = np.outer(d_score, net.out)
    d_states = w[..., None] * d_pooled
    d_w = np.einsum("bh,tbh->tb", d_pooled, states)
    d_e = w * (d_w - (w * d_w).sum(axis=0))
    g["query"] = np.einsum("tb,tba->a", d_e, u)
    d_a = (d_e[..., None] * net.query) * (1 - u * u)
    flat = d_a.reshape(-1, HIDDEN)
    g["attend"] = states.reshape(-1, 2 * HIDDEN).T @ flat
    d_states = d_states + d_a @ net.attend.T
    d_x = np.zeros_like(x)
    for d in (0, 1):
        wz, wc = net.wh[d][:, :2 * HIDDEN], net.wh[d][:, 2 * HIDDEN:]
        d_gates = np.empty((x.shape[0], x.shape[1], 3 * HIDDEN), F32)
        d_h = np.zeros((x.shape[1], HIDDEN), F32)
        for t, h, z, r, c, m in reversed(trace[d]):
            d_h = d_h + d_states[t, :, d * HIDDEN:(d + 1) * HIDDEN]
            d_c = d_h * m * z * (1 - c * c)
            d_z = d_h * m * (c - h) * z * (1 - z)
            d_rh = d_c @ wc.T
            d_r = d_rh * h * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r], axis=1)
            d_gates[t] = np.concatenate([d_zr, d_c], axis=1)
            g["wh"][d][:, :2 * HIDDEN] += h.T @ d_zr
            g["wh"][d][:, 2 * HIDDEN:] += (r * h).T @ d_c
            d_h = d_h * (1 - m * z) + d_rh * r + d_zr @ wz.T
        g["wx"][d] = x.reshape(-1, INPUT).T @ d_gates.reshape(-1, 3 * HIDDEN)
        g["b"][d] = d_gates.sum(axis=(0, 1))
        d_x += d_gates @ net.wx[d].T
    return g, d_x


def _gather(vectors: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x and mask of windows of ``lengths`` words that begin at ``begins`` in ``vectors``; and the words' places."""
    steps = max(1, int(lengths.max(initial=0)))
    at = begins + np.arange(steps)[:, None]
    mask = (np.arange(steps)[:, None] < lengths).astype(F32)
    at = np.where(mask > 0, at, 0)
    if not len(vectors):
        return np.zeros((*at.shape, INPUT), F32), mask, at
    return vectors[at] * mask[..., None], mask, at


def score_texts(net: Net, texts: list[str]) -> np.ndarray:
    """The largest score (logit) of each text's windows."""
    words = read_words(texts)
    counts = np.diff(words.text_first)
    starts = [windows(int(n)) for n in counts]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    begins = np.concatenate([s + f for s, f in zip(starts, words.text_first)]) if texts else np.zeros(0, np.int64)
    lengths = np.minimum(counts[owner], WINDOW) if texts else np.zeros(0, np.int64)
    best = np.full(len(texts), -np.inf)
    for a in range(0, len(begins), BATCH):
        some = slice(a, a + BATCH)
        lo, hi = int(begins[some].min()), int((begins[some] + lengths[some]).max())
        x, mask, _ = _gather(word_vectors(net, words, lo, hi), begins[some] - lo, lengths[some])
        np.maximum.at(best, owner[some], _forward(net, x, mask))
    best[counts == 0] = WORDLESS
    return best


def train(texts: list[str], labels: np.ndarray, epochs: int = 6, seed: int = 1, rate: float = 0.01, per_text: int = 12) -> Net:
    """A net trained on labelled texts.

    A text's label is that of its worst window. In the first epoch each text
    teaches by up to ``per_text`` of its windows; from then on, of all its
    windows, by the one that scores highest so far, and a text of label 0
    also by a few others.
    """
    r, net = np.random.default_rng(seed), new_net(seed)
    words = read_words(texts)
    counts = np.diff(words.text_first)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.parameters().items()}
    step = 0
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    for epoch in range(epochs):
        begins, lengths, target, share = [], [], [], []
        for k in range(len(texts)):
            w = windows(int(counts[k]))
            if epoch and len(w) > 1:
                n = np.full(len(w), min(WINDOW, int(counts[k])))
                x, mask, _ = _gather(word_vectors(net, words, int(words.text_first[k]), int(words.text_first[k + 1])), w, n)
                worst = int(_forward(net, x, mask).argmax())
                w = w[[worst]] if labels[k] == 1 else w[np.unique([worst, *r.integers(0, len(w), 3)])]
            elif len(w) > per_text:
                w = r.choice(w, per_text, replace=False)
            begins += [int(s + words.text_first[k]) for s in w]
            lengths += [min(int(counts[k]), WINDOW)] * len(w)
            target += [labels[k]] * len(w)
            share += [weight[k] / len(w)] * len(w)
        begins, lengths, target, share = (np.asarray(v) for v in (begins, lengths, target, share))
        share = share / share.mean()
        order = r.permutation(len(begins))
        for a in range(0, len(order), 128):
            pick = order[a:a + 128]
            step += 1
            # The words of the batch's windows, each window's after the other's.
            n = lengths[pick]
            place = np.concatenate([[0], np.cumsum(n)])
            ids = np.repeat(begins[pick] - place[:-1], n) + np.arange(place[-1])
            rows_n = words.first[ids + 1] - words.first[ids]
            rows_at = np.concatenate([[0], np.cumsum(rows_n)])
            rows = words.rows[np.repeat(words.first[ids] - rows_at[:-1], rows_n) + np.arange(rows_at[-1])]
            vectors = np.add.reduceat(net.table[rows], rows_at[:-1], axis=0) if len(rows) else np.zeros((0, INPUT), F32)
            x, mask, at = _gather(vectors, place[:-1], n)
            keep: list = []
            score = _forward(net, x, mask, keep)
            d_score = ((_sigmoid(score) - target[pick]) * share[pick] / len(pick)).astype(F32)
            grads, d_x = _backward(net, x, keep, d_score)
            # Of the table only the rows that occur are touched.
            touched, at_row = np.unique(rows, return_inverse=True)
            grads["table"] = np.zeros((len(touched), INPUT), F32)
            if len(rows):
                d_words = np.zeros_like(vectors)
                real = mask > 0
                d_words[at[real]] = d_x[real]
                np.add.at(grads["table"], at_row, np.repeat(d_words, rows_n, axis=0))
            size = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
            for k, v in net.parameters().items():
                part = touched if k == "table" else ...
                grad = grads[k] * F32(min(1.0, 1.0 / (size + 1e-9)))
                m, s = moments[k][0][part], moments[k][1][part]
                m = m + F32(0.1) * (grad - m)
                s = s + F32(0.01) * (grad * grad - s)
                moments[k][0][part], moments[k][1][part] = m, s
                v[part] -= F32(rate) * (m / F32(1 - 0.9 ** step)) / (np.sqrt(s / F32(1 - 0.99 ** step)) + F32(1e-6))
    return net
