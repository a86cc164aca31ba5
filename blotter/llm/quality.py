"""Quality scores by hierarchical empirical Bayes: document evidence, path and host posteriors.

1. A document classifier, logistic regression on the frequencies of word
   shapes (``Word,`` -> ``Aa,``; runs of one kind count once) and on length,
   is fitted on a bounded sample of labelled documents. Its output is a
   probability p that the document is good.
2. One grouped aggregation sums p and p squared per path, sums of those per
   host, and sums of those overall. A host's posterior is the mean of its
   documents shrunk toward the global mean, as if it had ``k_host`` more
   documents of that mean; a path's is shrunk toward its host's with
   ``k_path``. Both strengths are estimated from the data by the method of
   moments: how much group means vary beyond what documents in a group do.
   Sparse sites so stay near their host or the global prior.
3. A document's posterior odds are its own odds times the ratio of its
   path's odds to the global ones. A document's own p is taken out of its
   path's sum first, so it doesn't count twice.

The aggregations reduce in the map tasks before anything is shuffled, so a
host with a third of all documents is one row per task. The path table is
joined as Spark's statistics say; nothing is broadcast by hand.

Defined results: a null text is empty; null hosts are one host, null paths
one path of their host; repeated rows count each and score alike; with no
label of one kind to learn from every document's own p is 0.5, and every
posterior is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_one_task, labelled_sample, map_batches, texts, write_table
from .words import SPACE, U, parts, prefix_sums, span_hashes, word_spans

BUCKETS = 1 << 10               # of word shapes
FEATURES = BUCKETS + 2
# Kinds of bytes: letters are one of two kinds (longer characters count as lower case), digits one, others their own.
KIND = np.arange(256, dtype=np.uint8)
KIND[65:91], KIND[97:123], KIND[128:], KIND[48:58], KIND[SPACE] = 65, 97, 97, 48, 32


def shape_features(some: list[str]) -> np.ndarray:
    """One row per text: square roots of the shares of word shapes, log of the number of words, letters a word."""
    counts = np.zeros((len(some), BUCKETS), np.float32)
    size = np.zeros(len(some))
    for data, (ends, owners) in parts(some):
        size_of = np.diff(np.concatenate([[0], ends]))
        np.add.at(size, owners, size_of)
        kind = KIND[data]
        change = np.concatenate([[True], kind[1:] != kind[:-1]])
        shape = np.append(kind[change], np.uint8(32))
        starts, stops = word_spans(shape)
        if not len(starts):
            continue
        # A text's runs of kinds end where its bytes do.
        text_ends = np.cumsum(change)[ends - 1]
        bucket = (span_hashes(prefix_sums(shape), starts, stops) % U(BUCKETS)).astype(np.int64)
        owner = owners[np.searchsorted(text_ends, starts, "right").clip(max=len(owners) - 1)]
        np.add.at(counts, (owner, bucket), 1)
    words = counts.sum(axis=1)
    out = np.empty((len(some), FEATURES), np.float32)
    out[:, :BUCKETS] = np.sqrt(counts / np.maximum(words, 1)[:, None])
    out[:, BUCKETS] = np.log1p(words) / 10
    out[:, BUCKETS + 1] = np.minimum(size / np.maximum(words, 1), 50) / 10
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 2.0, ridge: float = 1e-3) -> np.ndarray:
    """Weights (bias last) of a logistic regression on balanced classes, by gradient descent with momentum."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1, dtype=np.float64)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        speed = 0.9 * speed - rate * (x.T @ (share * (p - y)) + ridge * np.append(w[:-1], 0))
        w = w + speed
    return w


def classifier(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int, id_col: str, text_col: str) -> np.ndarray | None:
    """The weights, from a sample of at most ``per_class`` texts of each label, of at most ``max_chars`` characters.

    The sample has both labels alike; the bias is set to the share of good ones among all labels.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)).groupBy("id").agg(F.max("label").alias("label")))
    def fitted(some: list[str], known: list[int]) -> bytes:
        return fit(shape_features(some), np.array(known)).tobytes() if len(set(known)) == 2 else b""

    weights = np.frombuffer(in_one_task(labelled_sample(docs, known, per_class, max_chars, id_col, text_col), fitted)).copy()
    if not len(weights):
        return None
    share = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    weights[-1] += np.log(share[1] / share[0])
    return weights


def with_evidence(docs: DataFrame, weights: np.ndarray | None, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """(keep..., p): the classifier's probability that a document is good, kept off 0 and 1."""
    def start():
        def run(batch: pa.RecordBatch) -> dict:
            some = texts(batch, text_col)
            if weights is None:
                return {"p": [0.5] * len(some)}
            p = []
            for a in range(0, len(some), 1024):
                x = shape_features(some[a:a + 1024])
                p.append(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))
            return {"p": pa.array(np.clip(np.concatenate(p), 1e-4, 1 - 1e-4) if p else np.zeros(0))}
        return run

    return map_batches(docs.select(*dict.fromkeys([*keep, text_col])), list(keep), start, {"p": pa.float64()})


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """(host, path, n, total, k_path, host_mean, mean) per path of documents with (host, path, p).

    ``host_mean`` is the host's posterior mean, ``mean`` the global one.
    """
    path = evidence.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("total"), F.sum(F.col("p") * F.col("p")).alias("square"))
    path, _ = write_table(path, "quality-paths")
    host = path.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("total").alias("ht"), F.sum("square").alias("hs"))
    host, _ = write_table(host, "quality-hosts")
    overall = host.agg(F.sum("hn").alias("N"), F.sum("ht").alias("T"), F.sum("hs").alias("S"),
                       F.count(F.lit(1)).alias("hosts"), F.sum(F.col("ht") * F.col("ht") / F.col("hn")).alias("host_fit")).first()
    paths = path.agg(F.sum(F.col("total") * F.col("total") / F.col("n")).alias("path_fit"), F.count(F.lit(1)).alias("paths")).first()
    n, hosts, n_paths = overall["N"] or 0, overall["hosts"], paths["paths"]
    mean = overall["T"] / n if n else 0.5
    # Sums of squares: within paths, between the paths of hosts, between hosts.
    within = (overall["S"] - paths["path_fit"]) / max(1, n - n_paths) if n else 1.0
    between_paths = (paths["path_fit"] - overall["host_fit"]) / max(1, n_paths - hosts) if n else 1.0
    between_hosts = (overall["host_fit"] - n * mean * mean) / max(1, hosts - 1) if n else 1.0
    spread = lambda between, base, groups: max(0.0, between - base) / max(1.0, n / max(1, groups))
    strength = lambda v: min(1000.0, max(1.0, within / max(v, 1e-9)))
    k_host, k_path = strength(spread(between_hosts, between_paths, hosts)), strength(spread(between_paths, within, n_paths))
    host = host.select(F.col("host").alias("of"), ((F.col("ht") + k_host * mean) / (F.col("hn") + k_host)).alias("host_mean"))
    return (path.join(host, F.col("host").eqNullSafe(F.col("of")))
            .select("host", "path", "n", "total", F.lit(k_path).alias("k_path"), "host_mean", F.lit(mean).alias("mean")))


def _logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def score_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, keep: Sequence[str],
                  id_col: str = "doc_id", text_col: str = "text", per_class: int = 2000, max_chars: int = 20_000) -> DataFrame:
    """(keep..., host, path, evidence, host_posterior, path_posterior, posterior, good) of every document.

    ``evidence`` is the document's own p; ``good`` is a posterior of 0.5 or more.
    """
    weights = classifier(docs, labels, per_class, max_chars, id_col, text_col)
    sited = docs.select(*keep, *([text_col] if text_col not in keep else []), host.alias("llm_host"), path.alias("llm_path"))
    e = with_evidence(sited, weights, [*keep, "llm_host", "llm_path"], text_col)
    sites = site_posteriors(with_evidence(sited, weights, ["llm_host", "llm_path"], text_col)
                            .select(F.col("llm_host").alias("host"), F.col("llm_path").alias("path"), "p"))
    sites = sites.select([F.col(c).alias("site_" + c) for c in sites.columns])
    joined = e.join(sites, F.col("llm_host").eqNullSafe(F.col("site_host")) & F.col("llm_path").eqNullSafe(F.col("site_path")), "left")
    p, k = F.col("p"), F.col("site_k_path")
    # The path without this document.
    others = (F.col("site_total") - p + k * F.col("site_host_mean")) / (F.col("site_n") - 1 + k)
    others = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), others))
    prior = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("site_mean")))
    odds = _logit(p) + _logit(others) - _logit(prior)
    posterior = 1 / (1 + F.exp(-odds))
    return joined.select(*keep, F.col("llm_host").alias("host"), F.col("llm_path").alias("path"), p.alias("evidence"),
                         F.col("site_host_mean").alias("host_posterior"), others.alias("path_posterior"),
                         posterior.alias("posterior"), (posterior >= 0.5).alias("good"))
