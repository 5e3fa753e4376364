"""Quality classifier with site-level empirical Bayes (operator 2).

A logistic classifier on statistics of the text gives each document its evidence. Documents sit in a
hierarchy: all documents, hosts, paths of a host. The share of good documents of a host is a beta posterior
around the global share, that of a path one around its host's; how strongly a level is pulled to the level
above comes from the spread of the shares between its groups (method of moments). So a path with few
documents says little and one with many says much. A document is kept if the odds of its evidence times
the odds of its path, itself left out, are at least even.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames, words

#: Labelled documents (those of smallest hash) the classifier is fitted on.
SAMPLE_DOCS = 10_000
FEATURES = 13
#: Bounds of the number of documents that a level above is worth.
WEAKEST, STRONGEST = 2.0, 10_000.0
#: No site may outweigh the evidence of a document beyond these odds.
SITE_LOGIT = 2.0


def features(found: words.Words) -> np.ndarray:
    """Statistics of each document: shares of kinds of characters, of distinct words and repeated lines."""
    counts, owner, data = found.counts, found.owners(), found.data
    docs = len(counts)
    begin = np.append(found.start, len(data))[np.minimum(found.bounds[:-1], len(found.start))]
    end = np.append(found.stop, 0)[np.where(counts > 0, found.bounds[1:] - 1, len(found.stop))]
    begin = np.where(counts > 0, begin, 0)
    size = np.maximum(end - begin, 1)

    def share(mark: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mark, dtype=np.int64)])
        return np.where(counts > 0, sums[end] - sums[begin], 0) / size

    is_in = lambda chars: np.isin(data, np.frombuffer(chars, np.uint8))
    upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    order = np.lexsort((found.hashes, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (found.hashes[order][1:] != found.hashes[order][:-1])
    distinct = np.bincount(owner[order][fresh], minlength=docs)
    runs = np.diff(np.append(np.flatnonzero(fresh), len(order)))
    largest = np.zeros(docs)
    np.maximum.at(largest, owner[order][fresh], runs)
    n = np.maximum(counts, 1)
    length = np.bincount(owner, weights=found.stop - found.start, minlength=docs) / n
    lone = np.bincount(owner, weights=(found.stop - found.start) == 1, minlength=docs) / n
    return np.stack(
        [
            np.log1p(counts),
            share(is_in(b"#*$%&|<>")),
            share(data == ord("|")),
            share(data == ord("!")),
            share(is_in(b".,;:?")),
            share(upper),
            share(digit),
            share(data >= 128),
            share(data == 10),
            distinct / n,
            np.sqrt(largest / n),
            length,
            lone,
        ],
        axis=1,
    )


@words.frugal
def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            found = words.split(data, offsets)
            values = pa.array(features(found).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(end - begin + 1, dtype=np.int32) * FEATURES), values)
            yield pa.RecordBatch.from_arrays([batch.column("quality")[begin:end], lists], ["quality", "features"])


class Logistic:
    """Ridge-penalised logistic regression on standardised features and their squares, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._design(x)
        self.prior = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        self.weights = np.zeros(z.shape[1])
        self.weights[0] = self.prior
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (p - y) + penalty * self.weights
            bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            self.weights -= np.linalg.solve(bend, slope)

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.concatenate([np.ones((len(z), 1)), z, z * z], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.weights, -30, 30)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Logistic | None:
    """Fit on a bounded sample of labelled documents; None if it does not hold both labels."""
    marked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .mapInArrow(_featured, "quality int, features array<double>")
        .limit(2 * sample)
        .toArrow()
    )
    y = rows["quality"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    x = rows["features"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    order = np.lexsort([*x.T, y])  # the same sums whatever the order of arrival
    return Logistic(x[order], y[order])


_EVIDENCE = "doc_id long, copy long, host string, path string, n_words long, logit double"


@words.frugal
def _scored(batches: Iterator[pa.RecordBatch], model: Logistic | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            found = words.split(data, offsets)
            logit = model.logit(features(found)) if model else np.zeros(end - begin)
            logit = np.where(found.counts > 0, logit, -30.0)
            held = [batch.column(c)[begin:end] for c in ("doc_id", "copy", "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*held, pa.array(found.counts.astype(np.int64)), pa.array(logit)],
                ["doc_id", "copy", "host", "path", "n_words", "logit"],
            )


def _pull(groups: DataFrame, above: Column) -> float:
    """Documents that the level above is worth, from the spread of the groups' shares around it."""
    share, var = F.col("good") / F.col("n"), above * (1 - above)
    row = (
        groups.filter("n > 1")
        .agg(
            F.sum(F.col("n") * (share - above) ** 2).alias("between"),
            F.sum(var).alias("chance"),
            F.sum(F.col("n") * var).alias("scale"),
        )
        .first()
    )
    if not row.scale:
        return STRONGEST
    spread = max((row.between - row.chance) / row.scale, 1 / STRONGEST)  # share of variance between groups
    return min(max(1 / spread - 1, WEAKEST), STRONGEST)


def classify(
    docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None
) -> DataFrame:
    """(doc_id, copy, host, path, n_words, evidence, site_share, score, kept) for each row of ``docs``.

    ``host`` and ``path`` are expressions over ``docs``, by default its columns source and lang. Nulls are
    sites of their own. Texts without words (null, empty, blank) are rejected. Without usable labels the
    evidence is even and every document with words is kept. Rows that share a doc_id are scored each by
    its own text, whose hash is ``copy``. Extra columns are ignored.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    named = docs.select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("copy"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
    )
    model = fit(docs, labels)
    scored = frames.stored(
        named.mapInArrow(lambda b: _scored(b, model), _EVIDENCE),
        "evidence",
    )
    good = 1 / (1 + F.exp(-F.col("logit")))
    # Texts without words say nothing about their site. Decimals: the same sum whatever the order of rows.
    exact = F.sum(F.when(F.col("n_words") > 0, F.round(good, 9).cast("decimal(20,9)")).otherwise(0))
    paths = frames.stored(
        scored.groupBy("host", "path").agg(F.count_if(F.col("n_words") > 0).alias("n"), exact.cast("double").alias("good")), "paths"
    )
    hosts = frames.stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = min(max((total.good or 0) / (total.n or 1), 1e-6), 1 - 1e-6)
    host_pull = _pull(hosts, F.lit(share))
    host_share = (F.col("good") + host_pull * share) / (F.col("n") + host_pull)
    by_host = hosts.select("host", host_share.alias("host_share"))
    sites = paths.join(by_host, "host")
    path_pull = _pull(sites, F.col("host_share"))
    sites = frames.stored(sites.select("host", "path", "n", "good", "host_share"), "sites")
    others = F.greatest(F.col("n") - 1, F.lit(0))
    site_share = (F.greatest(F.col("good") - good, F.lit(0.0)) + path_pull * F.col("host_share")) / (others + path_pull)
    shift = F.log(F.col("site_share") / (1 - F.col("site_share"))) - math.log(share / (1 - share))
    shift = F.greatest(F.lit(-SITE_LOGIT), F.least(F.lit(SITE_LOGIT), shift))
    out = scored.join(frames.small(sites), ["host", "path"]).withColumn(
        "site_share", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), site_share))
    )
    return out.withColumn("score", F.col("logit") + shift).select(
        "doc_id", "copy", "host", "path", "n_words", F.col("logit").alias("evidence"), "site_share", "score",
        ((F.col("score") > -1e-9) & (F.col("n_words") > 0)).alias("kept"),
    )
