"""Quality classifier: document evidence combined with host and path posteriors.

Document level.  Two L1-penalised logistic regressions (low quality, toxic) on presence of
words and word beginnings, and on shape features (symbol, capital and repetition rates).
They are fitted on a bounded sample: at most ``SAMPLE_LABELLED`` labelled documents of smallest id hash, with
the ``VOCABULARY`` of these whose presence differs most between the classes.

Site level.  Hierarchical empirical Bayes: the rate of bad documents of a host is shrunk to
the global rate, the rate of a path to its host's.  Labelled documents count by label, all
others by the classifier's probability, so all documents take part.  The prior strengths
come from the data by moments: the less sites differ beyond chance, the stronger they are
drawn together; a site of a few documents stays near the level above.  Everything is
grouped sums with partial aggregation; a host with a third of all rows is one row per task.

A document's log odds are those of the classifier plus the difference between its path's
and the global log odds.  It is rejected if either head's probability is 0.5 or more.

Defined cases: null and empty texts have no words (shape only); null hosts and paths are a
site of their own; no labels, or one class only, give a head that rejects nothing; several
labels of one id count as the worst; repeated rows are scored each; an empty table gives an
empty result; only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, ship, store, table
from .phrase_index import words

SAMPLE_LABELLED = 20_000
VOCABULARY = 4_000
MIN_DOCS = 4
#: lengths in bytes of the word beginnings; inflected forms share them
BEGINNINGS = (4, 5, 6)
HEADS = ("low", "toxic")
PENALTY = 5e-5
#: bounds of the prior strengths, in documents
WEAKEST, STRONGEST = 5.0, 10_000.0
CLIP = 1e-6

_SYMBOLS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_STEPS = (0.05, 0.2, 0.5)


def shape_features(raw: bytes, found: list[bytes]) -> list[int]:
    """Numbers of the shape features that hold, all below ``N_SHAPE``."""
    n = max(1, len(found))
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    letters = max(1, int(codes[0x41:0x5B].sum() + codes[0x61:0x7B].sum()))
    rates = [codes[c] / n for c in _SYMBOLS]
    rates.append(codes[0x41:0x5B].sum() / letters)
    rates.append(sum(a == b for a, b in zip(found, found[1:])) / n)
    rates.append(sum(rates[: len(_SYMBOLS)]) / 4)
    out = [i * len(_STEPS) + k for i, r in enumerate(rates) for k, s in enumerate(_STEPS) if r >= s]
    return out + [N_RATES * len(_STEPS) + min(15, len(found).bit_length())]


N_RATES = len(_SYMBOLS) + 3
N_SHAPE = N_RATES * len(_STEPS) + 16


def _read(text: str | None) -> tuple[bytes, list[bytes]]:
    return (text or "").encode("utf-8", "surrogatepass"), words(text)


def present(found: list[bytes]) -> set[bytes]:
    """Distinct words of a text and, marked by ^, the beginnings of longer words."""
    own = set(found)
    return own | {b"^" + w[:k] for w in own for k in BEGINNINGS if len(w) > k}


def _vocabulary(sample: DataFrame) -> list[bytes]:
    """The words whose presence differs most between the classes of either head (bounded)."""

    def distinct(batches):
        for b in batches:
            keys, low, toxic = [], [], []
            for text, x, y in zip(b.column(0), b.column(1), b.column(2)):
                own = present(words(text.as_py()))
                keys += own
                low += [x.as_py()] * len(own)
                toxic += [y.as_py()] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(low, pa.int32()), pa.array(toxic, pa.int32())], ["word", "low", "toxic"])

    n = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(h) for h in HEADS]).first()
    if not n["n"]:
        return []
    counts = sample.select("text", *HEADS).mapInArrow(released(distinct), "word binary, low int, toxic int").groupBy("word").agg(
        F.count(F.lit(1)).alias("docs"), *[F.sum(h).alias(h) for h in HEADS]).filter(F.col("docs") >= MIN_DOCS)

    def score(head: str) -> Column:
        p = (n[head] or 0) / n["n"]
        return F.abs(F.col(head) - F.col("docs") * p) / F.sqrt(F.col("docs") * max(p * (1 - p), CLIP))

    best = counts.withColumn("score", F.greatest(*[score(h) for h in HEADS]))
    rows = best.orderBy(F.desc("score"), "word").limit(VOCABULARY).select("word").collect()
    return [bytes(r["word"]) for r in rows]


def _vectors(sample: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    place = {w: N_SHAPE + i for i, w in enumerate(vocabulary)}
    size = N_SHAPE + len(vocabulary)

    def features(batches):
        for b in batches:
            out = []
            for text in b.column(0):
                raw, found = _read(text.as_py())
                out.append(sorted(set(shape_features(raw, found)) | {place[w] for w in place.keys() & present(found)}))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.list_(pa.int32())), b.column(1), b.column(2)], ["found", *HEADS])

    vector = F.udf(lambda found: SparseVector(size, found, [1.0] * len(found)), VectorUDT())
    rows = sample.select("text", *HEADS).mapInArrow(released(features), "found array<int>, low int, toxic int")
    return rows.select(vector("found").alias("features"), *[F.col(h).cast("double").alias(h) for h in HEADS])


class Model:
    """Weights of both heads; small and of bounded size, so it travels with the tasks."""

    def __init__(self, vocabulary: list[bytes], weights: np.ndarray, bias: list[float]):
        keep = np.abs(weights).sum(axis=1) > 0
        self.shape = weights[:N_SHAPE]
        self.words = {w: weights[N_SHAPE + i] for i, w in enumerate(vocabulary) if keep[N_SHAPE + i]}
        self.bias = np.array(bias)

    def log_odds(self, text: str | None) -> np.ndarray:
        raw, found = _read(text)
        z = self.bias + self.shape[shape_features(raw, found)].sum(axis=0)
        for w in self.words.keys() & present(found):
            z = z + self.words[w]
        return z


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model:
    """Fit both heads on the bounded sample of labelled documents."""
    worst = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 0).cast("int")).alias("low"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    chosen = worst.na.fill(0, list(HEADS)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_LABELLED)
    # at most SAMPLE_LABELLED rows of three numbers: small enough to broadcast at any input size
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("label_id"), *HEADS))
    sample = docs.select(F.col(id_col).alias("doc_id"), "text").join(chosen, F.col("doc_id") == F.col("label_id"))
    sample = store(spark, sample.select("text", *HEADS), "labelled-sample")
    vocabulary = _vocabulary(sample)
    rows = store(spark, _vectors(sample, vocabulary), "labelled-vectors")
    n = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(h) for h in HEADS]).first()
    weights, bias = np.zeros((N_SHAPE + len(vocabulary), 2)), [math.log(CLIP)] * 2
    for k, head in enumerate(HEADS):
        if n["n"] and 0 < (n[head] or 0) < n["n"]:
            lr = LogisticRegression(labelCol=head, featuresCol="features", regParam=PENALTY, elasticNetParam=1.0,
                                    standardization=False, maxIter=60)
            m = lr.fit(rows)
            weights[:, k], bias[k] = m.coefficients.toArray(), m.intercept
    return Model(vocabulary, weights, bias)


def _log_odds(p: Column) -> Column:
    p = F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), p))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, bad: str, mean: Column) -> float:
    """Prior strength by moments: how many documents' worth of evidence the upper level is."""
    rate = F.col(bad) / F.col("n")
    row = groups.agg(
        (F.sum(F.col("n") * (rate - mean) ** 2) / F.sum("n")).alias("seen"),
        (F.sum(mean * (1 - mean)) / F.sum("n")).alias("chance"),
        (F.sum(F.col("n") * mean * (1 - mean)) / F.sum("n")).alias("spread")).first()
    beyond = (row["seen"] or 0.0) - (row["chance"] or 0.0)
    if beyond <= 0:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, (row["spread"] or 0.0) / beyond - 1))


def site_rates(rows: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Posterior bad rates by (host, path) and the global rates.

    ``rows`` has host, path and, per head, the label or the classifier's probability.
    """
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(h) for h in HEADS])
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(h).alias(h) for h in HEADS])
    total = hosts.agg(F.sum("n").alias("n"), *[F.sum(h).alias(h) for h in HEADS]).first()
    rate = {h: (total[h] or 0.0) / total["n"] if total["n"] else CLIP for h in HEADS}
    h_cols, p_cols = [], []
    for h in HEADS:
        s = _strength(hosts, h, F.lit(rate[h]))
        h_cols.append(((F.col(h) + s * rate[h]) / (F.col("n") + s)).alias(f"host_{h}"))
    hosts = hosts.select(F.col("host").alias("h_host"), *h_cols)
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("h_host")))
    for h in HEADS:
        s = _strength(paths, h, F.col(f"host_{h}"))
        p_cols.append(((F.col(h) + s * F.col(f"host_{h}")) / (F.col("n") + s)).alias(f"path_{h}"))
    return paths.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), *p_cols), rate


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, host: Iterable[str] = ("source", "lang")) -> DataFrame:
    """(doc_id, p_doc_*, site_*, p_*, kept) for every row; ``host`` names host and path columns."""
    ship(spark)
    host_col, path_col = host
    model = fit(spark, docs, labels)

    def score(batches):
        for b in batches:
            z = np.array([model.log_odds(t.as_py()) for t in b.column(3)]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(z[:, 0]), pa.array(z[:, 1])],
                                             ["doc_id", "host", "path", "z_low", "z_toxic"])

    scored = docs.select(F.col("doc_id").cast("bigint"), F.col(host_col).cast("string").alias("host"),
                         F.col(path_col).cast("string").alias("path"), "text")
    scored = store(spark, scored.mapInArrow(
        released(score), "doc_id bigint, host string, path string, z_low double, z_toxic double"), "doc-evidence")
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(
        F.max((F.col("quality") == 0).cast("double")).alias("y_low"), F.max((F.col("toxic") == 1).cast("double")).alias("y_toxic"))
    sure = lambda h: F.coalesce(F.col(f"y_{h}"), 1 / (1 + F.exp(-F.col(f"z_{h}")))).alias(h)
    evidence = scored.join(known, F.col("doc_id") == F.col("label_id"), "left")
    sites, rate = site_rates(evidence.select("host", "path", *[sure(h) for h in HEADS]))
    sites = store(spark, sites, "site-rates")
    rows = scored.join(sites, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    for h in HEADS:
        z = F.col(f"z_{h}") + _log_odds(F.col(f"path_{h}")) - _log_odds(F.lit(rate[h]))
        rows = rows.withColumn(f"p_{h}", 1 / (1 + F.exp(-z)))
    return rows.select(
        "doc_id", F.col("path_low").alias("site_low"), F.col("path_toxic").alias("site_toxic"), "p_low", "p_toxic",
        ((F.col("p_low") < 0.5) & (F.col("p_toxic") < 0.5)).alias("kept"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
