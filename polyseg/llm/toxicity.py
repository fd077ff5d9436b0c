"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

``P(grade <= k) = sigmoid(theta_k - w . x)`` with one weight vector for all ordered thresholds;
the output is the expected grade ``sum_k P(grade > k)``.  Features are the letter words (A-Z
lowered) that a document holds and their prefixes of 4, 5 and 6 bytes (stems), restricted to the ``FEATURES`` with the largest chi-square on
the labelled sample, each by its 64-bit hash, so words never share a weight.

The fit uses at most ``SAMPLE`` labelled documents (those of smallest seeded hash; documented
bound), whose word statistics are aggregated on the executors; the driver sees ``FEATURES``
words and the sample's rows restricted to them.  Scoring reads every whole text in one narrow
Arrow function: no shuffle, and the broadcast model is bounded by ``FEATURES``.

Labels that say only toxic or not are spread over three grades: toxic documents are split at
the median of how many strongly toxic words they hold per word (1: mild, 2: severe).

Defined cases: null or empty text has no features and gets the base severity; null labels are
ignored, of repeated labels the highest counts; without labels, or with one class only, every
severity is 0; ties in the sample's hash are broken by id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import kept, small_batches, table
from .textbatch import NON_LETTERS, U, distinct, pieces, word_hashes, words

SAMPLE = 10_000
FEATURES = 1_024
RIDGE = 3e-5
STEPS = 500
PREFIXES = (4, 5, 6)
#: A text is rejected from the chance of a toxic grade that this share of held-out clean texts stays under.
CLEAN = 0.999
HELD_OUT = 5


def text_features(column: pa.Array):
    """(first row, rows, words per row, [(hashes, row of each)]): letter words, then their prefixes, of pieces of a text column."""
    for first, n, data, off in pieces(column):
        s, e, wo = words(data, off, NON_LETTERS)
        row = np.repeat(np.arange(n), np.diff(wo))
        parts = [(word_hashes(data, s, e), row)]
        for k in PREFIXES:
            longer = e - s > k
            parts.append((word_hashes(data, s[longer], s[longer] + k) ^ U(k), row[longer]))
        yield first, n, np.diff(wo), parts


def _distinct_features(batches):
    for b in batches:
        for first, n, size, parts in text_features(b.column("text")):
            h, r = distinct(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]), n)
            found = pa.ListArray.from_arrays(pa.array(r, pa.int32()), pa.array(h.view(np.int64)))
            rest = [b.column(c).slice(first, n) for c in ("doc_id", "grade")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(size, pa.int64()), found], ["doc_id", "grade", "n", "ws"])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Proportional-odds model over sparse presence features, fitted by Adam on the mean log likelihood."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, theta: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.weights, self.theta, self.cut = hashes[order], weights[order], theta, 0.5
        self.hit = np.zeros(1 << 16, bool)
        self.hit[(self.hashes >> U(48)).astype(np.int64)] = True

    @classmethod
    def fit(cls, hashes: np.ndarray, indptr: np.ndarray, index: np.ndarray, grade: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> OrdinalModel:
        """CSR rows (indptr, index into hashes) with grades 0..K-1."""
        k, n, f = int(grade.max()) + 1, len(grade), len(hashes)
        row = np.repeat(np.arange(n), np.diff(indptr))
        share = np.clip(np.array([(grade <= i).mean() for i in range(k - 1)]), 1e-3, 1 - 1e-3)
        theta = np.log(share / (1 - share))
        # theta is kept ordered: the first threshold and the logarithms of the gaps
        par = np.concatenate([np.zeros(f), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
        m, v = np.zeros_like(par), np.zeros_like(par)
        for t in range(1, steps + 1):
            w = par[:f]
            th = par[f] + np.concatenate([[0.0], np.cumsum(np.exp(par[f + 1 :]))])
            s = np.bincount(row, w[index], n)
            c = np.concatenate([np.zeros((n, 1)), _sigmoid(th[None] - s[:, None]), np.ones((n, 1))], axis=1)
            hi, lo = c[np.arange(n), grade + 1], c[np.arange(n), grade]
            p = np.maximum(hi - lo, 1e-12)
            dh, dl = hi * (1 - hi), lo * (1 - lo)
            ds = (dh - dl) / p / n
            g_th = np.zeros(k + 1)
            np.add.at(g_th, grade + 1, -dh / p / n)
            np.add.at(g_th, grade, dl / p / n)
            g_th = g_th[1:k]
            tail = np.cumsum(g_th[::-1])[::-1]
            grad = np.concatenate([np.bincount(index, ds[row], f) + ridge * w, tail[:1], tail[1:] * np.exp(par[f + 1 :])])
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            par -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        th = par[f] + np.concatenate([[0.0], np.cumsum(np.exp(par[f + 1 :]))])
        return cls(hashes, par[:f], th)

    def scores(self, column: pa.Array) -> np.ndarray:
        """w . x of every text."""
        out = np.zeros(len(column))
        for first, n, _, parts in text_features(column):
            pairs = []
            for h, row in parts:
                at = np.flatnonzero(self.hit[(h >> U(48)).astype(np.int64)])
                pos = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
                true = self.hashes[pos] == h[at]
                pairs.append(row[at[true]] * len(self.hashes) + pos[true])
            pair = np.unique(np.concatenate(pairs))
            out[first : first + n] = np.bincount(pair // len(self.hashes), self.weights[pair % len(self.hashes)], n)
        return out

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return 1 - _sigmoid(self.theta[None] - score[:, None])


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, seed: int = 5) -> OrdinalModel | None:
    """labels(doc_id, grade): integer grades from 0; None if they don't tell two classes apart."""
    small_batches(docs.sparkSession)
    order = F.xxhash64(F.lit(seed), "doc_id")
    known = labels.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    known = known.orderBy(order, "doc_id").limit(sample)  # bounded by the parameter, so it may be broadcast
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").mapInArrow(_distinct_features, "doc_id long, grade int, n long, ws array<long>")
    held = kept(held)  # bounded by the sample; read three times below
    size = held.groupBy().agg(F.count("*"), F.count_if(F.col("grade") > 0)).first()
    n, n1 = size
    if not n1 or n1 == n:
        return None
    a = F.col("a").cast("double")
    b = F.col("d") - F.col("a")
    chi = n * F.pow(a * (n - n1 - b) - b * (n1 - a), 2) / ((a + b) * (n - a - b + 1e-9) * n1 * (n - n1))
    best = held.select("grade", F.explode("ws").alias("w")).groupBy("w").agg(F.count_if(F.col("grade") > 0).alias("a"), F.count("*").alias("d"))
    best = best.where("d > 1").withColumn("chi", chi).orderBy(F.desc("chi"), "w").limit(features).toPandas()
    if not len(best):
        return None
    hashes = np.sort(best["w"].to_numpy(np.int64).view(U))
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def chosen(batches):
        for b in batches:
            found = [np.intersect1d(ws.values.to_numpy().view(U), shared.value).view(np.int64) for ws in b.column("ws")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("grade"), b.column("n"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "grade", "n", "ws"])

    got = held.mapInArrow(chosen, "doc_id long, grade int, n long, ws array<long>").toPandas()
    got["first"], got["size"] = got["ws"].map(lambda x: x[0] if len(x) else 0), got["ws"].map(len)
    got = got.sort_values(["doc_id", "n", "size", "first"], ignore_index=True)  # the fit doesn't depend on how rows arrive
    grade = got["grade"].to_numpy(np.int64)
    sizes = got["ws"].map(len).to_numpy()
    flat = np.concatenate([np.asarray(x, np.int64) for x in got["ws"]]).view(U) if sizes.sum() else np.zeros(0, U)
    index = np.searchsorted(hashes, flat)
    if grade.max() == 1:
        odds = np.zeros(len(hashes))
        rate1, rate0 = (best["a"] + 0.5) / (n1 + 1), (best["d"] - best["a"] + 0.5) / (n - n1 + 1)
        odds[np.searchsorted(hashes, best["w"].to_numpy(np.int64).view(U))] = np.log(rate1 / rate0)
        row = np.repeat(np.arange(len(grade)), sizes)
        density = np.bincount(row, odds[index] > 3, len(grade)) / np.maximum(got["n"].to_numpy(), 1)
        toxic = grade == 1
        grade = np.where(toxic & (density > np.median(density[toxic])), 2, grade)
    _, grade = np.unique(grade, return_inverse=True)
    # every HELD_OUT-th row sets the cut, the others the weights
    held_out = np.arange(len(grade)) % HELD_OUT == 0
    row = np.repeat(np.arange(len(grade)), sizes)
    if len(np.unique(grade[~held_out])) <= grade.max():
        held_out[:] = False
    fitted = ~held_out
    model = OrdinalModel.fit(hashes, np.concatenate([[0], np.cumsum(sizes[fitted])]), index[fitted[row]], grade[fitted])
    place = np.searchsorted(model.hashes, hashes)
    score = np.bincount(row, model.weights[place][index], len(grade))
    clean = (grade == 0) & held_out
    if clean.any():
        model.cut = float(np.clip(np.quantile(model.above(score[clean])[:, 0], CLEAN), 0.08, 0.5))
    return model


def severity_column(spark: SparkSession, model: OrdinalModel | None):
    """A column function: text -> struct(severity, p_toxic, toxic)."""
    kind = "struct<severity:double,p_toxic:double,toxic:boolean>"
    if model is None:
        return lambda c: F.struct(F.lit(0.0).alias("severity"), F.lit(0.0).alias("p_toxic"), F.lit(False).alias("toxic"))
    shared = spark.sparkContext.broadcast(model)  # FEATURES hashes and weights

    def score(text: pa.Array) -> pa.Array:
        above = shared.value.above(shared.value.scores(text))
        return pa.StructArray.from_arrays([pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(above[:, 0] > shared.value.cut)], ["severity", "p_toxic", "toxic"])

    return F.arrow_udf(score, kind)


def with_severity(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``tox``: struct(severity, p_toxic, toxic) to every row."""
    small_batches(docs.sparkSession)
    model = fit_toxicity(docs.select("doc_id", F.col(text_col).alias("text")), labels)
    return docs.withColumn("tox", severity_column(docs.sparkSession, model)(F.col(text_col)))


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("grade"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_severity(table(spark, sf_dir, "documents").select("doc_id", "text"), toxic_labels(spark, sf_dir))
    return docs.select("doc_id", "tox.*")
