"""Operator 5, quality classifier: Bradley-Terry ranking of preference pairs.

``text_features`` turns every whole text into a fixed vector of shape measures (word
lengths, repetition, symbols, lines, byte statistics). ``fit`` takes labelled rows as
preferences (a document of label 1 beats one of label 0): with s(x) = w . z(x) the model
is P(a beats b) = 1 / (1 + exp(s(b) - s(a))), fitted by logistic loss on feature
differences. z are one-hot quantile bins of each measure, so the score is additive and
monotone effects need not be assumed. Scores are then mapped to 0..1 so that ``CUT``
lies at the score quantile that equals the share of label 0 among the labelled rows
(refined to the midpoint of the widest gap nearby), with a logistic slope fitted on the
same rows.

The labelled sample is bounded: the first ``MAX_LABELLED`` rows by a hash of the id; the
bound is a parameter. Scoring reads all documents. Labels, language, source, ids and any
other column never enter a score.

Defined cases: null and empty texts have the measures of a text without words and get a
score like any other; labels that are null or disagree for one id (after averaging, 0.5)
are left out; without rows of both labels every score is 0.5; repeated rows score alike;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from .arrowmap import map_texts
from .words import LOWER, NOT_SPACE, prefix_hash, span_hash, spans

CUT = 0.3
MAX_LABELLED, MAX_PAIRS, BINS = 20_000, 100_000, 12

_IS = np.zeros((256, 8), dtype=np.uint8)
_IS[0x41:0x5B, 0] = 1  # upper case
_IS[0x30:0x3A, 1] = 1  # digits
_IS[[0x2E, 0x2C, 0x3A, 0x3B, 0x21, 0x3F], 2] = 1  # sentence marks
_IS[[*range(0x23, 0x27), 0x2A, 0x2B, 0x3C, 0x3D, 0x3E, 0x40, *range(0x5B, 0x61), *range(0x7B, 0x7F)], 3] = 1  # symbols
_IS[0x0A, 4] = 1  # newlines
_IS[0x80:, 5] = 1  # beyond ASCII
_IS[0x20, 6] = 1
_IS[[0x61, 0x65, 0x69, 0x6F, 0x75], 7] = 1  # vowels

MEASURES = ("log_bytes", "log_words", "upper", "digits", "marks", "symbols", "newlines", "wide", "spaces", "vowels",
            "word_length", "word_spread", "distinct", "top_word", "repeats", "distinct_pairs", "top_pair",
            "odd_words", "distinct_lines", "line_words")
_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[0x0A] = False


def _distinct(key: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct keys, and occurrences of the most frequent one, per document."""
    if not len(key):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])]
    at = np.flatnonzero(new)
    runs = np.diff(np.r_[at, len(k)])
    top = np.zeros(n)
    np.maximum.at(top, d[at], runs)
    return np.bincount(d[at], minlength=n).astype(float), top


def measure(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """documents x MEASURES."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    out = np.zeros((n, len(MEASURES)))
    out[:, 0] = np.log1p(size)
    for j in range(8):
        total = np.r_[0, np.cumsum(_IS[:, j][raw], dtype=np.int64)]
        out[:, 2 + j] = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)
    low = LOWER[raw]
    start, end, doc = spans(low, offsets, NOT_SPACE)
    words = np.bincount(doc, minlength=n).astype(float)
    out[:, 1] = np.log1p(words)
    some = np.maximum(words, 1)
    if len(start):
        length = (end - start).astype(float)
        mean = np.bincount(doc, length, n) / some
        out[:, 10] = mean
        out[:, 11] = np.sqrt(np.maximum(np.bincount(doc, length**2, n) / some - mean**2, 0))
        prefix = prefix_hash(low)
        h = span_hash(prefix, start, end)
        kinds, top = _distinct(h, doc, n)
        out[:, 12], out[:, 13] = kinds / some, top / some
        same = doc[1:] == doc[:-1]
        out[:, 14] = np.bincount(doc[1:], same & (h[1:] == h[:-1]), n) / some
        pair = (h[:-1] * np.uint64(3) + h[1:])[same]
        kinds, top = _distinct(pair, doc[1:][same], n)
        pairs = np.maximum(words - 1, 1)
        out[:, 15], out[:, 16] = kinds / pairs, top / pairs
        total = np.r_[0, np.cumsum(_IS[:, 3][raw] | _IS[:, 1][raw], dtype=np.int64)]
        out[:, 17] = np.bincount(doc, total[end] > total[start], n) / some
        ls, le, ld = spans(low, offsets, _NOT_NEWLINE)
        kinds, _ = _distinct(span_hash(prefix, ls, le), ld, n)
        lines = np.maximum(np.bincount(ld, minlength=n), 1)
        out[:, 18], out[:, 19] = kinds / lines, np.log1p(words / lines)
    return out


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features): the measures of every whole text, in the order of MEASURES."""
    return map_texts(docs, id_col, text_col, [StructField("features", ArrayType(DoubleType()))],
                     lambda raw, offsets: [list(measure(raw, offsets))])


@dataclass(frozen=True)
class Model:
    """Bin edges (measures x (BINS - 1)), weights (measures x BINS), and the map to 0..1."""

    edges: np.ndarray
    weights: np.ndarray
    centre: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        s = np.zeros(len(x))
        for j in range(x.shape[1]):
            s += self.weights[j][np.searchsorted(self.edges[j], x[:, j], side="right")]
        return s

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.raw(x) - self.centre) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, max_pairs: int = MAX_PAIRS, bins: int = BINS, seed: int = 0, l2: float = 1e-3, steps: int = 200) -> Model | None:
    """Bradley-Terry model of labelled rows; None without both labels."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    m = x.shape[1]
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    # quantiles of both labels, so that the rarer one shapes the bins as much
    edges = np.sort(np.concatenate([np.quantile(x[good], cuts[::2], axis=0), np.quantile(x[bad], cuts[::2], axis=0)]).T, axis=1)
    width = edges.shape[1] + 1
    bin_of = np.stack([np.searchsorted(edges[j], x[:, j], side="right") + j * width for j in range(m)], axis=1)
    rng = np.random.default_rng(seed)
    n = min(max_pairs, 20 * (len(good) + len(bad)))
    a, b = rng.choice(good, n), rng.choice(bad, n)
    # mean logistic loss of s(a) - s(b), by Adagrad on the whole batch
    w, seen = np.zeros(m * width), np.full(m * width, 1e-8)
    fa, fb = bin_of[a], bin_of[b]
    for _ in range(steps):
        margin = w[fa].sum(1) - w[fb].sum(1)
        miss = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
        g = l2 * w
        pull = np.repeat(miss / n, m)
        g -= np.bincount(fa.ravel(), pull, m * width) - np.bincount(fb.ravel(), pull, m * width)
        seen += g * g
        w -= 0.3 * g / np.sqrt(seen)
    weights = w.reshape(m, width)
    s = np.sort(w[bin_of].sum(1))
    at = int(round(len(bad) / len(y) * len(s)))
    # the widest gap between neighbouring scores within a tenth of the rejected share around the quantile
    near = max(1, len(bad) // 10)
    lo, hi = max(1, at - near), min(len(s) - 1, at + near)
    k = lo + int(np.argmax(s[lo:hi + 1] - s[lo - 1:hi])) if hi >= lo else min(at, len(s) - 1)
    centre = float((s[k] + s[max(k - 1, 0)]) / 2)
    margin = w[bin_of].sum(1) - centre
    slope = 1.0
    for _ in range(100):  # one-dimensional logistic fit of the slope
        p = 1 / (1 + np.exp(-np.clip(slope * margin + np.log(CUT / (1 - CUT)), -30, 30)))
        step = ((p - y) * margin).sum() / max(1e-9, (p * (1 - p) * margin**2).sum() + 1e-3)
        slope = float(np.clip(slope - np.clip(step, -0.5, 0.5), 0.05, 5.0))
    return Model(edges, weights, centre, slope)


def labelled_sample(labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", label_col: str = "quality",
                    limit: int = MAX_LABELLED) -> DataFrame:
    """(id, label) of at most ``limit`` labelled ids, the first by a hash of the id."""
    rows = labels.select(F.col(id_col), F.col(label_col).cast("double").alias("label"))
    rows = rows if keep is None else rows.filter(keep)
    rows = rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.avg("label").alias("label")).filter(F.col("label").isin(0.0, 1.0))
    return rows.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(limit)


def train(docs: DataFrame, labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", limit: int = MAX_LABELLED) -> Model | None:
    """Fit on a bounded sample of the labelled documents (at most ``limit`` rows reach the driver)."""
    sample = labelled_sample(labels, keep, id_col, label_col, limit)
    chosen = docs.select(id_col, text_col).join(F.broadcast(sample.select(id_col)), id_col, "left_semi")
    rows = text_features(chosen, id_col, text_col).join(sample, id_col).orderBy(id_col, "features").limit(2 * limit).select("features", "label").collect()
    if not rows:
        return None
    return fit(np.array([r.features for r in rows]), np.array([r.label for r in rows]))


def scorer(model: Model | None):
    """Scores of whole texts, for ``map_texts``."""
    def fn(raw, offsets):
        if model is None:
            return [np.full(len(offsets) - 1, 0.5)]
        return [model.score(measure(raw, offsets))]

    return fn


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): 0 to 1, higher: label 1 likelier."""
    return map_texts(docs, id_col, text_col, [StructField("score", DoubleType())], scorer(model))


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Ids kept from training: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.encode(id_column.cast("string"), "UTF-8")) % folds == 0, F.lit(False))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document scored by a model that never saw the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels, keep=~held_out(F.col("doc_id")))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
