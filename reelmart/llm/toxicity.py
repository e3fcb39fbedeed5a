"""Operator 13, toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is lower-cased (A-Z) and cut into words; overlapping windows of ``WINDOW`` words,
``STRIDE`` apart, cover all of it, and the score of the text is its highest window's. In a
window every word enters as the vector of the word and the mean vector of its character
trigrams (with marks for its begin and end), so a word never seen is judged by its
characters. Two gated recurrent layers read the window forwards and backwards, attention
over their states pools it, and a logistic unit scores the pooled state.

``train`` fits the network on a bounded sample of labelled rows (``MAX_OF_LABEL`` of each
label, texts of at most ``TRAIN_BYTES`` bytes; parameters). Labels are of whole texts, so
which window of a toxic text is the toxic one is learned as well: first the one with the
word most typical of label 1, then, in each round, the one that the network scores highest,
weighted by that score, so that texts labelled toxic without any toxic window lose weight.
Negatives are the highest-scored windows of clean texts and windows drawn at random. The
scale of the document scores is a logistic fit on the same sample. Labels, language, source
and ids never enter a score.

Defined cases: null and empty texts, and texts without words, are one window of padding and
get its score; labels that are null or disagree for one id are left out; without labelled
rows of both kinds every score is 0.5; repeated rows score alike; an empty table gives an
empty result; texts of any length are scored whole, windows in batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .arrowmap import map_texts
from .quality import held_out
from .words import ALNUM, LOWER, BYTE_VALUE, U64, mix, prefix_hash, span_hash, spans

CUT = 0.5
WINDOW, STRIDE = 16, 8
MAX_OF_LABEL, TRAIN_BYTES = 2_000, 1 << 14
WORD_DIM, CHAR_DIM, HIDDEN, LOOK = 8, 8, 8, 8
MAX_WORDS, TRIGRAMS, MIN_DOCS = 20_000, 4_096, 3
ROUNDS, STEPS, BATCH = 3, 60, 256
_SCORE_BATCH = 4_096
_PAD = -1


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct word hashes, trigram buckets of all distinct words, first trigram of each, index of every word, its document)."""
    low = LOWER[raw]
    start, end, doc = spans(low, offsets, ALNUM)
    if not len(start):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z, doc
    kinds, first, index = np.unique(span_hash(prefix_hash(low), start, end), return_index=True, return_inverse=True)
    s, e = start[first], end[first]
    # characters of the distinct words, each between a begin mark and an end mark; as many trigrams as characters
    size = e - s
    cut = np.r_[0, np.cumsum(size + 2)]
    marked = np.zeros(cut[-1], np.uint64)
    at = np.repeat(s - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    marked[np.arange(size.sum()) + np.repeat(2 * np.arange(len(s)) + 1, size)] = BYTE_VALUE[low[at]]
    gram = mix(marked[:-2] * U64(9) + marked[1:-1] * U64(3) + marked[2:]) % U64(TRIGRAMS) if len(marked) > 2 else np.zeros(0, np.uint64)
    inside = np.arange(size.sum()) + np.repeat(2 * np.arange(len(s)), size)
    return kinds, gram[inside].astype(np.int64), np.r_[0, np.cumsum(size)[:-1]], index, doc


def windows_of(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of words, document) of every window; each document has one at least."""
    count = np.bincount(doc, minlength=n)
    first = np.r_[0, np.cumsum(count)[:-1]]
    more = np.maximum(0, -(-(count - WINDOW) // STRIDE)) + 1
    of = np.repeat(np.arange(n), more)
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    begin = np.minimum(step * STRIDE, np.maximum(count[of] - WINDOW, 0))  # the last one ends with the text
    return first[of] + begin, np.minimum(count[of], WINDOW), of


def add_rows(n: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows that share a place, for n places."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(at):
        order = np.argsort(at, kind="stable")
        places, start = np.unique(at[order], return_index=True)
        out[places] = np.add.reduceat(rows[order], start, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights by name; ``words``: sorted hashes of the words with a vector of their own (row 0 is for all others)."""

    words: np.ndarray
    w: dict[str, np.ndarray]
    scale: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def new(cls, words: np.ndarray, seed: int = 0) -> Network:
        r = np.random.default_rng(seed)
        d = WORD_DIM + CHAR_DIM

        def draw(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        w = {"word": (0.1 * r.standard_normal((len(words) + 1, WORD_DIM))).astype(np.float32),
             "gram": (0.3 * r.standard_normal((TRIGRAMS, CHAR_DIM))).astype(np.float32)}
        for side in "fb":  # forwards and backwards; gates in the order update, reset, candidate
            w[f"in_{side}"], w[f"rec_{side}"] = draw(d, 3 * HIDDEN), draw(HIDDEN, 3 * HIDDEN)
            w[f"bias_{side}"] = np.zeros(3 * HIDDEN, np.float32)
        w["look"], w["ask"] = draw(2 * HIDDEN, LOOK), draw(LOOK)
        w["out"], w["out_bias"] = draw(2 * HIDDEN), np.zeros(1, np.float32)
        w["word"][0] = 0
        return cls(words, w)

    def rows(self, kinds: np.ndarray) -> np.ndarray:
        """Row of each word hash in the table of word vectors."""
        if not len(self.words):
            return np.zeros(len(kinds), np.int64)
        at = np.minimum(np.searchsorted(self.words, kinds), len(self.words) - 1)
        return np.where(self.words[at] == kinds, at + 1, 0)

    def vectors(self, kinds, grams, starts) -> np.ndarray:
        """Input vector of every distinct word; one more row of zeros is the padding (index -1)."""
        out = np.zeros((len(kinds) + 1, WORD_DIM + CHAR_DIM), np.float32)
        if len(kinds):
            out[:-1, :WORD_DIM] = self.w["word"][self.rows(kinds)]
            size = np.diff(np.r_[starts, len(grams)])
            out[:-1, WORD_DIM:] = np.add.reduceat(self.w["gram"][grams], starts, axis=0) / size[:, None]
        return out

    def _recur(self, side: str, gates: np.ndarray, index: np.ndarray, there: np.ndarray, keep: list | None) -> np.ndarray:
        """States (steps, windows, HIDDEN) of one direction. ``gates``: input part of the gates of every distinct word."""
        n, steps = index.shape
        rec = self.w[f"rec_{side}"]
        h = np.zeros((n, HIDDEN), np.float32)
        states = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else reversed(range(steps)):
            g = gates[index[:, t]]
            own = h @ rec
            zr = _sigmoid(g[:, :2 * HIDDEN] + own[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN:] + r * own[:, 2 * HIDDEN:])
            here = there[:, t:t + 1]
            after = h + here * (1 - z) * (new - h)
            if keep is not None:
                keep.append((t, h, z, r, new, own[:, 2 * HIDDEN:], here))
            states[t] = h = after
        return states

    def forward(self, vectors: np.ndarray, index: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logit of each window; ``index``: windows x words, -1 where the window is shorter."""
        there = (index != _PAD).astype(np.float32)
        keep = {"f": [], "b": []} if trace is not None else {"f": None, "b": None}
        both = [self._recur(s, vectors @ self.w[f"in_{s}"] + self.w[f"bias_{s}"], index, there, keep[s]) for s in "fb"]
        states = np.concatenate(both, axis=2)
        seen = np.tanh(states @ self.w["look"])
        ask = seen @ self.w["ask"] + (there.T - 1) * 30  # padding has next to no weight
        share = np.exp(ask - ask.max(axis=0))
        share /= share.sum(axis=0)
        pooled = (share[:, :, None] * states).sum(axis=0)
        if trace is not None:
            trace.update(keep=keep, states=states, seen=seen, share=share, pooled=pooled)
        return pooled @ self.w["out"] + self.w["out_bias"][0]

    def backward(self, vectors: np.ndarray, index: np.ndarray, trace: dict, pull: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients by name and of the word vectors, where ``pull`` is the loss's gradient by each logit."""
        g = {"out": trace["pooled"].T @ pull, "out_bias": pull.sum(keepdims=True)}
        states, seen, share = trace["states"], trace["seen"], trace["share"]
        d_pooled = pull[:, None] * self.w["out"]
        d_share = (states * d_pooled).sum(axis=2)
        d_ask = share * (d_share - (share * d_share).sum(axis=0))
        d_states = share[:, :, None] * d_pooled
        g["ask"] = np.einsum("tnk,tn->k", seen, d_ask)
        d_seen = d_ask[:, :, None] * self.w["ask"] * (1 - seen**2)
        g["look"] = np.einsum("tnd,tnk->dk", states, d_seen)
        d_states += d_seen @ self.w["look"].T
        d_vectors = np.zeros_like(vectors)
        for k, side in enumerate("fb"):
            rec, d_rec = self.w[f"rec_{side}"], np.zeros_like(self.w[f"rec_{side}"])
            each = np.empty((index.shape[1], len(index), 3 * HIDDEN), np.float32)
            own_d = d_states[:, :, k * HIDDEN:(k + 1) * HIDDEN]
            d_h = np.zeros_like(own_d[0])
            for t, h, z, r, new, own, here in reversed(trace["keep"][side]):
                d_after = d_h + own_d[t]
                d_new = d_after * here * (1 - z) * (1 - new**2)
                d_z = -d_after * here * (new - h) * z * (1 - z)
                d_r = d_new * own * r * (1 - r)
                d_g = np.concatenate([d_z, d_r, d_new], axis=1)
                d_own = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_rec += h.T @ d_own
                d_h = d_after * (1 - here * (1 - z)) + d_own @ rec.T
                each[t] = d_g
            d_gates = add_rows(len(vectors), index.T.ravel() % len(vectors), each.reshape(-1, 3 * HIDDEN))
            g[f"rec_{side}"], g[f"bias_{side}"] = d_rec, d_gates.sum(axis=0)
            g[f"in_{side}"] = vectors.T @ d_gates
            d_vectors += d_gates @ self.w[f"in_{side}"].T
        d_vectors[-1] = 0  # the padding
        return g, d_vectors

    def window_logits(self, vectors: np.ndarray, index: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Logits of the windows, ``_SCORE_BATCH`` at a time."""
        out = np.empty(len(first), np.float32)
        for a in range(0, len(first), _SCORE_BATCH):
            b = min(len(first), a + _SCORE_BATCH)
            out[a:b] = self.forward(vectors, window_index(index, first[a:b], size[a:b]))
        return out

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of every whole text: its highest window's, on the fitted scale."""
        n = len(offsets) - 1
        kinds, grams, starts, index, doc = words_of(raw, offsets)
        first, size, of = windows_of(doc, n)
        logits = self.window_logits(self.vectors(kinds, grams, starts), index, first, size)
        best = np.full(n, -np.inf)
        np.maximum.at(best, of, logits)
        slope, shift = self.scale
        return 1 / (1 + np.exp(-np.clip(slope * best + shift, -50, 50)))


def window_index(index: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """windows x WINDOW: the distinct word at each place, -1 beyond the window's end."""
    at = first[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    if not len(index):
        return np.full(at.shape, _PAD)
    return np.where(inside, index[np.minimum(at, len(index) - 1)], _PAD)


class Adam:
    def __init__(self, rate: float = 0.01) -> None:
        self.rate, self.steps, self.mean, self.square = rate, 0, {}, {}

    def apply(self, w: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for name, d in g.items():
            m = self.mean.setdefault(name, np.zeros_like(w[name]))
            s = self.square.setdefault(name, np.zeros_like(w[name]))
            m += 0.1 * (d - m)
            s += 0.001 * (d * d - s)
            w[name] -= self.rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.999**self.steps)) + 1e-6)


def typical(index: np.ndarray, doc: np.ndarray, n_kinds: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents with each distinct word, how much more typical of label 1 it is, in standard errors)."""
    seen = np.unique(index * len(y) + doc)
    kind, label = seen // len(y), y[seen % len(y)] == 1
    ones, total = np.bincount(kind, label, n_kinds), np.bincount(kind, minlength=n_kinds)
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    p = total / (n1 + n0)
    return total, (ones / n1 - (total - ones) / n0) / np.sqrt(np.maximum(p * (1 - p) * (1 / n1 + 1 / n0), 1e-12))


def fit(texts: list[bytes], y: np.ndarray, seed: int = 0, rounds: int = ROUNDS, steps: int = STEPS) -> Network | None:
    """A network for labelled texts; None without both labels."""
    if not (y == 1).any() or not (y == 0).any():
        return None
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    kinds, grams, starts, index, doc = words_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    first, size, of = windows_of(doc, len(texts))
    held, lean = typical(index, doc, len(kinds), y)
    common = np.flatnonzero(held >= MIN_DOCS)
    common = common[np.argsort(-held[common], kind="stable")][:MAX_WORDS]
    net = Network.new(np.sort(kinds[common]), seed)
    rng = np.random.default_rng(seed)
    # words of few documents have no vector of their own and give no first evidence
    lean = np.r_[np.where(held >= MIN_DOCS, lean, 0.0), -np.inf]
    own = net.rows(kinds)
    net.w["word"][own[own > 0], 0] = np.clip(lean[:-1][own > 0] / 5, -2, 4)  # a word vector starts from what its labels say
    evidence = np.concatenate([lean[window_index(index, first[a:a + 50_000], size[a:a + 50_000])].max(axis=1) for a in range(0, len(first), 50_000)])
    evidence = np.where(np.isfinite(evidence), evidence, 0.0)
    toxic, clean = np.flatnonzero(y[of] == 1), np.flatnonzero(y[of] == 0)
    rows, n_grams = own, np.diff(np.r_[starts, len(grams)])
    adam = Adam()
    # a text whose most typical word is not beyond what clean texts show is trusted less
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, of, evidence)
    prior = _sigmoid(np.clip(top - np.quantile(top[y == 0], 0.95), -30, 30))
    trust = np.maximum(prior, 0.02).astype(np.float32)
    for _ in range(rounds):
        best = toxic[np.lexsort((rng.random(len(toxic)), -evidence[toxic], of[toxic]))]
        best = best[np.r_[True, of[best][1:] != of[best][:-1]]]
        hard = clean[np.argsort(-evidence[clean], kind="stable")[:len(best)]]
        some = rng.choice(clean, min(len(clean), 3 * len(best)), replace=False)
        chosen = np.r_[best, hard, some]
        want = np.r_[np.ones(len(best)), np.zeros(len(hard) + len(some))].astype(np.float32)
        weight = np.r_[trust[of[best]], np.ones(len(hard) + len(some))].astype(np.float32)
        order = np.concatenate([rng.permutation(len(chosen)) for _ in range(-(-steps * BATCH // len(chosen)))])
        for a in range(0, steps * BATCH, BATCH):
            b = order[a:a + BATCH]
            at = window_index(index, first[chosen[b]], size[chosen[b]])
            # only the batch's distinct words are looked up and moved
            local, places = np.unique(at, return_inverse=True)
            places = places.reshape(at.shape)
            if local[0] == _PAD:
                local, places = local[1:], places - 1
            g_at = np.repeat(starts[local] - np.r_[0, np.cumsum(n_grams[local])[:-1]], n_grams[local]) + np.arange(n_grams[local].sum())
            g_of = np.repeat(np.arange(len(local)), n_grams[local])
            vectors = net.vectors(kinds[local], grams[g_at], np.r_[0, np.cumsum(n_grams[local])[:-1]].astype(np.int64)[:len(local)])
            trace: dict = {}
            logits = net.forward(vectors, places, trace)
            pull = weight[b] * (_sigmoid(logits) - want[b]) / len(b)
            g, d = net.backward(vectors, places, trace, pull.astype(np.float32))
            g["word"] = add_rows(len(net.w["word"]), rows[local], d[:-1, :WORD_DIM]) + 1e-4 * net.w["word"] / len(b)
            g["word"][0] = 0
            each = (d[:-1, WORD_DIM:] / np.maximum(n_grams[local], 1)[:, None]).astype(np.float32)
            g["gram"] = add_rows(TRIGRAMS, grams[g_at], each[g_of]) + 1e-4 * net.w["gram"] / len(b)
            adam.apply(net.w, g)
        evidence = net.window_logits(net.vectors(kinds, grams, starts), index, first, size).astype(float)
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, of, evidence)
        trust = np.maximum(prior * _sigmoid(top), 0.02).astype(np.float32)
    net.scale = _logistic(top, (y == 1).astype(float))
    return net


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of a one-dimensional logistic fit by Newton steps; the slope stays positive."""
    x = np.clip(x, -30, 30)
    v = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(v[0] * x + v[1], -30, 30)))
        g = np.array([((p - y) * x).sum() + 1e-2 * (v[0] - 1), (p - y).sum()])
        c = p * (1 - p)
        h = np.array([[(c * x * x).sum() + 1e-2, (c * x).sum()], [(c * x).sum(), c.sum() + 1e-6]])
        v = v - np.clip(np.linalg.solve(h, g), -1, 1)
        v[0] = min(max(v[0], 0.05), 5.0)
    return float(v[0]), float(v[1])


def labelled_sample(labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", label_col: str = "toxic",
                    limit: int = MAX_OF_LABEL) -> DataFrame:
    """(id, label) of at most ``limit`` ids of each label, the first by a hash of the id."""
    rows = labels.select(F.col(id_col), F.col(label_col).cast("double").alias("label"))
    rows = rows if keep is None else rows.filter(keep)
    rows = rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.avg("label").alias("label"))
    of = [rows.filter(F.col("label") == v).orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(limit) for v in (0.0, 1.0)]
    return of[0].unionByName(of[1])


def train(docs: DataFrame, labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", limit: int = MAX_OF_LABEL, max_bytes: int = TRAIN_BYTES) -> Network | None:
    """Fit on a bounded sample: at most ``2 * limit`` texts of at most ``max_bytes`` bytes reach the driver."""
    sample = labelled_sample(labels, keep, id_col, label_col, limit)
    chosen = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).filter(F.octet_length("text").between(1, max_bytes))
    rows = chosen.join(F.broadcast(sample), id_col).orderBy(id_col, "text").limit(2 * limit).select("text", "label").collect()
    if not rows:
        return None
    return fit([r.text.encode() for r in rows], np.array([r.label for r in rows]))


def scorer(net: Network | None):
    """Scores of whole texts, for ``map_texts``."""
    def fn(raw, offsets):
        return [np.full(len(offsets) - 1, 0.5) if net is None else net.score(raw, offsets)]

    return fn


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): 0 to 1, higher: label 1 likelier."""
    return map_texts(docs, id_col, text_col, [StructField("score", DoubleType())], scorer(net))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document scored by a network that never saw the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = train(docs, labels, keep=~held_out(F.col("doc_id")))
    return score(docs, net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
