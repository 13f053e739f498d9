"""Quality classifier: a linear-chain conditional random field over lines.

Each line of a text is labelled good or bad. Its features are the shares of
character classes, its length and its mean word length, and the same of the
line before and the line after. Training starts with every line labelled as its
document and is repeated once, after lines of bad documents that look good on
their own, but for the worst of each, were made good; the chain learns how
labels follow each other. A document's score is
the mean of its lines' forward-backward marginals of 'good', weighted by their
length in bytes (plus one).

Training takes a bounded sample: `sample_docs` labelled documents of each
label, by hash order, with their whole texts. Everything else covers all
documents.

Edge cases: a null or empty text is one empty line and gets a score like any
other, and so does a row without id or one that repeats an id; in training, of
rows that repeat an id the one whose text has the least hash stands for all.
Texts go to Python in parts of bounded bytes, a very long one by itself. A
column named like the score is replaced by it. A corpus without labelled documents of both labels gets one score for
all: the share of label 1, or 1 without labels. Labels other than 0 and 1, or
without id, are not used; of labels that contradict each other the least counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.llm.common import bytes_of, fresh, slices

#: Character classes by their ASCII members; other bytes of 128 and more are a class of their own.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", ".,;:?'\"()-", "!", "|", "#$%&*+/<=>@[\\]^_`{}~")
N_OWN = len(CLASSES) + 5
_MIX = np.random.default_rng(7).integers(1, 2**62, 64) | 1


def _class_table() -> np.ndarray:
    table = np.full(256, -1)
    for k, members in enumerate(CLASSES):
        table[[ord(c) for c in members]] = k
    table[128:] = len(CLASSES)
    return table


_CLASS = _class_table()


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, its length in bytes, number of lines of each text).

    Texts are UTF-8 bytes end to end with n + 1 offsets; each has a line at least.
    """
    n = len(offsets) - 1
    # A line break after every text, so that no line and no text is without bytes.
    text = np.insert(data, offsets[1:], 10)
    breaks = np.nonzero(text == 10)[0]
    starts = np.concatenate([[0], breaks[:-1] + 1])
    lengths = breaks - starts
    doc = np.searchsorted(offsets[1:] + np.arange(n), breaks, side="left")
    counts = np.zeros((len(starts), len(CLASSES) + 2))
    space = _CLASS[text] == 3
    for k in range(0, len(CLASSES) + 1, 2):  # two counts in one number
        weight = np.zeros(256, np.int64)
        weight[_CLASS == k] = 1
        weight[_CLASS == k + 1] = 1 << 32
        both = np.add.reduceat(weight[text], starts)
        counts[:, k], counts[:, k + 1] = both & 0xFFFFFFFF, both >> 32
    share = counts[:, : len(CLASSES) + 1] / np.maximum(lengths, 1)[:, None]
    word = ~space & (text != 10)
    begins = word & ~np.concatenate([[False], word[:-1]])
    words = np.add.reduceat(begins.astype(np.int64), starts)
    at = np.nonzero(begins)[0]
    repeats = np.zeros(len(starts))
    if len(at):  # words that equal the one before, by a sum of their bytes times odd numbers
        place = np.arange(len(text)) - np.maximum.accumulate(np.where(begins, np.arange(len(text)), 0))
        sums = np.add.reduceat(np.where(word, text, 0).astype(np.int64) * _MIX[place & 63], at)
        line = np.searchsorted(breaks, at)
        same = (sums[1:] == sums[:-1]) & (line[1:] == line[:-1])
        repeats = np.bincount(line[1:][same], minlength=len(starts))
    letters = counts[:, 0] + counts[:, 1] + counts[:, len(CLASSES)]
    own = np.column_stack([share, np.log1p(lengths) / 8, np.minimum(lengths / np.maximum(words, 1), 40) / 10, counts[:, 1] / np.maximum(letters, 1), repeats / np.maximum(words, 1)])
    sizes = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first] = 0
    after[first + sizes - 1] = 0
    return np.hstack([np.ones((len(own), 1)), own, before, after]), lengths, sizes


class Chain:
    """Forward-backward for many chains of two states at once; longest chains first, a step of all of them at a time."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        self.base = (np.cumsum(sizes) - sizes)[self.order]
        sorted_sizes = sizes[self.order]
        self.live = [int(k) for k in np.searchsorted(-sorted_sizes, -np.arange(1, sorted_sizes[0] + 1), side="right")] if len(sizes) else []
        self.n = int(sizes.sum())

    def run(self, good: np.ndarray, move: np.ndarray, pairs: bool = False):
        """Marginals of state 1 for each line, the log normaliser of each chain (by order), and the expected moves."""
        lift = np.maximum(good, 0)
        emit = np.exp(np.column_stack([-lift, good - lift]))
        trans = np.exp(move)
        alpha, scale = np.zeros((self.n, 2)), np.zeros(self.n)
        log_z = np.zeros(len(self.base))
        for t, k in enumerate(self.live):
            at = self.base[:k] + t
            now = emit[at] if t == 0 else alpha[at - 1] @ trans * emit[at]
            total = now.sum(1)
            alpha[at], scale[at] = now / total[:, None], total
            log_z[:k] += np.log(total) + lift[at]
        beta = np.ones((self.n, 2))
        expected = np.zeros((2, 2))
        for t in range(len(self.live) - 1, 0, -1):
            at = self.base[: self.live[t]] + t
            back = emit[at] * beta[at] / scale[at][:, None]
            beta[at - 1] = back @ trans.T
            if pairs:
                expected += np.einsum("ni,ij,nj->ij", alpha[at - 1], trans, back)
        return (alpha * beta)[:, 1], log_z, expected


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    constant: float | None = None

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        x, lengths, sizes = line_features(data, offsets)
        good, _, _ = Chain(sizes).run(((x - self.mean) / self.scale) @ self.weights, self.move)
        first = np.cumsum(sizes) - sizes
        weight = lengths + 1.0
        return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0.0, 1.0)


def fit(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, prior: float, *, penalty: float = 1.0, steps: int = 60) -> Model:
    """Maximum penalised likelihood by limited-memory BFGS; label 1 has the weight `prior` of all documents."""
    mean, scale = x.mean(0), x.std(0)
    mean[0], scale[scale < 1e-9] = 0.0, 1.0
    z = (x - mean) / scale
    doc_weight = np.where(labels == 1, prior / labels.mean(), (1 - prior) / (1 - labels.mean()))
    y = np.repeat(labels, sizes)
    p = _maximise(z, sizes, y, labels, doc_weight, penalty, steps)
    look = z @ p[: z.shape[1]]
    first = np.cumsum(sizes) - sizes
    worst = np.repeat(np.minimum.reduceat(look, first), sizes)
    y = np.where((look > 0) & (look > worst), 1, y)
    p = _maximise(z, sizes, y, labels, doc_weight, penalty, steps)
    return Model(mean, scale, p[: z.shape[1]], p[z.shape[1] :].reshape(2, 2))


def _maximise(z: np.ndarray, sizes: np.ndarray, y: np.ndarray, labels: np.ndarray, doc_weight: np.ndarray, penalty: float, steps: int) -> np.ndarray:
    """The weights and moves of the most likely chain for line labels y."""
    d = z.shape[1]
    line_weight = np.repeat(doc_weight, sizes)
    follows = np.ones(len(y), bool)
    follows[np.cumsum(sizes) - sizes] = False
    at = np.nonzero(follows)[0]
    joint = np.zeros((2, 2))
    np.add.at(joint, (y[at - 1], y[at]), line_weight[at])

    # Chains of equal weight share their expected moves, so each label is run on its own.
    parts = [(np.repeat(labels == v, sizes), Chain(sizes[labels == v]), doc_weight[labels == v][0]) for v in (0, 1)]

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, move = p[:d], p[d:].reshape(2, 2)
        good = z @ w
        value = 0.5 * penalty * float(p @ p) - float((line_weight * y * good).sum()) - float((joint * move).sum())
        grad_w, grad_m = penalty * w - z.T @ (line_weight * y), penalty * move - joint
        for rows, part, weight in parts:
            marginal, log_z, expected = part.run(good[rows], move, pairs=True)
            value += weight * float(log_z.sum())
            grad_w = grad_w + weight * (z[rows].T @ marginal)
            grad_m = grad_m + weight * expected
        return value, np.concatenate([grad_w, grad_m.ravel()])

    p = np.zeros(d + 4)
    value, grad = loss(p)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, tape = grad.copy(), []
        for s, g in reversed(past):
            a = (s @ q) / (s @ g)
            q -= a * g
            tape.append(a)
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(grad))
        for (s, g), a in zip(past, reversed(tape), strict=True):
            q += (a - (g @ q) / (s @ g)) * s
        step, slope = 1.0, grad @ q
        while step > 1e-8:
            new_value, new_grad = loss(p - step * q)
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, g = -step * q, new_grad - grad
        if s @ g > 1e-12:
            past = [*past, (s, g)][-8:]
        done = value - new_value < 1e-6 * abs(value)
        p, value, grad = p + s, new_value, new_grad
        if done:
            break
    return p


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out: the CRC-32 of its id as text leaves 2 modulo 4; no id: not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 1500) -> Model:
    """Fits on a bounded sample of the labelled documents that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("y")).filter("id is not null and y in (0, 1)").filter(~held_out(F.col("id")))
    order = [F.xxhash64("id"), F.col("id")]
    prior = usable.agg(F.avg("y")).first()[0]
    sample = [usable.filter(F.col("y") == v).orderBy(*order).limit(sample_docs) for v in (0, 1)]
    chosen = sample[0].unionByName(sample[1]).groupBy("id").agg(F.min("y").alias("y"))  # 2 * sample_docs rows at the most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                x, _, sizes = line_features(*bytes_of(part.column(1)))
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                kept = [x[a:b].astype(np.float32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.binary()), part.column(2)], names=["y", "x", "id"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    once = texts.groupBy("id").agg(F.min_by(F.struct("y", "text"), F.xxhash64("text")).alias("r")).select("r.y", "r.text", "id")
    rows = sorted(once.mapInArrow(run, "y int, x binary, id long").collect(), key=lambda r: r.id)  # 2 * sample_docs at the most
    y = np.array([r.y for r in rows], np.int64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros((2, 2)), constant=float(y.mean()) if len(y) else 1.0)
    width = 1 + 3 * N_OWN
    parts = [np.frombuffer(r.x, np.float32).reshape(-1, width).astype(np.float64) for r in rows]
    return fit(np.concatenate(parts), np.array([len(p) for p in parts]), y, prior)


def with_score(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "__score") -> DataFrame:
    """`docs` with a score from 0 to 1 in `score_col`, which replaces a column of that name."""
    own = [c for c in docs.columns if c.lower() != score_col.lower() or c == text_col]
    text = own.index(text_col)
    name = fresh(score_col, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(*bytes_of(part.column(text))))], names=[*part.schema.names, name])

    slim = docs.select(*own)
    return slim.mapInArrow(run, T.StructType([*slim.schema.fields, T.StructField(name, T.DoubleType())]))


def keep_good(docs: DataFrame, model: Model, least: float, *, text_col: str = "text") -> DataFrame:
    """The documents of that score or more, as they are."""
    score = fresh("__score", docs.columns)
    return with_score(docs, model, text_col=text_col, score_col=score).filter(F.col(score) >= least).select(*docs.columns)
