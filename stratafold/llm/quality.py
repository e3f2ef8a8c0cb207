"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of its neighbours; the
forward-backward marginals of a document's lines, weighted by their lengths, average to
the document's quality.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from stratafold.llm.common import bucket_of_id, groups_by_size, table, with_columns_by_batch

TRAIN_ROWS = 3000
_GROUP_CHARS = 1 << 20
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _MARK, _BAR, _OTHER = range(8)
_OWN = 23
FEATURES = 3 * _OWN + 2


def _signs() -> np.ndarray:
    out = np.full(0x3000, _OTHER, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        out[i] = (_LOWER if c.islower() else _UPPER if c.isupper() else _DIGIT if c.isdigit()
                  else _SPACE if c.isspace() else _LOWER if c.isalpha() else _OTHER)
    out[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
    out[[ord(c) for c in "!#$%&*@^~=+<>/\\_"]] = _MARK
    out[[ord(c) for c in "|[]{}"]] = _BAR
    return out


_SIGNS: list[np.ndarray] = []


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and weight (length, one at least) of each line; an empty text has one empty line."""
    if not _SIGNS:
        _SIGNS.append(_signs())
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kind = _SIGNS[0][np.minimum(code, 0x2FFF)]
    newline = code == 10
    line = np.cumsum(newline, dtype=np.int32) - newline
    lines = int(line[-1]) + 1 if len(code) else 1
    count = np.bincount(line * np.int64(8) + kind, minlength=lines * 8).reshape(lines, 8).astype(float)
    ends = np.concatenate([np.flatnonzero(newline), [len(code)]])[:lines]
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = (ends - starts).astype(float)
    count[:, _SPACE] -= np.bincount(line[newline], minlength=lines)
    space = np.concatenate([[True], kind == _SPACE, [True]])
    begins = space[:-2] & ~space[1:-1]
    words = np.bincount(line[begins], minlength=lines).astype(float)
    same = np.zeros(len(code), bool)
    same[1:] = code[1:] == code[:-1]
    doubled = np.bincount(line[same], minlength=lines)
    marked = np.bincount(line[1:][(kind[1:] >= _MARK) & (kind[:-1] < _SPACE)], minlength=lines)
    capital = np.bincount(line[begins & (kind == _UPPER)], minlength=lines)
    one = np.maximum(size, 1)
    mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed ^ (mixed >> np.uint64(31)))])
    keys = sums[ends] - sums[starts]
    opens, shuts = np.flatnonzero(begins), np.flatnonzero(~space[1:-1] & space[2:])
    word, of = sums[shuts + 1] - sums[opens], line[opens]
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
    _, kind_at = np.unique(word ^ (of.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), return_index=True)
    _, inverse, often = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = (often[inverse] > 1) & (size > 0)
    letters = np.maximum(count[:, _LOWER] + count[:, _UPPER], 1)
    own = np.zeros((lines, _OWN))
    own[:, 0:8] = count / one[:, None]
    own[:, 8] = count[:, _UPPER] / letters
    own[:, 9] = np.log1p(size) / 8
    own[:, 10] = np.log1p(words) / 6
    own[:, 11] = np.minimum(one / np.maximum(words, 1), 30) / 10
    own[:, 12] = np.minimum(count[:, _MARK] / np.maximum(words, 1), 3)
    own[:, 13] = np.minimum(count[:, _BAR] / np.maximum(words, 1), 3)
    own[:, 14] = np.minimum(count[:, _STOP] / np.maximum(words, 1), 3)
    own[:, 15] = doubled / one
    own[:, 16] = np.minimum(marked / np.maximum(words, 1), 2)
    own[:, 17] = capital / np.maximum(words, 1)
    own[:, 18] = repeated
    own[:, 19] = size == 0
    own[:, 20] = words <= 3
    own[:, 21] = np.bincount(of[again], minlength=lines) / np.maximum(words, 1)
    own[:, 22] = np.bincount(of[kind_at], minlength=lines) / np.maximum(words, 1)
    x = np.zeros((lines, FEATURES))
    x[:, :_OWN] = own
    x[1:, _OWN:2 * _OWN] = own[:-1]
    x[:-1, 2 * _OWN:3 * _OWN] = own[1:]
    x[0, -2] = x[-1, -1] = 1
    return x, one


@dataclass(frozen=True)
class LineField:
    """Weights of a line's features, the bias, and the scores of label changes [from, to]."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    change: np.ndarray

    def node(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(node: np.ndarray, sizes: np.ndarray, change: np.ndarray):
    """Forward-backward over chains that lie one after the other.

    ``node`` is each line's score of being good (bad: 0). Gives each line's probability of
    being good and, summed over all chains, the expected number of label changes. Every
    step treats all chains that are long enough at once.
    """
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    start, count = first[order], sizes[order]
    active = [int(np.searchsorted(-count, -t, "left")) for t in range(int(count[0]))]
    fwd, back = np.zeros((len(node), 2)), np.zeros((len(node), 2))
    fwd[first, 1] = node[first]
    for t in range(1, len(active)):
        at = start[:active[t]] + t
        last = fwd[at - 1]
        fwd[at, 0] = _add(last[:, 0] + change[0, 0], last[:, 1] + change[1, 0])
        fwd[at, 1] = _add(last[:, 0] + change[0, 1], last[:, 1] + change[1, 1]) + node[at]
    for t in range(len(active) - 2, -1, -1):
        at = start[:active[t + 1]] + t
        nxt, good = back[at + 1], back[at + 1, 1] + node[at + 1]
        back[at, 0] = _add(change[0, 0] + nxt[:, 0], change[0, 1] + good)
        back[at, 1] = _add(change[1, 0] + nxt[:, 0], change[1, 1] + good)
    both = fwd + back
    total = _add(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - total)
    inner = np.ones(len(node), bool)
    inner[first] = False
    b = np.flatnonzero(inner)
    pairs = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            pairs[i, j] = np.exp(fwd[b - 1, i] + change[i, j] + back[b, j]
                                 + (node[b] if j else 0) - total[b]).sum()
    return good, pairs


def train_field(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, steps: int = 120,
                decay: float = 1e-3, rate: float = 0.15) -> LineField:
    """The field of largest likelihood (with a small penalty), by adaptive gradient steps.

    Each line takes its document's label; ``labels`` has one of 0 and 1 per document.
    """
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale < 1e-6, 1.0, scale)
    z = (x - mean) / scale
    y = np.repeat(labels, sizes).astype(float)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (sizes[labels == label] - 1).sum()
    theta = np.zeros(x.shape[1] + 5)
    square, speed = np.zeros_like(theta), np.zeros_like(theta)
    n = len(x)
    for step in range(1, steps + 1):
        good, pairs = marginals(z @ theta[:-5] + theta[-5], sizes, theta[-4:].reshape(2, 2))
        pull = np.concatenate([z.T @ (y - good), [(y - good).sum()], (seen - pairs).ravel()]) / n
        pull -= decay * np.concatenate([theta[:-5], [0], theta[-4:]])
        speed = 0.9 * speed + 0.1 * pull
        square = 0.99 * square + 0.01 * pull ** 2
        theta = theta + rate * (speed / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return LineField(mean, scale, theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", held_out: tuple[int, int] = (5, 0),
        train_rows: int = TRAIN_ROWS) -> LineField | float:
    """A field learnt from about ``train_rows`` labelled documents, picked by a hash of their id.

    Documents whose id's crc32 modulo ``held_out[0]`` is ``held_out[1]`` and those without a
    label or text are left out. Labels of one kind only, or none, give that constant score
    (1, 0, or 0.5).
    """
    marks = labels.where(F.col(label_col).isNotNull() & (bucket_of_id(id_col, held_out[0]) != held_out[1])
                         ).select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
    counts = {r[0]: r[1] for r in marks.groupBy("y").count().collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    bound = int(1e9 * min(1.0, train_rows / sum(counts.values())))
    marks = marks.where(F.pmod(F.xxhash64("i"), F.lit(10 ** 9)) < bound)
    sample = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(marks), "i")

    def lines(batches):
        for batch in batches:
            found = [line_features(t)[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array([v.astype(np.float32).tobytes() for v in found], pa.binary())],
                names=["y", "x"])

    rows = sample.select("i", "t", "y").mapInArrow(lines, "y int, x binary").toArrow()
    x = [np.frombuffer(v, np.float32).reshape(-1, FEATURES) for v in rows.column("x").to_pylist()]
    y = rows.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.5
    sizes = np.array([len(v) for v in x])
    return train_field(np.concatenate(x).astype(float), sizes, y)


def score_quality(docs: DataFrame, model: LineField | float, text_col: str = "text",
                  good_from: float = 0.3) -> DataFrame:
    """The rows with ``quality_score`` (0 to 1, higher is better) and ``quality_pred`` (0 or 1).

    Whole texts are read, a null text as an empty one; an empty text is one empty line and
    is scored like any other. Columns with these two names are replaced, all others kept.
    """
    def compute(batch: pa.RecordBatch) -> list:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
        score = np.full(len(texts), model if isinstance(model, float) else 0.0)
        if not isinstance(model, float):
            for a, b in groups_by_size([len(t) + 200 for t in texts], _GROUP_CHARS):
                parts = [line_features(t) for t in texts[a:b]]
                node = np.concatenate([model.node(x) for x, _ in parts])
                sizes = np.array([len(w) for _, w in parts])
                good, _ = marginals(node, sizes, model.change)
                weight = np.concatenate([w for _, w in parts])
                first = np.cumsum(sizes) - sizes
                score[a:b] = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
        score = np.clip(score, 0.0, 1.0)
        return [pa.array(score), pa.array((score >= good_from).astype(np.int32))]

    return with_columns_by_batch(docs, [T.StructField("quality_score", T.DoubleType()),
                                        T.StructField("quality_pred", T.IntegerType())], compute)


def op4_line_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(bucket_of_id("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"), F.col("quality_pred").alias("predicted"))
