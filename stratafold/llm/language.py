"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One binary classifier for each bit, a logistic
regression over hashed character n-grams, predicts it from a text; the prediction is the
language whose codeword has the smallest sum of logistic losses over the bits' margins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from stratafold.llm.common import bucket_of_id, groups_by_size, table, with_columns_by_batch

DIMS = 4096
TRAIN_ROWS = 2400
_GRAMS = (1, 2, 3)
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_GROUP_CHARS = 1 << 20
_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x32000)), bool, 0x32000))
    return _LETTERS[0]


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; each run of other signs than letters is one 0."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letter_table()[np.minimum(code, 0x31FFF)]
    before = np.concatenate([[True], letter[:-1]])
    return np.where(letter, code, 0)[letter | before].astype(np.uint64)


def features(texts: list[str]) -> np.ndarray:
    """One row a text: log counts of its hashed character n-grams, scaled to length 1.

    A text without letters has a row of zeros. Long texts are counted piece by piece.
    """
    counts = np.zeros((len(texts), DIMS), np.float32)
    for row, text in enumerate(texts):
        for at in range(0, len(text), _GROUP_CHARS):
            code = _codes(text[max(0, at - 2):at + _GROUP_CHARS])
            if not code.any():
                continue
            code = np.concatenate([[np.uint64(0)], code, [np.uint64(0)]])
            for n, mix in zip(_GRAMS, _MIX):
                key = code[:len(code) - n + 1].copy()
                for k in range(1, n):
                    key = key * np.uint64(0x200003) + code[k:len(code) - n + 1 + k]
                slot = (key * np.uint64(mix)) >> np.uint64(52)
                counts[row] += np.bincount(slot.astype(np.int64), minlength=DIMS)
    np.log1p(counts, out=counts)
    length = np.sqrt((counts * counts).sum(1, keepdims=True))
    return counts / np.where(length == 0, 1, length)


def codewords(classes: int) -> np.ndarray:
    """A row of +1 and -1 for each class; every two rows differ in about half the bits.

    Up to seven classes get the exhaustive code, more get fixed random bits.
    """
    if classes <= 2:
        return np.array([[1.0], [-1.0]])[:classes]
    if classes <= 7:
        n = 2 ** (classes - 1) - 1
        rows = [np.ones(n)]
        for i in range(1, classes):
            run = 2 ** (classes - 1 - i)
            rows.append(np.where((np.arange(n) // run) % 2 == 0, -1.0, 1.0))
        return np.array(rows)
    bits = int(np.ceil(12 * np.log2(classes)))
    return np.where(np.random.default_rng(classes).random((classes, bits)) < 0.5, -1.0, 1.0)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """For each text and language, the mean logistic loss of the margins against its bits."""
        margin = x @ self.weights + self.bias
        right = np.logaddexp(0, -margin) @ (self.code > 0).T
        return (right + np.logaddexp(0, margin) @ (self.code < 0).T) / self.code.shape[1]


def _train_bits(x: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int = 150,
                rate: float = 8.0, decay: float = 2e-6) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions of all bits at once, by accelerated gradient steps."""
    w = np.zeros((x.shape[1], target.shape[1]), np.float32)
    b = np.zeros(target.shape[1], np.float32)
    ahead, ahead_b = w.copy(), b.copy()
    share = (weight / weight.sum()).astype(np.float32)[:, None]
    for step in range(steps):
        margin = np.clip(target * (x @ ahead + ahead_b), -50, 50)
        pull = share * target / (1 + np.exp(margin))
        new, new_b = ahead + rate * (x.T @ pull - decay * ahead), ahead_b + rate * pull.sum(0)
        push = step / (step + 3)
        ahead, ahead_b = new + push * (new - w), new_b + push * (new_b - b)
        w, b = new, new_b
    return w, b


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        held_out: tuple[int, int] = (4, 2), train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """A model from at most about ``train_rows`` rows, the same number of each language.

    Rows are picked by a hash of their id among those with a language and a text whose
    id's crc32 modulo ``held_out[0]`` is not ``held_out[1]``. Each is learnt as a whole
    and as one short excerpt. Without any such row the model knows no language.
    """
    pool = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                      & (bucket_of_id(id_col, held_out[0]) != held_out[1])).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    counts = {r[0]: r[1] for r in pool.groupBy("l").count().collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return LanguageModel((), np.zeros((0, 1)), np.zeros((DIMS, 1), np.float32), np.zeros(1))
    each = max(1, train_rows // len(languages))
    bound = F.lit(0)
    for name in languages:
        bound = F.when(F.col("l") == name, int(1e9 * min(1.0, each / counts[name]))).otherwise(bound)
    sample = pool.where(F.pmod(F.xxhash64("i"), F.lit(10 ** 9)) < bound)

    def sparse(batches):
        for batch in batches:
            for text, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                middle = len(text) // 2
                x = features([text, text[middle:middle + 60]])
                at = [np.flatnonzero(row) for row in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * 2), pa.array([a.astype(np.int32) for a in at]),
                     pa.array([row[a] for row, a in zip(x, at)])], names=["l", "a", "v"])

    found = sample.mapInArrow(sparse, "l string, a array<int>, v array<float>").toArrow()
    x = np.zeros((found.num_rows, DIMS), np.float32)
    for row, (a, v) in enumerate(zip(found.column("a"), found.column("v"))):
        x[row, a.values.to_numpy()] = v.values.to_numpy()
    label = np.array([languages.index(v) for v in found.column("l").to_pylist()], np.int64)
    code = codewords(len(languages))
    per = np.bincount(label, minlength=len(languages))
    weights, bias = _train_bits(x, code[label].astype(np.float32), 1 / np.maximum(per, 1)[label])
    return LanguageModel(languages, code, weights, bias)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             ambiguous_below: float = 0.5, sharpness: float = 8.0) -> DataFrame:
    """The rows with ``lang_pred``, ``score`` (0 to 1) and ``lang_ambiguous``.

    Whole texts are read. A null text, one without a letter, and every text of a model
    without languages gets ``und`` and score 0. The score is the best language's share of
    exp(-sharpness * loss); a text is ambiguous if it is ``und`` or its score is below
    ``ambiguous_below``. Ties go to the language first in text order. Columns with the new
    columns' names are replaced, all others kept.
    """
    names = np.array([*model.languages, "und"], dtype=object)

    def compute(batch: pa.RecordBatch) -> list:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
        best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
        for a, b in groups_by_size([len(t) + 4096 for t in texts], 4 * _GROUP_CHARS):
            x = features(texts[a:b])
            if not len(model.languages):
                break
            loss = model.losses(x)
            low = loss.argmin(1)
            share = 1 / np.exp(-sharpness * (loss - loss.min(1, keepdims=True))).sum(1)
            known = x.any(1)
            best[a:b] = np.where(known, low, len(names) - 1)
            score[a:b] = np.where(known, share, 0.0)
        unsure = (best == len(names) - 1) | (score < ambiguous_below)
        return [pa.array(names[best], pa.string()), pa.array(score), pa.array(unsure)]

    return with_columns_by_batch(docs, [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("lang_ambiguous", T.BooleanType())], compute)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(bucket_of_id("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "lang_ambiguous")
