"""Fill-in-middle transformation by a secondary sort of text pieces.

A text is cut into units (a run of ASCII letters, or any other single code point) and two unit
numbers drawn from its id part it into prefix, middle and suffix. Each part goes out as pieces of
whole units, keyed by document and output position; the pieces are repartitioned by document and
sorted within partitions, and stream through an incremental digest, so a task holds one piece at a
time. The same stream finds the marks in the output and gives each piece its place in the
original, and a second sort within the same partitions brings the pieces back into that order for
the digest of the restored text: one shuffle of the text in all.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stratafold.llm.common import parts_of, table

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Marks in output order, and the place of each part in the original.
ORDERS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
          "plain": ((b"", 0),)}
PIECE_BYTES = 1 << 16
_BATCH_BYTES = 1 << 22


@dataclass(frozen=True)
class Rates:
    """Of a hundred texts, how many are transformed, and how many of those suffix first."""

    transformed: int = 90
    suffix_first: int = 20


def draws(row_id, seed: int = 1) -> list[int]:
    """The four numbers a document's id gives; a missing id is the text ``null``."""
    digest = hashlib.sha256(f"{seed}:{'null' if row_id is None else row_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Where the units of a UTF-8 text start."""
    folded = data | 0x20
    letter = (folded >= 0x61) & (folded <= 0x7A)
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def _points(data: np.ndarray) -> int:
    return int(((data & 0xC0) != 0x80).sum())


def _cuts(starts: np.ndarray, a: int, b: int, most: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of ``[a, b)`` of at most ``most`` bytes that end with a unit; a longer unit,
    which is a run of ASCII letters, is cut anywhere. An empty part is one empty piece."""
    at = a
    while True:
        stop = min(b, at + most)
        if stop < b:
            unit = int(starts[np.searchsorted(starts, stop, "right") - 1])
            stop = unit if unit > at else stop
        yield at, stop
        at = stop
        if at >= b:
            return


def _piece_schema(id_type: T.DataType) -> T.StructType:
    """Pieces by document and output position; the first one of a document carries what is known
    of it (its form; unit and code point counts), the others null."""
    return T.StructType([
        T.StructField("key", T.BinaryType(), False), T.StructField("pos", T.IntegerType(), False),
        T.StructField("data", T.BinaryType(), False), T.StructField("id", id_type),
        T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())])


class _Out:
    """Rows gathered into batches of bounded bytes."""

    def __init__(self, schema: T.StructType, size_at: int):
        self.schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType), f.nullable) for f in schema])
        self.size_at, self.rows, self.held = size_at, [], 0

    def add(self, row: tuple) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += 200 + len(row[self.size_at] or b"")
        if self.held > _BATCH_BYTES:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in self.schema]
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)],
                                          schema=self.schema)


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each value, null as none, as views of the column."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    for i in range(len(column)):
        yield data[offsets[i]:offsets[i + 1]] if column[i].is_valid else data[:0]


def fim_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rates: Rates = Rates(),
               seed: int = 1, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The transformed texts as pieces of at most ``piece_bytes`` bytes (at least 3 more with a mark):
    concatenated by ``pos`` the pieces of a key are the output.

    ``key`` stands for a row: rows of one id, equal texts too, are transformed each for itself.
    A null text is empty; an empty text, or one that holds a mark, stays as it is (form ``plain``).
    A missing id draws as the text ``null``. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    schema = _piece_schema(source.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        out = _Out(schema, 2)
        for batch in batches:
            for row_id, data in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                raw = data.tobytes()
                starts = unit_starts(data)
                n, (h1, h2, h3, h4) = len(starts), draws(row_id, seed)
                if not raw or h3 % 100 >= rates.transformed or any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)):
                    form, bounds, chars = "plain", {0: (0, len(raw))}, (None, None)
                else:
                    form = "spm" if h4 % 100 < rates.suffix_first else "psm"
                    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = (int(starts[k]) if k < n else len(raw) for k in (low, high))
                    bounds = {0: (0, a), 1: (a, b), 2: (b, len(raw))}
                    chars = (_points(data[:a]), _points(data[a:b]))
                # Equal rows of a task are numbered, so that the key hangs on no order.
                own = hashlib.blake2b(f"{row_id}\x00".encode() + raw, digest_size=16).digest()
                seen[own] += 1
                key = hashlib.blake2b(own + f"{task}:{seen[own]}".encode(), digest_size=16).digest()
                about, pos = (row_id, n, form, *chars), 0
                for mark, part in ORDERS[form]:
                    for i, (a, b) in enumerate(_cuts(starts, *bounds[part], piece_bytes)):
                        yield from out.add((key, pos, (b"" if i else mark) + raw[a:b], *about))
                        about, pos = (None,) * 5, pos + 1
        yield out.batch()

    return source.mapInArrow(run, schema)


_PLACED = T.StructType([
    T.StructField("key", T.BinaryType(), False), T.StructField("part", T.IntegerType(), False),
    T.StructField("pos", T.IntegerType(), False), T.StructField("data", T.BinaryType(), False),
    T.StructField("output_sha256", T.StringType())])


def _placed(pieces: DataFrame) -> DataFrame:
    """From pieces sorted by key and output position, the pieces of the original with their place in
    it (the marks found and taken off), and before them a row (part -1) of the output's digest."""
    about = [f for f in pieces.schema if f.name not in ("key", "pos", "data")]
    schema = T.StructType([*_PLACED, *about])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema, 3)
        key, none = None, (None,) * len(about)

        def closed():
            if key is not None:
                yield from out.add((key, -1, 0, b"", digest.hexdigest(), *known))

        for batch in batches:
            for now, pos, data, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key:
                    yield from closed()
                    key, known, digest = now, rest, hashlib.sha256()
                    marks, part = list(ORDERS[rest[about_form]]), None
                digest.update(data)
                if marks and data.startswith(marks[0][0]):
                    mark, part = marks.pop(0)
                    data = data[len(mark):]
                yield from out.add((key, part, pos, data, None, *none))
        yield from closed()
        yield out.batch()

    about_form = [f.name for f in about].index("form")
    return pieces.mapInArrow(run, schema)


def _restored(placed: DataFrame) -> DataFrame:
    """From rows sorted by key and place in the original, one row a document with the restored text's digest."""
    about = [f for f in placed.schema if f.name not in ("key", "part", "pos", "data")]
    schema = T.StructType([*about, T.StructField("restored_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema, len(about))
        known = None
        for batch in batches:
            for _, part, _, data, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if part < 0:
                    if known is not None:
                        yield from out.add((*known, digest.hexdigest()))
                    known, digest = rest, hashlib.sha256()
                else:
                    digest.update(data)
        if known is not None:
            yield from out.add((*known, digest.hexdigest()))
        yield out.batch()

    return placed.mapInArrow(run, schema)


def _by_document(pieces: DataFrame) -> DataFrame:
    return pieces.repartition(parts_of(pieces.sparkSession), "key").sortWithinPartitions("key", "pos")


def fim_digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each document of ``fim_pieces``: its facts, and the SHA-256 of its output and of the
    text restored from output and form. No more than a batch of pieces is held at a time."""
    placed = _placed(_by_document(pieces)).sortWithinPartitions("key", "part", "pos")
    return _restored(placed).select(
        F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def fim_texts(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, form, output): whole outputs, for texts that fit a row."""
    about = [f for f in pieces.schema if f.name in ("id", "form")]
    schema = T.StructType([*about, T.StructField("output", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, parts = _Out(schema, 2), None, []
        for batch in batches:
            for now, data, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key and key is not None:
                    yield from out.add((*known, b"".join(parts).decode()))
                if now != key:
                    key, known, parts = now, rest, []
                parts.append(data)
        if key is not None:
            yield from out.add((*known, b"".join(parts).decode()))
        yield out.batch()

    return _by_document(pieces).select("key", "data", *[f.name for f in about]).mapInArrow(
        run, schema).withColumnRenamed("id", id_col)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    return fim_digests(fim_pieces(table(spark, sf_dir, "documents")))


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
h AS (SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
            THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high FROM h),
p AS (SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
        array_to_string(units[high + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""
