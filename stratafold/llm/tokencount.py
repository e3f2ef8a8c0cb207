"""Token counts of whole texts, huge ones encoded in overlapping chunks that are spliced.

A text of at most two chunks goes to the library as it is. A longer one is cut into chunks that
overlap around each cut, the chunks are dealt out and encoded with offsets, and two neighbours
are spliced at a token border both have in their overlap.

Which borders may serve is proven from the vocabulary. The encoder starts from single characters
and joins two neighbours only into a piece of the vocabulary, so where no piece holds the two
characters beside a place next to each other, nothing is ever joined across it, whatever stands
further away. Up to the first such place in the overlap the left chunk's tokens are those of the
whole text, from there on the right chunk's. A cut whose overlap has no such place that is a
token border on both sides fails, and its text is cut anew with chunks and overlaps four times as
wide, until none fails or the text is one chunk.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stratafold.llm.common import groups_by_size, parts_of, stored, table

MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 15
OVERLAP = 256
LIMIT = 4096
_WIDER = 4
_BATCH_CHARS = 1 << 20
_SPACE = "▁"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A sentencepiece model and the pairs of characters that its pieces hold."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        form, kinds = spec.normalizer_spec, spec.SentencePiece
        # Cuts need a text to reach the encoder as it is, characters without a piece one by one,
        # and no joining but that of neighbours.
        self.can_cut = (not form.precompiled_charsmap and not form.remove_extra_whitespaces
                        and form.escape_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
                        and spec.trainer_spec.byte_fallback
                        and spec.trainer_spec.model_type == spec.trainer_spec.BPE)
        pairs = set()
        for piece in spec.pieces:
            if piece.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED):
                pairs.update(zip(piece.piece, piece.piece[1:]))
        self.pairs = np.array(sorted(ord(a) << 21 | ord(b) for a, b in pairs), np.int64)

    @staticmethod
    @lru_cache(maxsize=4)
    def of(path: str) -> "Pieces":
        """One for each worker process, kept between its tasks."""
        return Pieces(path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def stable(self, text: str) -> np.ndarray:
        """The places inside a text across which nothing can be joined, ascending."""
        points = np.frombuffer(text.replace(" ", _SPACE).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        return np.flatnonzero(~np.isin(points[:-1] << 21 | points[1:], self.pairs)) + 1

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where each token of a text begins and ends, in code points."""
        found = self.model.encode(text, return_type="offset_mapping")["offsets"]
        begins, ends = np.array(found, np.int64).reshape(-1, 2).T
        return begins, ends


def _row_keys():
    """A function from a row's id and text to a key of that row of the task, whatever their order:
    equal rows of a task are numbered."""
    seen: Counter = Counter()
    task = TaskContext.get().partitionId() if TaskContext.get() else 0

    def key(row_id, text: str) -> bytes:
        own = hashlib.blake2b(f"{row_id}\x00{text}".encode("utf-8", "replace"), digest_size=16).digest()
        seen[own] += 1
        return hashlib.blake2b(own + f"{task}:{seen[own]}".encode(), digest_size=16).digest()

    return key


def _cut(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, int, str]]:
    """Number, first code point and text of each chunk; all overlap by twice ``overlap`` around a cut."""
    cuts = range(chunk, max(len(text) - chunk // 2, chunk), chunk) if len(text) > 2 * chunk else range(0)
    bounds = [0, *cuts, len(text)]
    for no, (a, b) in enumerate(zip(bounds, bounds[1:])):
        start = max(0, a - overlap)
        yield no, start, text[start:min(len(text), b + overlap)]


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _chunk_schema(id_type: T.DataType) -> T.StructType:
    """Rows of whole texts (key null, with their count) and of chunks."""
    return T.StructType([
        T.StructField("id", id_type), T.StructField("key", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("no", T.IntegerType()), T.StructField("chunks", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("text", T.StringType())])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])


def _split(docs: DataFrame, id_col: str, text_col: str, path: str, chunk: int, overlap: int) -> DataFrame:
    """Short texts counted, long ones as chunks."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    schema = _chunk_schema(source.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, key_of, arrow = Pieces.of(path), _row_keys(), _arrow_schema(schema)
        for batch in batches:
            lengths = pa.compute.utf8_length(batch.column(1)).to_pylist()
            for a, b in groups_by_size(lengths, _BATCH_CHARS):
                ids, texts = (batch.column(i).slice(a, b - a).to_pylist() for i in (0, 1))
                short = [i for i, t in enumerate(texts) if len(t) <= 2 * chunk or not pieces.can_cut]
                counts = pieces.counts([texts[i] for i in short])
                yield _batch(arrow, [(ids[i], None, len(texts[i].encode()), n, None, None, None, None)
                                     for i, n in zip(short, counts)])
                for i in sorted(set(range(len(texts))) - set(short)):
                    key, size = key_of(ids[i], texts[i]), len(texts[i].encode())
                    parts = list(_cut(texts[i], chunk, overlap))
                    for no, start, part in parts:
                        yield _batch(arrow, [(ids[i], key, size, None, no, len(parts), start, part)])

    return source.mapInArrow(run, schema)


def _widened(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """The texts of some chunks put together again and cut anew, one text at a time."""
    schema = chunks.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, arrow = Pieces.of(path), _arrow_schema(schema)
        parts: list[str] = []
        at, last = 0, None
        for batch in batches:
            for i in range(batch.num_rows):
                row_id, key, size, _, no, chunks_, start, text = (c[i].as_py() for c in batch.columns)
                if key != last:
                    parts, at, last = [], 0, key
                parts.append(text[at - start:])
                at = start + len(text)
                if no < chunks_ - 1:
                    continue
                whole = "".join(parts)
                cut = list(_cut(whole, chunk, overlap))
                if len(cut) == 1:
                    yield _batch(arrow, [(row_id, None, size, pieces.counts([whole])[0], None, None, None, None)])
                else:
                    for n, start_, part in cut:
                        yield _batch(arrow, [(row_id, key, size, None, n, len(cut), start_, part)])

    dealt = chunks.repartition(parts_of(chunks.sparkSession), "key").sortWithinPartitions("key", "no")
    return dealt.mapInArrow(run, schema)


_SIDE = "array<struct<at:bigint,lost:bigint>>"


def _sides(pieces: Pieces, text: str, start: int, left: int | None, right: int | None) -> tuple[int, list, list]:
    """Token count of a chunk, and the proven borders in its overlaps with the tokens beyond them.

    ``left`` and ``right`` are where its overlaps end and begin (None: it has none there).
    """
    begins, ends = pieces.spans(text)
    n = len(ends)

    def proven(a: int, b: int) -> list[tuple[int, int]]:
        places = pieces.stable(text[a:b]) + a
        before = np.searchsorted(begins, places, "left")
        border = (before > 0) & (ends[before - 1] == places)
        return [(int(p), int(k)) for p, k in zip(places[border], before[border])]

    lost_left = [] if left is None else [(start + p, k) for p, k in proven(0, left - start)]
    lost_right = [] if right is None else [(start + p, n - k) for p, k in proven(right - start, len(text))]
    return n, lost_left, lost_right


def _encoded(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Each chunk's token count, and for each of its cuts the borders that may serve there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        side = pa.list_(pa.struct([("at", pa.int64()), ("lost", pa.int64())]))
        arrow = pa.schema([("key", pa.binary()), ("no", pa.int32()), ("chunks", pa.int32()),
                           ("n_tokens", pa.int64()), ("left", side), ("right", side)])
        for batch in batches:
            for i in range(batch.num_rows):
                key, no, chunks_, start, text = (c[i].as_py() for c in batch.columns)
                left = None if no == 0 else no * chunk + overlap
                right = None if no == chunks_ - 1 else (no + 1) * chunk - overlap
                n, *lost = _sides(pieces, text, start, left, right)
                yield _batch(arrow, [(key, no, chunks_, n, *(
                    [{"at": p, "lost": k} for p, k in side_] for side_ in lost))])

    return (chunks.select("key", "no", "chunks", "start", "text")
            .repartition(parts_of(chunks.sparkSession), "key", "no")
            .mapInArrow(run, f"key binary, no int, chunks int, n_tokens bigint, left {_SIDE}, right {_SIDE}"))


def _spliced(encoded: DataFrame) -> DataFrame:
    """(key, n_tokens) of each text; null if one of its cuts has no border in common."""
    none = F.lit(None).cast(_SIDE)
    sides = encoded.where("no > 0").select(
        "key", F.col("no").alias("cut"), none.alias("before"), F.col("left").alias("after")).unionByName(
        encoded.where("no < chunks - 1").select(
            "key", (F.col("no") + 1).alias("cut"), F.col("right").alias("before"), none.alias("after")))
    cuts = sides.groupBy("key", "cut").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    place = F.array_min(F.array_intersect(F.col("before.at"), F.col("after.at")))
    lost = lambda side: F.get(F.filter(side, lambda b: b.at == F.col("place")), F.lit(0)).lost
    cuts = cuts.withColumn("place", place).select(
        "key", (-lost("before") - lost("after")).alias("n"), F.col("place").isNull().alias("failed"))
    parts = encoded.select("key", F.col("n_tokens").alias("n"), F.lit(False).alias("failed"))
    return parts.unionByName(cuts).groupBy("key").agg(F.sum("n").alias("n"), F.max("failed").alias("failed")).select(
        "key", F.when(~F.col("failed"), F.col("n")).alias("spliced"))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id_col, n_bytes, n_tokens) of every row: UTF-8 bytes and tokens of its whole text.

    ``path`` names a sentencepiece model that the workers have. A null text is empty, with no
    tokens; rows of one id, null ids too, are counted each for itself; other columns are not
    read. ``chunk`` and ``overlap`` are code points; a text of over two chunks is cut, if the
    model lets cuts be proven. Results hang on neither.
    """
    if not 0 < 2 * overlap <= chunk:
        raise ValueError("an overlap must be at most half a chunk")
    path = path or model_path()
    chunks = stored(_split(docs, id_col, text_col, path, chunk, overlap), "token_chunks")
    done = []
    while True:
        done.append(chunks.where("key is null").select("id", "n_bytes", "n_tokens"))
        cut = chunks.where("key is not null")
        if cut.isEmpty():
            break
        spliced = stored(_spliced(_encoded(cut, path, chunk, overlap)), "token_spliced")
        whole = cut.where("no = 0").join(spliced, "key")
        done.append(whole.where("spliced is not null").select("id", "n_bytes", F.col("spliced").alias("n_tokens")))
        failed = spliced.where("spliced is null").select("key")
        if failed.isEmpty():
            break
        chunk, overlap = chunk * _WIDER, overlap * _WIDER
        again = cut.join(failed, "key", "left_semi").select(*cut.columns)
        chunks = stored(_widened(again, path, chunk, overlap), "token_chunks")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.withColumnRenamed("id", id_col)


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
