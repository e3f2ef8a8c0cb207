"""Token-id files as wavelet matrices.

A file holds the ids of a range of documents in id order, in blocks. A block's ids are
numbered within the block, and the numbers' bits stand in planes, the highest first; after
each plane the numbers with a 0 bit move to the front, in order. Counts of ones at steps of
512 bits give rank and select, so single ids, counts and places of an id are found in the
stored bits without decoding the block. The counts of ones are stored with the planes.

A file ends with a footer: where each block and its first document and id stand, and how often
each id occurs in it. ``TokenFile`` answers access, count and find for a whole file with it and
reads only the block that holds the answer; counts of a whole file need no block.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.llm.common import parts_of, range_index, sampled_splits, stored, table
from stratafold.llm.encode import END_ID, Encoder, crc_of, tokenizer_path
from stratafold.llm.warc import open_folder
from stratafold.session import new_folder

BLOCK_IDS = 1 << 18
ROWS_A_SHARD = 20_000
#: A small table has shards of this many rows, up to this many of them.
FEWEST_ROWS, FEW_SHARDS = 1000, 64
MOST_SHARDS = 1 << 17
_MAGIC = b"WVMX0002"
_HEAD = struct.Struct("<QIIQ")  # documents, ids, symbols, bytes of the block
_NO_BLOCK = _HEAD.pack(0, 0, 0, 0)
_TAIL = struct.Struct("<QQ8s")  # start and bytes of the footer, the magic again
_STEP = 512
_MANIFEST = "shard int, name string, temp string, documents bigint, ids bigint, bytes bigint"


@dataclass
class Wavelet:
    """A sequence of ids as bit planes; ``symbols`` are its distinct ids, ascending."""

    n: int
    symbols: np.ndarray
    planes: np.ndarray  # one row of packed bits a level, the highest bit first
    ones: np.ndarray  # ones before every step of each plane, and in all at the end

    @classmethod
    def build(cls, ids: np.ndarray) -> "Wavelet":
        present = np.zeros(int(ids.max(initial=0)) + 1, bool)
        present[ids] = True
        symbols = np.flatnonzero(present).astype(np.uint32)
        code = np.zeros(len(present), np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
        code[symbols] = np.arange(len(symbols))
        now, planes = code[ids], []
        for bit in range(max(1, int(len(symbols) - 1).bit_length()) - 1, -1, -1):
            one = (now & now.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(one, bitorder="little"))
            now = np.concatenate([now[~one], now[one]])
        return cls(len(ids), symbols, np.array(planes), cls._ones(np.array(planes)))

    @staticmethod
    def _ones(planes: np.ndarray) -> np.ndarray:
        size = _STEP // 8
        padded = np.zeros((len(planes), -(-planes.shape[1] // size) * size), np.uint8)
        padded[:, :planes.shape[1]] = planes
        count = np.bitwise_count(padded).reshape(len(padded), -1, size).sum(2, dtype=np.int64)
        return np.concatenate([np.zeros((len(padded), 1), np.int64), np.cumsum(count, 1)], 1)

    def _rank(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        step = i // _STEP
        bits = self.planes[level, step * (_STEP // 8):-(-i // 8)].copy()
        if i % 8 and len(bits):
            bits[-1] &= (1 << (i % 8)) - 1
        return int(self.ones[level, step]) + int(np.bitwise_count(bits).sum())

    def _select(self, level: int, one: bool, k: int) -> int:
        """Place of the k-th (from 0) one, or zero, of a plane."""
        steps = self.ones[level] if one else np.arange(self.ones.shape[1]) * _STEP - self.ones[level]
        step = int(np.searchsorted(steps, k, "right")) - 1
        bits = np.unpackbits(self.planes[level, step * (_STEP // 8):(step + 1) * (_STEP // 8)], bitorder="little")
        return step * _STEP + int(np.flatnonzero(bits == one)[k - int(steps[step])])

    def access(self, i: int) -> int:
        """The id at place i."""
        code = 0
        for level in range(len(self.planes)):
            bit = int(self.planes[level, i // 8]) >> (i % 8) & 1
            ones = self._rank(level, i)
            i = self.n - int(self.ones[level, -1]) + ones if bit else i - ones
            code = code * 2 + bit
        return int(self.symbols[code])

    def _range(self, symbol: int, stop: int) -> tuple[int, int] | None:
        """Where the symbol's occurrences among the first ``stop`` ids end up below the last plane."""
        code = int(np.searchsorted(self.symbols, symbol))
        if code == len(self.symbols) or self.symbols[code] != symbol:
            return None
        a, b = 0, stop
        for level in range(len(self.planes)):
            ra, rb = self._rank(level, a), self._rank(level, b)
            if code >> (len(self.planes) - 1 - level) & 1:
                zeros = self.n - int(self.ones[level, -1])
                a, b = zeros + ra, zeros + rb
            else:
                a, b = a - ra, b - rb
        return a, b

    def count(self, symbol: int, stop: int | None = None) -> int:
        """How often the id occurs (among the first ``stop`` ids)."""
        found = self._range(symbol, self.n if stop is None else stop)
        return found[1] - found[0] if found else 0

    def find(self, symbol: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of the id."""
        a, b = self._range(symbol, self.n) or (0, 0)
        if not 0 <= k < b - a:
            raise IndexError(k)
        place, code = a + k, int(np.searchsorted(self.symbols, symbol))
        for level in range(len(self.planes) - 1, -1, -1):
            one = bool(code >> (len(self.planes) - 1 - level) & 1)
            zeros = self.n - int(self.ones[level, -1])
            place = self._select(level, one, place - zeros if one else place)
        return place

    def decode(self) -> np.ndarray:
        """All ids, plane by plane from the last."""
        dtype = np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32
        bits = [np.unpackbits(p, bitorder="little", count=self.n).view(bool) for p in self.planes]
        now = np.zeros(self.n, dtype)
        for i, one in enumerate(reversed(bits)):
            back = np.empty_like(now)
            zeros = self.n - int(np.count_nonzero(one))
            back[~one], back[one] = now[:zeros], now[zeros:] | dtype(1 << i)
            now = back
        return self.symbols[now]


def pack_block(doc_ids: np.ndarray, present: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> tuple[bytes, tuple]:
    """A block: its head, the documents' ids (and whether they have one) and sizes, the matrix.
    With it what the footer has of it: documents, ids, symbols and how often each occurs."""
    w = Wavelet.build(ids)
    body = b"".join([doc_ids.astype("<i8").tobytes(), present.astype(np.uint8).tobytes(),
                     sizes.astype("<u4").tobytes(), w.symbols.astype("<u4").tobytes(),
                     w.ones.astype("<u4").tobytes(), w.planes.tobytes()])
    often = np.bincount(ids)[w.symbols]
    return _HEAD.pack(len(doc_ids), w.n, len(w.symbols), len(body)) + body, (len(doc_ids), w.n, w.symbols, often)


def pack_footer(at: int, blocks: list[tuple]) -> bytes:
    """What follows the blocks: an empty head, the footer, and where it starts. ``blocks`` are their
    sizes in bytes with what ``pack_block`` gives; ``at`` is where the empty head stands."""
    rows = np.array([(size, documents, n, len(symbols)) for size, (documents, n, symbols, _) in blocks], "<i8")
    parts = [rows.tobytes(), *(b[1][2].astype("<u4").tobytes() for b in blocks),
             *(b[1][3].astype("<u4").tobytes() for b in blocks)]
    data = zstandard.ZstdCompressor(level=1).compress(len(blocks).to_bytes(8, "little") + b"".join(parts))
    return _NO_BLOCK + data + _TAIL.pack(at + len(_NO_BLOCK), len(data), _MAGIC)


def read_block(stream) -> tuple[np.ndarray, np.ndarray, np.ndarray, Wavelet] | None:
    """Document ids, whether they have one, sizes and matrix of the block that starts here, if one does."""
    documents, n, symbols, size = _HEAD.unpack(stream.read(_HEAD.size))
    if not documents:
        return None
    body, at = stream.read(size), 0

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, dtype, count, at)
        at += out.nbytes
        return out

    doc_ids, present, sizes = take("<i8", documents), take("u1", documents), take("<u4", documents)
    names = take("<u4", symbols)
    levels, wide = max(1, int(symbols - 1).bit_length()), -(-n // 8)
    ones = take("<u4", levels * (1 - (-wide // (_STEP // 8)))).reshape(levels, -1).astype(np.int64)
    planes = take("u1", levels * wide).reshape(levels, -1)
    return doc_ids, present.view(bool), sizes, Wavelet(n, names, planes, ones)


def read_blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Wavelet]]:
    """What ``read_block`` gives of each block of a file."""
    if stream.read(len(_MAGIC)) != _MAGIC:
        raise ValueError("not a token file")
    while block := read_block(stream):
        yield block


class TokenFile:
    """Access, count and find over the ids of one file; ``stream`` must be able to seek.

    Opening it reads the footer. Each answer reads one block at most, the last one read is kept;
    ``read`` counts them.
    """

    def __init__(self, stream):
        self.stream, self.read, self._held = stream, 0, None
        stream.seek(stream.size() - _TAIL.size)
        at, size, magic = _TAIL.unpack(stream.read(_TAIL.size))
        if magic != _MAGIC:
            raise ValueError("not a token file")
        stream.seek(at)
        data = zstandard.ZstdDecompressor().decompress(stream.read(size))
        blocks = int.from_bytes(data[:8], "little")
        rows = np.frombuffer(data, "<i8", blocks * 4, 8).reshape(-1, 4)
        total = int(rows[:, 3].sum())
        sums = np.zeros((blocks + 1, 4), np.int64)
        np.cumsum(rows, 0, out=sums[1:])
        #: Where each block starts, and the documents and ids before it.
        self.offsets, self.documents, self.starts = len(_MAGIC) + sums[:, 0], sums[:, 1], sums[:, 2]
        symbols = np.frombuffer(data, "<u4", total, 8 + rows.nbytes)
        often = np.frombuffer(data, "<u4", total, 8 + rows.nbytes + symbols.nbytes)
        order = np.argsort(symbols, kind="stable")
        # By symbol: the blocks that hold it, ascending, and how often.
        self.symbols, self._often = symbols[order], often[order].astype(np.int64)
        self._block_of = np.repeat(np.arange(blocks), rows[:, 3])[order]

    def __len__(self) -> int:
        return int(self.starts[-1])

    def _block(self, i: int) -> tuple:
        if self._held is None or self._held[0] != i:
            self.stream.seek(int(self.offsets[i]))
            self._held, self.read = (i, read_block(self.stream)), self.read + 1
        return self._held[1]

    def _holding(self, place: int) -> int:
        if not 0 <= place < len(self):
            raise IndexError(place)
        return int(np.searchsorted(self.starts, place, "right")) - 1

    def _by_block(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.symbols, symbol), np.searchsorted(self.symbols, symbol, "right")
        return self._block_of[a:b], self._often[a:b]

    def access(self, place: int) -> int:
        """The id at a place of the file."""
        i = self._holding(place)
        return self._block(i)[3].access(place - int(self.starts[i]))

    def count(self, symbol: int, stop: int | None = None) -> int:
        """How often the id occurs (among the first ``stop`` ids)."""
        blocks, often = self._by_block(symbol)
        if stop is None or stop >= len(self):
            return int(often.sum())
        if stop <= 0:
            return 0
        i = self._holding(stop)
        before = int(often[blocks < i].sum())
        rest = stop - int(self.starts[i])
        return before + (self._block(i)[3].count(symbol, rest) if rest and (blocks == i).any() else 0)

    def find(self, symbol: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of the id."""
        blocks, often = self._by_block(symbol)
        before = np.cumsum(often) - often
        at = int(np.searchsorted(before, k, "right")) - 1
        if k < 0 or at < 0 or k - int(before[at]) >= int(often[at]):
            raise IndexError(k)
        i = int(blocks[at])
        return int(self.starts[i]) + self._block(i)[3].find(symbol, k - int(before[at]))

    def document(self, place: int) -> tuple[int | None, int]:
        """The document that holds a place (its id may be null), and the ids of it before the place."""
        i = self._holding(place)
        doc_ids, present, sizes, _ = self._block(i)
        ends = np.cumsum(sizes, dtype=np.int64) + int(self.starts[i])
        row = int(np.searchsorted(ends, place, "right"))
        return (int(doc_ids[row]) if present[row] else None), place - int(ends[row] - sizes[row])


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The texts' ids (null: empty), each with the end id, in files of ascending id ranges.

    Gives the manifest, stored below ``path``. Rows without an id come first; rows of one id
    follow in the order of their texts' hash. A document is never parted, so one longer than
    ``block_ids`` is a block of its own. How many files there are, and which rows are in each, hangs
    on the rows alone. Files get their names when all are written.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    n = rows.count()
    shards = min(MOST_SHARDS, max(1, min(FEW_SHARDS, n // FEWEST_ROWS), n // ROWS_A_SHARD))
    splits = sampled_splits(rows, "id", shards)
    placed = rows.withColumn("shard", range_index(splits)(F.coalesce("id", F.lit(-(1 << 63)))))
    placed = placed.repartitionById(max(1, len(splits)), "shard").sortWithinPartitions(
        "shard", "id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        store.create_dir(folder, recursive=True)
        encoder, done = Encoder.of(tokenizer), []
        out = shard = None
        held: list[tuple] = []
        blocks: list[tuple] = []

        def flush():
            nonlocal held
            if held:
                keys, sizes, ids = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
                present = np.concatenate([h[0] for h in held])
                data, counts = pack_block(keys, present, sizes, ids)
                out.write(data)
                blocks.append((len(data), counts))
                done[-1]["bytes"] += len(data)
                done[-1]["documents"] += len(keys)
                done[-1]["ids"] += len(ids)
            held = []

        def close():
            nonlocal blocks
            flush()
            footer = pack_footer(done[-1]["bytes"], blocks)
            out.write(footer)
            out.close()
            done[-1]["bytes"] += len(footer)
            blocks = []

        for batch in batches:
            of = batch.column(0).to_numpy()
            texts = batch.column(2)
            bounds = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(bounds[:-1], bounds[1:]):
                if a == b:
                    continue
                if of[a] != shard:
                    if out is not None:
                        close()
                    shard = int(of[a])
                    name = f"tokens-{shard:06d}.wvm"
                    done.append({"shard": shard, "name": name, "temp": f"{name}.{uuid.uuid4().hex}.tmp",
                                 "documents": 0, "ids": 0, "bytes": len(_MAGIC)})
                    out = store.open_output_stream(f"{folder}/{done[-1]['temp']}", compression=None)
                    out.write(_MAGIC)
                for at in range(a, b, 64):
                    part = slice(at, min(at + 64, b))
                    size = part.stop - part.start
                    own = batch.column(1).slice(at, size)
                    ids, sizes = encoder.encode(texts.slice(at, size).to_pylist(), END_ID)
                    held.append((~np.asarray(own.is_null()), own.fill_null(0).to_numpy(), sizes, ids))
                    if sum(len(h[3]) for h in held) >= block_ids:
                        flush()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([
            ("shard", pa.int32()), ("name", pa.string()), ("temp", pa.string()),
            ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]))

    written = stored(placed.select("shard", "id", "text").mapInArrow(write, _MANIFEST), "tokens_written")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        for batch in batches:
            for name, temp, size in zip(*(batch.column(i).to_pylist() for i in (1, 2, 5))):
                if store.get_file_info(f"{folder}/{temp}").type == fs.FileType.File:
                    store.move(f"{folder}/{temp}", f"{folder}/{name}")
                if store.get_file_info(f"{folder}/{name}").size != size:
                    raise OSError(f"{name}: its size is not that of the manifest")
            yield batch

    written.repartition(parts_of(spark), "name").mapInArrow(rename, _MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files of the manifest.

    ``start`` is the number of ids of all documents before it. Only the ids per file, one
    number for each, come to the driver.
    """
    files = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    sizes = sorted(tuple(r) for r in files.select("shard", "ids").collect())
    first = dict(zip((s for s, _ in sizes), np.cumsum([0, *(n for _, n in sizes)]).tolist()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        for batch in batches:
            for shard, name in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                start = first[shard]
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for keys, present, sizes, matrix in read_blocks(stream):
                        ids = matrix.decode()
                        stops = np.cumsum(sizes, dtype=np.int64)
                        crc = [crc_of(ids[b - n:b]) for b, n in zip(stops.tolist(), sizes.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys, pa.int64(), mask=~present), pa.array(start + stops - sizes, pa.int64()),
                             pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += len(ids)

    return files.select("shard", "name").repartition(parts_of(spark), "name").mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def count_tokens(spark: SparkSession, path: str, symbols: list[int]) -> DataFrame:
    """(token, n) for each of the ids that occurs: how often, by the footers of the files alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{folder}/{name}") as stream:
                    file = TokenFile(stream)
                    found = [(s, file.count(s)) for s in sorted(set(symbols))]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)],
                                                 names=["token", "n"])

    files = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").select("name")
    counts = files.repartition(parts_of(spark), "name").mapInArrow(run, "token bigint, n bigint")
    return counts.groupBy("token").agg(F.sum("n").alias("n")).where("n > 0")


def find_token(spark: SparkSession, path: str, symbol: int) -> DataFrame:
    """(shard, place, doc_id, at) of each occurrence of an id: its place in its file, and the ids
    of its document before it. Files and blocks without it are not read."""
    schema = pa.schema([("shard", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        for batch in batches:
            for shard, name in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                with store.open_input_file(f"{folder}/{name}") as stream:
                    file = TokenFile(stream)
                    total = file.count(symbol)
                    for first in range(0, total, 4096):
                        places = [file.find(symbol, k) for k in range(first, min(first + 4096, total))]
                        rows = [(shard, p, *file.document(p)) for p in places]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").select("shard", "name")
    return files.repartition(parts_of(spark), "name").mapInArrow(
        run, "shard int, place bigint, doc_id bigint, at bigint")


def op6_wavelet_tokens(spark, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)
