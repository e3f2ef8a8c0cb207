"""Log-probabilities of texts under a bigram model with Katz backoff.

Counts are discounted by Good-Turing; a history's freed mass goes to the words not seen after
it, in proportion to their unigram probability, with a weight that makes the sum exactly one.

Texts are cut into blocks of whole documents. A block sends its distinct words and word pairs,
as sorted 64-bit hashes with their training counts, to hash buckets; so a frequent word or
pair arrives once a block at most. A bucket keeps its part of the n-gram tables and answers
each block in the order of what it sent, so answers hold no keys. The first block of the
answer's list that has a training pair owns it and adds it to its history's sums, from which
the buckets of the histories give the backoff weights, again in order.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import bucket_of_id, stored, table
from stratafold.llm.warc import open_folder
from stratafold.session import new_folder

BLOCK_TOKENS = 1 << 21
BUCKET_TOKENS = 1 << 19
LEAST_BUCKETS = 256
CUT = 5  # counts up to this one are discounted
END = 1  # hash of the end token; it also is the history of a text's first token
_ZSTD = 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(33))


def pack_array(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=_ZSTD).compress(planes.tobytes())


def unpack_array(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes as their differences."""
    return pack_array(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_array(data, np.uint64), dtype=np.uint64)


def _small(values: np.ndarray) -> tuple[bytes, int]:
    """Non-negative whole numbers in the smallest width that holds them."""
    top = int(values.max(initial=0))
    dtype = next(d for d in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(d).max)
    return pack_array(values.astype(dtype)), np.dtype(dtype).itemsize


def _unsmall(data: bytes, width: int) -> np.ndarray:
    return unpack_array(data, f"<u{width}").astype(np.int64)


@dataclass
class Block:
    """Whole documents: sizes and training marks, distinct words, and the words of each token."""

    sizes: np.ndarray
    train: np.ndarray
    words: np.ndarray  # ascending hashes, END first
    tokens: np.ndarray  # places in ``words``

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending hashes of the distinct (history, word) pairs, a token of each, each token's pair."""
        history = self.history()
        key = _mix(_mix(self.words)[history] * np.uint64(3) + self.words[self.tokens])
        return np.unique(key, return_index=True, return_inverse=True)

    def history(self) -> np.ndarray:
        out = np.empty_like(self.tokens)
        out[1:] = self.tokens[:-1]
        out[:1] = 0
        return out

    def trained(self) -> np.ndarray:
        return np.repeat(self.train, self.sizes)

    def dump(self) -> bytes:
        tokens, width = _small(self.tokens)
        buffer = io.BytesIO()
        np.savez(buffer, sizes=self.sizes, train=self.train, words=np.frombuffer(pack_keys(self.words), np.uint8),
                 tokens=np.frombuffer(tokens, np.uint8), width=width)
        return buffer.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Block":
        found = np.load(io.BytesIO(data))
        return cls(found["sizes"], found["train"], unpack_keys(found["words"].tobytes()),
                   _unsmall(found["tokens"].tobytes(), int(found["width"])))


def hashes_of(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words of a text, then that of the end."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def _blocks(docs: DataFrame, path: str) -> DataFrame:
    """(block, file, ids, held, tokens, train_tokens) of each block, its content in a file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(path)
        store.create_dir(folder, recursive=True)
        number, held = TaskContext.get().partitionId() << 24, []

        def flush():
            nonlocal number, held
            ids, out, train, hashes = (list(c) for c in zip(*held))
            sizes = np.array([len(h) for h in hashes])
            words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            block = Block(sizes, np.array(train, bool), words, tokens)
            name = f"block-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{folder}/{name}", compression=None) as stream:
                stream.write(block.dump())
            row = (number, name, ids, out, int(sizes.sum()), int(sizes[block.train].sum()))
            number, held = number + 1, []
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]]), pa.array([row[1]]), pa.array([row[2]], pa.list_(pa.int64())),
                 pa.array([row[3]], pa.list_(pa.bool_())), pa.array([row[4]]), pa.array([row[5]])],
                names=["block", "file", "ids", "held", "tokens", "train_tokens"])

        total = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(batch.column(i).slice(at, 256).to_pylist() for i in range(4))):
                    hashes = hashes_of(row[3])
                    held.append((*row[:3], hashes))
                    total += len(hashes)
                    if total >= BLOCK_TOKENS:
                        yield flush()
                        total = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "block bigint, file string, ids array<bigint>, held array<boolean>, "
                                "tokens bigint, train_tokens bigint")


def _cut_by_bucket(keys: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """The buckets (top bits) of ascending keys and where each one's keys are."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    start = np.flatnonzero(np.diff(bucket, prepend=-1))
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(start, [*start[1:], len(keys)])]


_SENT = "kind int, bucket bigint, block bigint, keys binary, a binary, a_width int, b binary"


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(),
             "boolean": pa.bool_(), "double": pa.float64()}
    columns = list(zip(*rows)) or [()] * len(ddl.split(", "))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[d.split()[1]]) for c, d in zip(columns, ddl.split(", "))],
                                      names=[d.split()[0] for d in ddl.split(", ")])


def _groups(batches, at: int) -> Iterator[tuple[int, list[tuple]]]:
    """Runs of rows with one value in a column, from rows sorted by it."""
    key, rows = None, []
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for row in zip(*(c.slice(start, 256).to_pylist() for c in batch.columns)):
                if rows and row[at] != key:
                    yield key, rows
                    rows = []
                key = row[at]
                rows.append(row)
    if rows:
        yield key, rows


@dataclass(frozen=True)
class Discounts:
    """Good-Turing factors of counts 1 to CUT; larger counts keep all their weight."""

    factors: tuple[float, ...]

    @classmethod
    def of(cls, n: list[int]) -> "Discounts":
        """From the numbers of types seen 1, 2, ... CUT + 1 times. Where these give a factor
        outside (0, 1], all factors are those of one absolute discount instead."""
        n = [float(v) for v in n]
        out = []
        if all(n):
            common = (CUT + 1) * n[CUT] / n[0]
            out = [((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) if common != 1 else 0
                   for r in range(1, CUT + 1)]
        if not out or not all(0 < d <= 1 for d in out):
            off = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
            off = min(max(off, 0.1), 0.9)
            out = [(r - off) / r for r in range(1, CUT + 1)]
        return cls(tuple(out))

    def apply(self, count: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return count * np.array([0.0, *self.factors, 1.0])[np.minimum(count, CUT + 1)]


@dataclass(frozen=True)
class Unigrams:
    """Discounted word probabilities; all unseen words together are one more word."""

    tokens: int
    types: int
    discounts: Discounts
    unseen: float
    scale: float

    @classmethod
    def of(cls, tokens: int, types: int, n: list[int]) -> "Unigrams":
        discounts = Discounts.of(n)
        freed = sum(r * n[r - 1] * (1 - d) for r, d in enumerate(discounts.factors, 1))
        if not tokens:
            return cls(0, 0, discounts, 1.0, 0.0)
        if freed < 0.5:
            return cls(tokens, types, discounts, (freed + 1) / (tokens + 1), 1 / (tokens + 1))
        return cls(tokens, types, discounts, freed / tokens, 1 / tokens)

    def probability(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.discounts.apply(count) * self.scale, self.unseen)

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the add-one probabilities."""
        return np.log10((count + 1) / (self.tokens + self.types + 1))


def _count(sent: DataFrame) -> DataFrame:
    """The buckets' tables (kind 11, 12), their numbers of types by count (21, 22), and the
    answers (1, 2): each key's training count, and for pairs whether the block owns it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 0):
            kind, bucket = rows[0][1], rows[0][2]
            lists = [unpack_keys(r[4]) for r in rows]
            own = np.concatenate([_unsmall(r[5], r[6]) for r in rows])
            keys, at = np.unique(np.concatenate(lists), return_inverse=True)
            total = np.bincount(at, own, len(keys)).astype(np.int64)
            answer = total[at]
            if kind == 2:
                first = np.full(len(keys), len(at))
                given = np.flatnonzero(own)
                np.minimum.at(first, at[given], given)
                owner = np.zeros(len(at), bool)
                owner[first[first < len(at)]] = True
                answer = answer * 2 + owner
            out, start = [], 0
            for row, part in zip(rows, lists):
                out.append((kind, bucket, row[3], None, *_small(answer[start:start + len(part)]), None))
                start += len(part)
            seen = total > 0
            out.append((10 + kind, bucket, None, pack_keys(keys[seen]), *_small(total[seen]), None))
            types = np.bincount(np.minimum(total, CUT + 2), minlength=CUT + 3)
            out.append((20 + kind, bucket, None, None, *_small(np.append(types[1:CUT + 2], seen.sum())), None))
            yield _rows(out, _SENT)

    deal = sent.withColumn("place", F.col("kind") * (1 << 40) + F.col("bucket"))
    return deal.select("place", *sent.columns).repartition("place").sortWithinPartitions(
        "place", "block").mapInArrow(run, _SENT)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                held_out: tuple[int, int] = (7, 2)) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from the rows whose id's crc32 modulo ``held_out[0]`` is not ``held_out[1]``; a row
    without an id is scored but not learnt. A null text is empty: only the end token. Without
    training rows every token has probability 1. Repeated rows count each. A block holds
    documents of about ``BLOCK_TOKENS`` tokens, a longer one alone.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "katz")
    mark = bucket_of_id(id_col, held_out[0])
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"),
                       F.coalesce(mark == held_out[1], F.lit(False)).alias("h"),
                       F.coalesce(mark != held_out[1], F.lit(False)).alias("t"), F.col(text_col).alias("x"))
    blocks = stored(_blocks(rows, f"{path}/blocks"), "katz_blocks")
    tokens, train_tokens = (int(v or 0) for v in blocks.agg(F.sum("tokens"), F.sum("train_tokens")).first())
    bits = max(LEAST_BUCKETS, tokens // BUCKET_TOKENS).bit_length()

    def load(store, folder, name) -> Block:
        with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
            return Block.load(stream.read())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(f"{path}/blocks")
        for batch in batches:
            for number, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block = load(store, folder, name)
                trained = block.trained()
                pairs, _, pair = block.pairs()
                for kind, keys, at in ((1, block.words, block.tokens), (2, pairs, pair)):
                    count = np.bincount(at, trained, len(keys)).astype(np.int64)
                    yield _rows([(kind, bucket, number, pack_keys(keys[part]), *_small(count[part]), None)
                                 for bucket, part in _cut_by_bucket(keys, bits)], _SENT)

    counted = stored(_count(blocks.select("block", "file").mapInArrow(send, _SENT)), "katz_counts")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {21: np.zeros(CUT + 2, np.int64), 22: np.zeros(CUT + 2, np.int64)}
        for batch in batches:
            for kind, data, width in zip(*(c.to_pylist() for c in batch.columns)):
                out[kind] += _unsmall(data, width)
        yield _rows([(k, i, int(v)) for k, row in out.items() for i, v in enumerate(row)],
                    "kind int, at int, n bigint")

    found = counted.where("kind > 20").select("kind", "a", "a_width").mapInArrow(
        add, "kind int, at int, n bigint").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect()
    types = {21: [0] * (CUT + 2), 22: [0] * (CUT + 2)}
    for kind, at, n in found:
        types[kind][at] = int(n)
    words = Unigrams.of(train_tokens, types[21][-1], types[21][:-1])
    discounts = Discounts.of(types[22][:-1])

    files = blocks.select(
        F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("bucket"), "block",
        F.col("file").cast("binary").alias("keys"), F.lit(None).cast("binary").alias("a"),
        F.lit(0).alias("a_width"), F.lit(None).cast("binary").alias("b"))

    def answered(rows: list[tuple]):
        store, folder = open_folder(f"{path}/blocks")
        block = load(store, folder, bytes(rows[0][3]).decode())
        kinds = {k: [r for r in rows if r[0] == k] for k in (1, 2, 3)}
        word = np.concatenate([_unsmall(r[4], r[5]) for r in kinds[1]])
        pair = np.concatenate([_unsmall(r[4], r[5]) for r in kinds[2]])
        return block, word, pair >> 1, (pair & 1).astype(bool), kinds[3]

    def by_block(frame: DataFrame) -> DataFrame:
        return frame.repartition("block").sortWithinPartitions("block", "kind", "bucket")

    def histories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each history's discounted counts and unigram mass over the pairs that the block owns."""
        for number, rows in _groups(batches, 2):
            block, word, count, owned, _ = answered(rows)
            _, first, _ = block.pairs()
            token = first[owned]
            history = block.history()[token]
            n = len(block.words)
            mass = np.bincount(history, discounts.apply(count[owned]), n)
            below = np.bincount(history, words.probability(word[block.tokens[token]]), n)
            yield _rows([(3, bucket, number, pack_keys(block.words[part]), pack_array(mass[part]), 8,
                          pack_array(below[part])) for bucket, part in _cut_by_bucket(block.words, bits)], _SENT)

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each history the discounted and the unigram mass of all words seen after it."""
        for bucket, group in _groups(batches, 1):
            lists = [unpack_keys(r[3]) for r in group]
            keys, at = np.unique(np.concatenate(lists), return_inverse=True)
            mass = np.bincount(at, np.concatenate([unpack_array(r[4], np.float64) for r in group]), len(keys))
            below = np.bincount(at, np.concatenate([unpack_array(r[6], np.float64) for r in group]), len(keys))
            out, start = [], 0
            for row, part in zip(group, lists):
                here = at[start:start + len(part)]
                out.append((3, bucket, row[2], None, pack_array(mass[here]), 8, pack_array(below[here])))
                start += len(part)
            yield _rows(out, _SENT)

    answers = counted.where("kind < 10")
    sums = by_block(files.unionByName(answers)).mapInArrow(histories, _SENT)
    # Each list is sorted by block, so sums add up in one order however tasks are run again.
    backoff = sums.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(weights, _SENT)

    result = "block bigint, at bigint, n_tokens bigint, n_known bigint, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _groups(batches, 2):
            block, word, count, _, sums = answered(rows)
            mass = np.concatenate([unpack_array(r[4], np.float64) for r in sums])
            below = np.concatenate([unpack_array(r[6], np.float64) for r in sums])
            _, _, pair = block.pairs()
            history = block.history()
            known, after = word[block.tokens], word.astype(float)
            # A history seen in training has as many tokens after it as it has itself.
            safe = np.maximum(after, 1)
            left = 1 - mass / safe
            tight = left < 1e-9
            left = np.where(tight, 1 / (safe + 1), left)
            share = np.where(tight, safe / (safe + 1), 1.0) / safe
            alpha = np.where(after > 0, left / np.maximum(1 - below, words.unseen * 1e-6), 1.0)
            seen = count[pair]
            p = np.where(seen > 0, discounts.apply(seen) * share[history],
                         alpha[history] * words.probability(known))
            doc = np.repeat(np.arange(len(block.sizes)), block.sizes)
            n = len(block.sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number)), pa.array(np.arange(n)), pa.array(block.sizes),
                 pa.array(np.bincount(doc, known > 0, n).astype(np.int64)),
                 pa.array(np.bincount(doc, words.base(known), n)),
                 pa.array(np.bincount(doc, np.log10(p), n))],
                names=[c.split()[0] for c in result.split(", ")])

    scored = by_block(files.unionByName(answers).unionByName(backoff)).mapInArrow(score, result)
    names = blocks.select("block", F.posexplode(F.arrays_zip("ids", "held")).alias("at", "doc"))
    joined = scored.join(names.withColumn("at", F.col("at").cast("bigint")), ["block", "at"])
    return joined.select(
        F.col("doc.ids").alias(id_col), F.col("doc.held").alias("held_out"), "n_tokens", "n_known",
        F.lit(train_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def op7_katz_backoff(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
