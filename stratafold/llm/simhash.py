"""Near-duplicate documents by SimHash fingerprints and an index of their bytes by position.

Two fingerprints with at most three differing bits share at least five of their eight
bytes by position. The index holds each fingerprint under sets of four positions, chosen so
that any five positions contain one of them; fingerprints met in one posting list are
tallied for shared bytes, pairs below five are dropped and the rest verified bit by bit.
A list longer than a block is parted by further equal bytes, then by equal half-bytes,
after which it can't be longer; so no pair is lost and no list is unbounded.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, types as T
from pyspark.sql import functions as F

from stratafold.llm.common import stored, table, with_columns_by_batch
from stratafold.llm.graph import components

MAX_BITS = 3
SHINGLE = 3
BLOCK = 4096
_BYTES, _SHARED = 8, 5
_SEED = 42


def _byte_mask(positions) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def _index_sets() -> list[tuple[int, ...]]:
    """Sets of four of the eight positions such that any five positions contain one."""
    left, chosen = set(combinations(range(_BYTES), _SHARED)), []
    while left:
        best = max(combinations(range(_BYTES), 4), key=lambda s: sum(set(s) <= set(c) for c in left))
        chosen.append(best)
        left = {c for c in left if not set(best) <= set(c)}
    return chosen


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


MASKS = [_signed(_byte_mask(s)) for s in _index_sets()]


def finer_masks(mask: int) -> list[int]:
    """The masks that part a list too long for one block.

    Of the four bytes outside a first mask one is equal; of the six half-bytes outside such
    a five-byte mask three are, which leaves 12 bits, that is 4096 fingerprints.
    """
    mask &= (1 << 64) - 1
    free = [p for p in range(_BYTES) if not mask >> (8 * p) & 0xFF]
    if len(free) == 4:
        return [_signed(mask | _byte_mask([p])) for p in free]
    halves = [0xF << (8 * p + s) for p in free for s in (0, 4)]
    return [_signed(mask | sum(c)) for c in combinations(halves, 3)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles' XXH64, as a signed 64-bit number; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    first, last = (ends - size)[:len(words) - k + 1], ends[k - 1:]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), 8192):
        h = np.fromiter((digest(joined[a:b], _SEED) for a, b in
                         zip(first[at:at + 8192].tolist(), last[at:at + 8192].tolist())), "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(first), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows with ``fingerprint``, a long; a null text counts as an empty one (0)."""
    def compute(batch: pa.RecordBatch) -> list:
        texts = batch.column(batch.schema.get_field_index(text_col))
        return [pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())]

    return with_columns_by_batch(docs, [T.StructField("fingerprint", T.LongType())], compute)


def linked(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that tie together all fingerprints of one list that are linked in it.

    A walk over the links: each fingerprint reached is compared with those not reached yet,
    in a tally of shared bytes first, so there are fewer edges than fingerprints.
    """
    left, out = fps, []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            differ = left ^ one
            tally = (differ.view(np.uint8).reshape(-1, _BYTES) == 0).sum(1)
            near = tally >= _BYTES - max_bits
            near[near] = np.bitwise_count(differ[near].view(np.uint64)) <= max_bits
            if near.any():
                found = left[near]
                out.append((np.full(len(found), one), found))
                queue.extend(found)
                left = left[~near]
    return out


def _walk_lists(batches, max_bits: int):
    """Edges (deeper false) of the lists in sorted (mask, fingerprint) rows; a list over a
    block gives its rows back under finer masks (deeper true). Holds one block and a batch."""
    mask, fps, long = np.zeros(0, np.int64), np.zeros(0, np.int64), False

    def emit(a, b, deeper):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                           pa.array(np.full(len(a), deeper))], names=["a", "b", "deeper"])

    def finer(mask, fps):
        masks = np.array(finer_masks(int(mask)), np.int64)
        for at in range(0, len(fps), 8192):
            part = fps[at:at + 8192]
            yield emit(np.repeat(part, len(masks)), np.tile(masks, len(part)), True)

    def take(mask, fps, long):
        edges = []
        start = np.flatnonzero(np.concatenate(
            [[True], (mask[1:] != mask[:-1]) | ((fps[1:] & mask[1:]) != (fps[:-1] & mask[:-1]))]))
        stop = np.append(start[1:], len(mask))
        for i in np.flatnonzero(stop - start > 1) if not long else np.flatnonzero((stop - start > 1) | (start == 0)):
            a, b = start[i], stop[i]
            if b - a > BLOCK or (long and a == 0):
                yield from finer(mask[a], fps[a:b])
            else:
                edges += linked(fps[a:b], max_bits)
        if edges:
            yield emit(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]), False)

    for batch in batches:
        mask = np.concatenate([mask, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy()])
        if not len(mask):
            continue
        same = (mask == mask[-1]) & ((fps & mask) == (fps[-1] & mask[-1]))
        tail = len(mask) - int(same.sum())
        if tail:
            yield from take(mask[:tail], fps[:tail], long)
            mask, fps, long = mask[tail:], fps[tail:], False
        if len(fps) > BLOCK:
            yield from finer(mask[0], fps)
            mask, fps, long = mask[:0], fps[:0], True
            rest = (batch.column(0)[-1].as_py(), batch.column(1)[-1].as_py())
        if long and not len(fps):
            # Keep one row, already given back, so that the list is known when it goes on.
            mask, fps = np.array([rest[0]], np.int64), np.array([rest[1]], np.int64)
    if len(mask):
        yield from take(mask, fps, long)


def near_edges(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all pairs within ``max_bits``.

    ``fps`` has one column ``fp`` of distinct longs. The edges need not hold every pair, but
    two fingerprints are connected by them if and only if a chain of near pairs connects them.
    """
    masks = F.explode(F.array(*[F.lit(m).cast("bigint") for m in MASKS]))
    rows, edges = fps.select(masks.alias("mask"), "fp"), []
    while True:
        lists = rows.withColumn("shared", F.col("fp").bitwiseAND(F.col("mask")))
        lists = lists.repartition("mask", "shared").sortWithinPartitions("mask", "shared", "fp")
        found = stored(lists.select("mask", "fp").mapInArrow(
            lambda batches: _walk_lists(batches, max_bits), "a bigint, b bigint, deeper boolean"), "links")
        edges.append(found.where("not deeper").select("a", "b"))
        rows = found.where("deeper").select(F.col("b").alias("mask"), F.col("a").alias("fp")).distinct()
        if rows.isEmpty():
            break
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, ``fingerprint`` as a long, ``component_id``) of every row of ``docs``.

    Rows link if their fingerprints differ in at most ``max_bits`` (up to three) bits; the
    component is named by its smallest id. Null and empty texts have fingerprint 0 and link
    like any other. Repeated rows come out as often as they come in. Null ids never name a
    component; one of null ids only is named null.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the index finds up to three differing bits")
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    prints = stored(with_fingerprint(own, "_text", shingle).drop("_text"), "fingerprints")
    of = _least_of_groups(prints, "_id", max_bits).withColumnRenamed("least", "component_id")
    return prints.join(of, prints["fingerprint"] == of["fp"], "left").select(
        F.col("_id").alias(id_col), "fingerprint", "component_id")


def _least_of_groups(prints: DataFrame, column: str, max_bits: int) -> DataFrame:
    """(fp, least): by fingerprint, the least value of a column among all rows of its group."""
    least = stored(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(column).alias("least")), "least")
    roots = stored(components(near_edges(least.select("fp"), max_bits)), "roots")
    names = (roots.join(least, roots["node"] == least["fp"]).groupBy("root").agg(F.min("least").alias("name")))
    named = roots.join(names, "root").select(F.col("node"), "name")
    return least.join(named, least["fp"] == named["node"], "left").select(
        "fp", F.coalesce("name", "least").alias("least"))


def hex_of(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near duplicates, with its columns.

    It is the row with the smallest id, and of rows with that id the one whose text has the
    smallest hash; rows without an id come last. So rows of one id in different groups all stay.
    Of rows with the same id and text that with the smallest hash of all its columns stays.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the index finds up to three differing bits")
    tag = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                   F.sha1(F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))).alias("text"),
                   F.col(text_col).isNull().alias("empty"))
    prints = stored(with_fingerprint(docs.select(F.col(text_col).alias("_text"), tag.alias("_tag")), "_text", shingle)
                    .drop("_text"), "fingerprints")
    keep = stored(_least_of_groups(prints, "_tag", max_bits).select(F.col("least").alias("_keep")).distinct(), "keep")
    kept = docs.withColumn("_tag", tag).join(keep, F.col("_tag") == F.col("_keep"), "left_semi")
    again = prints.groupBy("_tag").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not again.join(keep, F.col("_tag") == F.col("_keep"), "left_semi").isEmpty():
        first = Window.partitionBy("_tag").orderBy(F.xxhash64(*docs.columns))
        kept = kept.withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    return kept.select(*docs.columns)


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", hex_of("fingerprint").alias("fingerprint"), "component_id")
