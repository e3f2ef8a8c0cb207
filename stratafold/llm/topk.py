"""Exact top-k inner products by length order, rotated partial sums and residual bounds.

Vectors are rotated onto the axes of their second moments, so the first coordinates hold
most of a product. Candidates stand in blocks by descending length; a query's best scores in
the longest block give a first threshold. A pair of blocks, then a pair of vectors, is left
out where the Cauchy-Schwarz bound (lengths; partial sum plus the rests' lengths) can't reach
the threshold; what remains is scored exactly in whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratafold.llm.common import parts_of, range_index, sampled_splits, stored, table

K = 5
BLOCK = 4096
QUERY_BLOCK = 1024
MOST_RANGES = 4096
_SEED = 4096
_EXACT = 2.0 ** 53
_ORDINARY = 2.0 ** 31
_LONG = 1 << 63


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  factor: float = 256.0) -> DataFrame:
    """(id, v, norm): components turned to floor(factor * x); unusable vectors left out.

    Left out are rows without an id, null vectors, and vectors that hold a null, a NaN or an
    infinity, also one that ``factor * x`` comes to.
    """
    # Beyond 2 ** 53 a double is whole already, and beyond a long floor() would be cut off.
    scaled = lambda x: x.cast("double") * factor
    v = F.transform(F.col(vector_col), lambda x: F.when(F.abs(scaled(x)) < _EXACT, F.floor(scaled(x)).cast("double"))
                    .otherwise(scaled(x)))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()
                    & ~F.exists(vector_col, lambda x: bad(x.cast("double") * factor)))
    out = good.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return out.withColumn("norm", norm)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists as the rows of a matrix, short ones filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Axes of the second-moment matrix, the strongest first; one small matrix per task is added up."""
    def moments(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims * dims, dtype=np.int32)), pa.array(total.ravel())], names=["at", "s"])

    # Any axes give true bounds; very long vectors would only drown the others.
    ordinary = vectors.where(F.col("norm") < _ORDINARY)
    found = ordinary.select("v").mapInArrow(moments, "at int, s double").groupBy("at").agg(F.sum("s")).toArrow()
    total = np.zeros(dims * dims)
    total[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return np.linalg.eigh(total.reshape(dims, dims))[1][:, ::-1].copy()


def _large(x: np.ndarray) -> np.ndarray:
    """Rows whose products may leave the range in which longs are added without care."""
    with np.errstate(over="ignore"):
        return ~(np.sqrt((x * x).sum(1)) < _ORDINARY)


def exact_scores(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Inner products of the rows of a with those of b as longs, without rounding, and which of them
    a long can hold (None: all)."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < _EXACT:
        return (a @ b.T).astype(np.int64), None
    large_a, large_b = _large(a), _large(b)
    out = np.zeros((len(a), len(b)), np.int64)
    out[np.ix_(~large_a, ~large_b)] = a[~large_a].astype(np.int64) @ b[~large_b].astype(np.int64).T
    if not large_a.any() and not large_b.any():
        return out, None
    # Whole numbers of any size where one side is very long.
    holds = np.ones(out.shape, bool)
    as_whole = np.vectorize(int, otypes=[object])
    for rows, columns in ((large_a, np.ones(len(b), bool)), (~large_a, large_b)):
        if rows.any() and columns.any():
            found = as_whole(a[rows]) @ as_whole(b[columns]).T
            fits = np.vectorize(lambda s: -_LONG <= s < _LONG, otypes=[bool])(found)
            holds[np.ix_(rows, columns)] = fits
            out[np.ix_(rows, columns)] = np.where(fits, found, 0).astype(np.int64)
    return out, holds


def _best(ids: np.ndarray, scores: np.ndarray, own: int, floor: float, k: int, holds: np.ndarray | None = None):
    """The k best of one query's candidates that reach its floor, ties to the smaller id."""
    at = np.flatnonzero((scores >= floor) & (ids != own) & (True if holds is None else holds))
    if len(at) > 4 * k:
        cut = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= cut]
    order = np.lexsort((ids[at], -scores[at]))[:k]
    return ids[at[order]], scores[at[order]]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k largest inner products.

    Both frames have (id, v, norm) as from ``whole_vectors``; a candidate with the query's own
    id takes no part. Ties go to the smaller id, repeated candidates count each. Queries with
    fewer candidates than k return all; shorter vectors count as filled with zeros. A pair whose
    score is beyond a long has none, and only that pair is left out.
    """
    spark = candidates.sparkSession
    candidates, queries = stored(candidates, "candidates"), stored(queries, "queries")
    dims = candidates.unionByName(queries).agg(F.max(F.size("v"))).first()[0] or 1
    axes = _rotation(candidates, max(dims, 1))
    head = max(1, dims // 4)

    n = candidates.count()
    length = F.floor(F.least(F.col("norm") * 1024, F.lit(1e18))).cast("bigint")
    keyed = candidates.withColumn("near", -length)
    splits = sampled_splits(keyed, "near", min(MOST_RANGES, max(1, n // BLOCK))) or [0]
    keyed = keyed.withColumn("block", range_index(splits)("near"))
    # An id hash parts a range with more rows than a block, so many rows or ties can't swell one.
    parts = keyed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("bigint").alias("parts"))
    blocks = (
        keyed.join(F.broadcast(parts), "block")  # a row for each range
        .groupBy("block", F.pmod(F.xxhash64("id"), "parts").alias("part"))
        .agg(F.collect_list(F.struct("id", "v")).alias("rows"), F.max("norm").alias("longest"))
    )
    blocks = stored(blocks, "blocks")
    seed = candidates.orderBy(F.desc("norm"), "id").limit(max(_SEED, 2 * k)).agg(
        F.collect_list(F.struct("id", "v")).alias("rows"))
    m = queries.count()
    query_blocks = max(1, -(-m // QUERY_BLOCK))
    packed = queries.groupBy(F.pmod(F.xxhash64("id"), F.lit(query_blocks)).alias("qb")).agg(
        F.collect_list(F.struct("id", "v")).alias("own"), F.max("norm").alias("widest"))

    def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat = column.flatten()
        return flat.field(0).to_numpy(), _matrix(flat.field(1), dims)

    def floors(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = rows_of(batch.column(1).slice(i, 1))
                seeds, y = rows_of(batch.column(3).slice(i, 1))
                found, holds = exact_scores(x, y)
                least = []
                for j, (q, row) in enumerate(zip(ids, found)):
                    best = _best(seeds, row, q, -np.inf, k, None if holds is None else holds[j])[1]
                    least.append(float(best[-1]) if len(best) == k else -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), batch.column(2).slice(i, 1),
                     pa.array([least], pa.list_(pa.float64())), pa.array([min(least)])],
                    names=["qb", "own", "widest", "floors", "lowest"])

    kind = "array<struct<id:bigint,v:array<double>>>"
    # The one row of the longest vectors, at most _SEED, stands beside every block of queries.
    packed = stored(packed.withColumn("_one", F.lit(1)).join(
        F.broadcast(seed.withColumn("_one", F.lit(1))), "_one").select("qb", "own", "widest", "rows").mapInArrow(
        floors, f"qb bigint, own {kind}, widest double, floors array<double>, lowest double"), "query_blocks")

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, y = rows_of(batch.column(0).slice(i, 1))
                own, x = rows_of(batch.column(1).slice(i, 1))
                floor = batch.column(2)[i].values.to_numpy()
                # Very long vectors are never left out by a bound, which rounding could spoil.
                large_y, large_x = _large(y), _large(x)
                ry, rx = np.where(large_y[:, None], 0, y) @ axes, np.where(large_x[:, None], 0, x) @ axes
                rest_y = np.sqrt((ry[:, head:] ** 2).sum(1))
                rest_x = np.sqrt((rx[:, head:] ** 2).sum(1))
                slack = 1e-9 * (np.abs(rx).max(initial=1) * np.abs(ry).max(initial=1) * dims + 1) + 1e-6
                bound = rx[:, :head] @ ry[:, :head].T + rest_x[:, None] * rest_y[None, :] + slack
                bound[large_x], bound[:, large_y] = np.inf, np.inf
                alive = (bound >= floor[:, None]).any(0)
                alive_q = np.flatnonzero((bound >= floor[:, None]).any(1))
                if not len(alive_q):
                    continue
                found, holds = exact_scores(x[alive_q], y[alive])
                ids = ids[alive]
                out = [(own[q], *_best(ids, row, own[q], floor[q], k, None if holds is None else holds[j]))
                       for j, (q, row) in enumerate(zip(alive_q, found))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _ in out], [len(b) for _, b, _ in out]), pa.int64()),
                     pa.array(np.concatenate([b for _, b, _ in out]), pa.int64()),
                     pa.array(np.concatenate([s for _, _, s in out]), pa.int64())],
                    names=["query_id", "vec_id", "score"])

    # The pairs of blocks are thinned by their lengths alone; only what stays moves vectors.
    pairs = (
        blocks.select("block", "part", "longest", F.explode(
            F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>")).alias("qb"))
        .join(packed.select("qb", "widest", "lowest"), "qb")
        .where("longest * widest * 1.000001 + 1 >= lowest").select("block", "part", "qb")
    )
    pairs = (
        pairs.join(blocks.select("block", "part", "rows"), ["block", "part"])
        .join(packed.select("qb", "own", "floors"), "qb")
        .select("rows", "own", "floors").repartition(max(parts_of(spark), 1))
    )
    found = stored(pairs.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint"), "found")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_top_products(spark, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where("id % 50 = 0"), vectors)


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""
