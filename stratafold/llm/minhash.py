"""Document fingerprints by one-permutation MinHash, in built-in functions only.

Each text's word shingles are hashed once. The top bits of a hash name one of the bins, the
rest is its value there, and a bin keeps its least value. An empty bin takes the value of the
bin that its own fixed sequence of probes reaches first (optimal densification). The
fingerprint packs the low byte of each bin's value; two fingerprints' share of equal bytes,
corrected for chance, estimates the Jaccard likeness of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import parts_of, sampled_splits, table

BINS_LOG2 = 7
BINS = 1 << BINS_LOG2
SHINGLE = 5
ROWS_A_BUCKET = 1000
MOST_BUCKETS = 16_384
_SPACES = " \t\n\x0b\x0c\r"
_VALUE_BITS = 63 - BINS_LOG2
_EMPTY = (1 << _VALUE_BITS) - 1
_PROBES = 12


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    """The lower-cased words of a text that has at least one."""
    return F.split(F.lower(text), r"[ \t\n\x0B\f\r]+")


def _shingle_hashes(words: Column, shingle: int) -> Column:
    """63-bit hashes of the word shingles; fewer words than one shingle count as one."""
    def hashes(word: Column) -> Column:
        last = F.greatest(F.size(word) - shingle, F.lit(0))
        here = [F.get(word, i) for i in range(shingle)]
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.shiftrightunsigned(
            F.xxhash64(*[F.get(word, i + k) for k in range(len(here))]), 1))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), hashes)


def _bins(hashes: Column) -> Column:
    """The least hash of each bin in bin order; a mark that sorts last fills an empty bin."""
    marks = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.shiftleft(
        i.cast("bigint"), _VALUE_BITS).bitwiseOR(F.lit(_EMPTY)))

    def first_of_bin(rows: Column) -> Column:
        bin_of = lambda i: F.shiftright(F.get(rows, i), _VALUE_BITS)
        return F.filter(rows, lambda row, i: (i == 0) | (F.shiftright(row, _VALUE_BITS) != bin_of(i - 1)))

    return _let(F.sort_array(F.concat(hashes, marks)), first_of_bin)


def _densified(bins: Column) -> Column:
    """The low byte of every bin's value, empty bins filled from the bins that their probes reach."""
    def low(rows: Column, i: Column) -> Column:
        value = F.get(rows, i).bitwiseAND(F.lit(_EMPTY))
        return F.when(value != _EMPTY, value.bitwiseAND(F.lit(255)))

    def fill(rows: Column) -> Column:
        def probe(i: Column, k: int) -> Column:
            return F.pmod(F.hash(i, F.lit(k)), F.lit(BINS))

        def any_full(i: Column) -> Column:
            full = F.filter(rows, lambda v: v.bitwiseAND(F.lit(_EMPTY)) != _EMPTY)
            order = F.array_min(F.transform(full, lambda v: F.struct(
                F.xxhash64(i, F.shiftright(v, _VALUE_BITS)), v.bitwiseAND(F.lit(255)))))
            return order["col2"]

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.coalesce(
            low(rows, i), *[low(rows, probe(i, k)) for k in range(_PROBES)], any_full(i)))

    return _let(bins, fill)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The packed fingerprint in lower-case hex, two digits a bin; "" for a text without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    digits = F.lit([f"{v:02x}" for v in range(256)])
    packed = F.array_join(F.transform(
        _densified(_bins(_shingle_hashes(_words(trimmed), shingle))),
        lambda v: F.get(digits, v.cast("int"))), "")
    return F.when(trimmed == "", F.lit("")).otherwise(packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints, 0 to 1.

    Two texts without words are alike (1), one of them is like no other text (0). Low bytes
    also agree by chance once in 256, which the estimate takes off.
    """
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substring(
        a, i * 2 + 1, F.lit(2)) == F.substring(b, i * 2 + 1, F.lit(2))))
    chance = 1 / 256
    estimate = (same / F.lit(float(BINS)) - chance) / (1 - chance)
    return (F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
            .otherwise(F.greatest(estimate, F.lit(0.0))))


def _bucket(key: Column, splits: list[int]) -> Column:
    """How many of the ascending splits are at most the key, less one: by coarse, then fine steps."""
    step = max(1, int(len(splits) ** 0.5))
    coarse = F.lit(splits[::step]).cast("array<bigint>")
    fine = F.lit(splits).cast("array<bigint>")
    start = F.greatest(F.size(F.filter(coarse, lambda s: s <= key)) - 1, F.lit(0)) * step
    return start + F.size(F.filter(F.slice(fine, start + 1, F.lit(step)), lambda s: s <= key)) - 1


def with_next(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Each row with ``next_<column>`` of the row that follows by id, the last with the first's.

    Rows go to buckets of id ranges that start at existing ids, and the first row of a bucket
    goes to the bucket before as well, so no bucket needs another. Rows without an id come
    first; rows of one id follow each other in the order of the named columns' hash.
    """
    spark = df.sparkSession
    least = -(1 << 63)
    keyed = df.withColumn("_key", F.coalesce(F.col(id_col).cast("bigint"), F.lit(least)))
    rows = keyed.count()
    buckets = min(MOST_BUCKETS, max(parts_of(spark), rows // ROWS_A_BUCKET))
    splits = sampled_splits(keyed, "_key", buckets)
    if not splits:
        return df.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    own = _bucket(F.col("_key"), splits)
    starts = {key: i for i, key in enumerate(splits)}
    before = F.when(F.array_contains(F.lit(splits).cast("array<bigint>"), F.col("_key")),
                    F.pmod(F.col("_own") - 1, F.lit(len(starts))))
    placed = keyed.withColumn("_own", own).withColumn("_before", before).withColumn(
        "_place", F.explode(F.array_compact(F.array(
            F.struct(F.col("_own").alias("bucket"), F.lit(False).alias("guest")),
            F.when(F.col("_before").isNotNull(),
                   F.struct(F.col("_before").alias("bucket"), F.lit(True).alias("guest")))))))
    placed = placed.select(*df.columns, "_key", "_place.*")
    follow = "partition by bucket order by guest, _key, xxhash64(" + ", ".join(f"`{c}`" for c in columns) + ")"
    ahead = [F.expr(f"lead(`{c}`) over ({follow})").alias(f"next_{c}") for c in columns]
    return placed.select("*", *ahead).where("not guest").drop("_key", "bucket", "guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, ``text``, ``fingerprint``) of each row; a null text counts as an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), text.alias("text")).withColumn(
        "fingerprint", fingerprint(F.col("text"), shingle))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE) -> DataFrame:
    """Each row's fingerprint against that of an edited text and that of the next row's text.

    The edited text has its last quarter of code points replaced by the first as many (or
    all) of the next text by id. Equal texts have equal fingerprints.
    """
    rows = with_next(fingerprints(docs, id_col, text_col, shingle), id_col, ["text", "fingerprint"])
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter),
                      F.substring(F.col("next_text"), F.lit(1), quarter))
    made = (
        rows.withColumn("n_chars", F.length("text").cast("bigint"))
        .withColumn("edited", edited)
        .withColumn("edited_fingerprint", fingerprint(F.col("edited"), shingle))
        .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    )
    return made.select(
        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op3_minhash(spark, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))
