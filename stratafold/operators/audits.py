"""Non-blocking data-quality checks: each returns the violating rows of a table.

``summarise`` runs a whole suite: the key, nulls and lengths of a table share one scan
and one shuffle, orphans are counted per distinct reference value. Nulls and lengths that were
measured while a table was written are not counted again; its key alone is read then.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.contract import TableContract
from stratafold.functions.rows import rows_frame
from stratafold.operators import joins
from stratafold.session import new_folder

#: Repeated hashes of a wide key that are broadcast at most, eight bytes each.
MOST_REPEATED = 1 << 20


def pk_not_null(df: DataFrame, pk: str) -> DataFrame:
    return df.where(F.col(pk).isNull())


def pk_unique(df: DataFrame, *pk: str) -> DataFrame:
    """Key values that occur more than once, with their count; NULL keys form one group."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def repeated_keys(df: DataFrame, *pk: str, most: int = MOST_REPEATED) -> DataFrame:
    """``pk_unique`` for wide keys (long texts, many columns): only suspects are moved whole.

    A first pass counts 64-bit hashes of the key and stores those seen twice; the second groups the
    rows with such a hash by the key itself, so keys that only share a hash are told apart. It reads
    the frame twice, and the first pass runs when this is called. With more than ``most``
    repeated hashes the key is grouped directly: the rows are the same either way.
    """
    name = "_hash"
    while name in {c.lower() for c in df.columns}:
        name = "_" + name
    counted = df.groupBy(_key_hash(pk).alias(name)).agg(F.count(F.lit(1)).alias("cnt"))
    folder = new_folder(df.sparkSession, "repeated_keys")
    counted.where("cnt > 1").select(name).write.parquet(folder)
    repeated = df.sparkSession.read.schema(f"{name} bigint").parquet(folder)
    if repeated.count() > most:
        return pk_unique(df, *pk)
    suspects = df.select(*pk).join(F.broadcast(repeated), _key_hash(pk) == F.col(name), "left_semi")
    return pk_unique(suspects, *pk)


def _key_hash(pk: Iterable[str]) -> F.Column:
    return F.xxhash64(*pk)


def max_length(df: DataFrame, column: str, length: int) -> DataFrame:
    return df.where(F.length(F.col(column).cast("string")) > length)


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    return joins.orphans(child, fk, parent, pk)


@dataclass(frozen=True)
class Audit:
    """One named check of a table; ``limit`` is a length, ``parent`` a (table, key) pair."""

    table: str
    name: str
    kind: str
    column: str
    limit: int | None = None
    parent: tuple[str, str] | None = None

    @property
    def key(self) -> str:
        """What the check counts, for a count taken earlier."""
        return "|".join(map(str, (self.table, self.name, self.kind, self.column, self.limit)))

    @property
    def measure(self) -> F.Column | None:
        """The violations as one aggregate over the table's rows; None if rows must be compared."""
        if self.kind == "pk_not_null":
            return F.count_if(F.col(self.column).isNull())
        if self.kind == "max_length":
            return F.count_if(F.length(F.col(self.column).cast("string")) > self.limit)
        return None

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.kind == "pk_not_null":
            return pk_not_null(df, self.column)
        if self.kind == "pk_unique":
            return pk_unique(df, *self.column.split(", "))
        if self.kind == "max_length":
            return max_length(df, self.column, self.limit)
        return fk_orphans(df, self.column, tables[self.parent[0]], self.parent[1])


def audits_for(contract: TableContract, parents: Mapping[str, str] | None = None,
               lengths: Mapping[str, str] | None = None,
               targets: Mapping[str, str] | None = None) -> list[Audit]:
    """The checks a contract implies.

    ``parents`` maps the tables that can be looked up to their key; ``targets``
    replaces the declared table of a reference column; ``lengths`` restricts the
    length checks to some columns and gives the short name used for each.
    """
    table, audits = contract.name, []
    for key in contract.pk:
        audits.append(Audit(table, f"assert_{table}_pk_not_null", "pk_not_null", key))
    if contract.pk:
        audits.append(Audit(table, f"assert_{table}_pk_unique", "pk_unique", ", ".join(contract.pk)))
    for column in contract.columns:
        if column.max_length and (lengths is None or column.name in lengths):
            label = (lengths or {}).get(column.name, column.name)
            audits.append(Audit(table, f"assert_{table}_{label}_max_length", "max_length",
                                column.name, limit=column.max_length))
    for reference in contract.references:
        parent = (targets or {}).get(reference.column, reference.table)
        if parent in (parents or {}):
            name = f"assert_fk_{table}_{parent}"
            if any(a.name == name for a in audits):  # a second reference to the same parent
                name += f"_{reference.column}"
            audits.append(Audit(table, name, "fk_orphan",
                                reference.column, parent=(parent, parents[parent])))
    return audits


SUMMARY = ("table_name", "audit", "kind", "column_name", "violations")


def _row(audit: Audit, violations) -> F.Column:
    named = [F.lit(text) for text in (audit.table, audit.name, audit.kind, audit.column)]
    return F.struct(*[c.alias(n) for c, n in zip([*named, violations], SUMMARY)])


def _unpivot(df: DataFrame, rows: list) -> DataFrame:
    return df.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _table_counts(df: DataFrame, audits: list[Audit]) -> list[DataFrame]:
    """Nulls, duplicates and over-long values of one table.

    One grouping for each distinct key; the first also carries the nulls and lengths, so a
    table with one key takes one scan and one shuffle.
    """
    zero = F.lit(0).cast("bigint")
    key_sets = list(dict.fromkeys(
        tuple(sorted(a.column.split(", "))) for a in audits if a.kind == "pk_unique"))
    counts = {i: a.measure for i, a in enumerate(audits) if a.kind != "pk_unique"}
    parts = []
    for at, keys in enumerate(key_sets or [()]):
        carried = counts if at == 0 else {}
        per_key = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("cnt"), *[v.alias(f"n_{i}") for i, v in carried.items()])
        counted = per_key.agg(
            F.count_if(F.col("cnt") > 1).alias("repeated"),
            *[F.coalesce(F.sum(f"n_{i}"), zero).alias(f"n_{i}") for i in carried])
        own = [a for a in audits if a.kind == "pk_unique"
               and tuple(sorted(a.column.split(", "))) == keys]
        parts.append(_unpivot(counted, [_row(a, F.col("repeated")) for a in own]
                              + [_row(audits[i], F.col(f"n_{i}")) for i in carried]))
    return parts


def _orphan_count(audit: Audit, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphans by distinct reference value, so a value held by many rows costs one row."""
    parent, pk = audit.parent
    values = (
        tables[audit.table].where(F.col(audit.column).isNotNull())
        .groupBy(F.col(audit.column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    )
    known = tables[parent].select(F.col(pk).alias("_known")).distinct()
    lost = values.join(known, F.col("_value") == F.col("_known"), "left_anti")
    total = lost.agg(F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint")).alias("lost"))
    return _unpivot(total, [_row(audit, F.col("lost"))])


def summarise(tables: Mapping[str, DataFrame], audits: Iterable[Audit],
              measured: Mapping[str, int] | None = None) -> DataFrame:
    """One row per audit: how many violations, and whether it passed.

    ``measured`` has, by ``Audit.key``, the violations counted when a table was written.
    """
    audits, measured = list(audits), measured or {}
    known = [(a.table, a.name, a.kind, a.column, measured[a.key]) for a in audits if a.key in measured]
    audits = [a for a in audits if a.key not in measured]
    parts = []
    if known:
        spark = next(iter(tables.values())).sparkSession
        parts.append(rows_frame(spark, known, "table_name string, audit string, kind string, "
                                              "column_name string, violations bigint"))
    for table in dict.fromkeys(a.table for a in audits):
        own = [a for a in audits if a.table == table and a.kind != "fk_orphan"]
        if own:
            parts += _table_counts(tables[table], own)
    parts += [_orphan_count(a, tables) for a in audits if a.kind == "fk_orphan"]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)


def all_passed(summary: DataFrame) -> DataFrame:
    """The whole suite as one flag."""
    return summary.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"))
