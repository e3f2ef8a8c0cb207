"""Declared shape of a table: columns, keys, references, descriptions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, types as T

from stratafold.functions.rows import rows_frame
from stratafold.functions.types import canonical_type, declared_length, spark_type


@dataclass(frozen=True)
class Column:
    name: str
    raw_type: str
    description: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "name", self.name.lower())

    @property
    def type(self) -> T.DataType:
        return spark_type(self.raw_type)

    @property
    def canonical(self) -> str:
        return canonical_type(self.raw_type)

    @property
    def max_length(self) -> int | None:
        return declared_length(self.raw_type)

    @property
    def metadata(self) -> dict:
        # Lengths stay out of the Spark type: a VARCHAR(n) column would block writes.
        items = {"declared_type": self.raw_type, "max_length": self.max_length,
                 "comment": self.description}
        return {key: value for key, value in items.items() if value is not None}


@dataclass(frozen=True)
class Reference:
    """A foreign-key column and the table and column it points at."""

    column: str
    table: str
    target: str

    def __post_init__(self):
        for name in ("column", "table", "target"):
            object.__setattr__(self, name, getattr(self, name).lower())


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Column, ...]
    pk: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    description: str | None = None
    source: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "name", self.name.lower())

    @classmethod
    def of(cls, name: str, columns: Iterable[tuple[str, str]], pk: Iterable[str] = (),
           references: Iterable[tuple[str, str, str]] = (), **more) -> "TableContract":
        return cls(name, tuple(Column(*column) for column in columns),
                   tuple(key.lower() for key in pk),
                   tuple(Reference(*reference) for reference in references), **more)

    @property
    def names(self) -> list[str]:
        return [column.name for column in self.columns]

    @property
    def reference_columns(self) -> list[str]:
        return [reference.column for reference in self.references]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True, c.metadata) for c in self.columns])

    def column(self, name: str) -> Column:
        return next(column for column in self.columns if column.name == name.lower())

    def widened(self) -> "TableContract":
        """INTEGER columns as BIGINT: the same canonical type, room for any key."""
        wide = tuple(
            replace(c, raw_type="BIGINT") if isinstance(c.type, T.IntegerType) else c
            for c in self.columns
        )
        return replace(self, columns=wide)

    def describe(self, prefix: str = "") -> str | None:
        """The description, or one made from the name of the declaring file."""
        if self.description:
            return self.description
        if not self.source:
            return None
        stem = re.sub(r"\.[^.]*$", "", self.source.replace("\\", "/").rsplit("/", 1)[-1])
        stem = re.sub(r"_(postgres|mysql|mssql|oracle)", "", stem)
        return prefix + stem.replace("__", " - ").replace("_", " ")


@dataclass
class ContractSet:
    """Contracts by name; a later declaration replaces an earlier one of that name."""

    contracts: dict[str, TableContract] = field(default_factory=dict)
    conflicts: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, declared: Iterable[TableContract]) -> "ContractSet":
        merged = cls()
        for contract in declared:
            known = merged.contracts.get(contract.name)
            if known is not None and known.columns != contract.columns:
                merged.conflicts.append(contract.name)
            merged.contracts[contract.name] = contract
        return merged

    def select(self, names: Iterable[str] | None = None) -> list[TableContract]:
        """All contracts, or those named in any letter case."""
        if names is None:
            return list(self.contracts.values())
        wanted = {name.lower() for name in names}
        return [contract for name, contract in self.contracts.items() if name in wanted]


CONTRACT_ROWS = ("table_name string, position int, column_name string, declared_type string, "
                 "canonical_type string, in_pk boolean, in_fk boolean, description string")


def contract_rows(spark: SparkSession, contracts: Iterable[TableContract]) -> DataFrame:
    """One row per declared column."""
    rows = [
        (contract.name, position, c.name, c.raw_type, c.canonical,
         c.name in contract.pk, c.name in contract.reference_columns, c.description)
        for contract in contracts
        for position, c in enumerate(contract.columns, start=1)
    ]
    return rows_frame(spark, rows, CONTRACT_ROWS)
