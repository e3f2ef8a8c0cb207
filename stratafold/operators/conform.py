"""Projection of a frame onto a contract."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.contract import TableContract
from stratafold.functions.values import cast_to


def conform(df: DataFrame, contract: TableContract,
            mappings: Mapping[str, str | Column] | None = None, on_error: str = "fail",
            as_is: Iterable[str] = ()) -> DataFrame:
    """The contract's columns, in its order, as one projection.

    ``mappings`` gives the source of each mapped target column, as an SQL expression
    or a Column. Mapped columns are cast to the declared type, except those in
    ``as_is``; all others become typed NULLs. Text longer than declared is kept.
    """
    sources = {
        target.lower(): F.expr(source) if isinstance(source, str) else source
        for target, source in (mappings or {}).items()
    }
    unknown = sorted(set(sources) - set(contract.names))
    if unknown:
        raise ValueError(f"{contract.name} has no column {', '.join(unknown)}")
    found = df.select(*[source.alias(target) for target, source in sources.items()]).schema
    uncast = {name.lower() for name in as_is}

    def value(column) -> Column:
        if column.name not in sources:
            return F.lit(None).cast(column.type)
        if column.name in uncast:
            return sources[column.name]
        return cast_to(sources[column.name], found[column.name].dataType, column.type, on_error)

    return df.select(*[value(c).alias(c.name, metadata=c.metadata) for c in contract.columns])
