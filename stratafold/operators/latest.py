"""Staging: the latest load of a raw table, narrowed to the columns in use."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.sources.raw import LOAD_ID


def latest_load(raw: DataFrame, by: str = LOAD_ID, loads: DataFrame | None = None) -> DataFrame:
    """Rows of the newest load of this table.

    Newest is the greatest value of ``by``; load ids are text, so '9' is newer than
    '10'. The comparison is a scalar subquery, which Spark turns into partition
    pruning when the table is partitioned by ``by``. ``loads`` (one column ``by``)
    saves the scan that looks for the maximum.
    """
    newest = (raw if loads is None else loads).agg(F.max(by)).scalar()
    return raw.where(F.col(by) == newest)


def staging(raw: DataFrame, columns: Iterable[str], parsed: Mapping[str, Column] | None = None,
            loads: DataFrame | None = None) -> DataFrame:
    """The latest load, narrowed to ``columns`` plus its load id."""
    parsed = parsed or {}
    kept = [parsed[name].alias(name) if name in parsed else F.col(name) for name in columns]
    return latest_load(raw, loads=loads).select(*kept, LOAD_ID)
