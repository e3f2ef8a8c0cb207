"""Stored layers: create, refresh, list, reset, and the run that chains them."""

from __future__ import annotations

import hashlib
import json
import re
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession

from stratafold.operators.audits import Audit
from stratafold.plans.models import Model
from stratafold.sources.raw import COMPRESSION, append_load, last_write, load_ids
from stratafold.sources.tables import row_limit

LAYERS = ("raw", "stg", "silver")
_FINGERPRINT = "stratafold.definition"
_SEEN = "stratafold.seen_loads"
_VERSION = "stratafold.version"
_PREVIOUS = "stratafold.previous"
_MEASURED = "stratafold.measured"
_IS_VERSION = re.compile(r"(.+)__v[0-9a-f]{12}$")
_PARALLEL_TABLES = 8

T = TypeVar("T")


def in_parallel(jobs: Iterable[Callable[[], T]]) -> list[T]:
    """Independent Spark jobs side by side, so that small tables do not wait for large ones."""
    with ThreadPoolExecutor(max_workers=_PARALLEL_TABLES) as pool:
        running = [pool.submit(job) for job in jobs]
        try:
            return [job.result() for job in running]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


@dataclass
class Layers:
    """The layer databases of one namespace, kept below ``root`` when one is given.

    A stored table is a view on one version of it, a table of its own. A full refresh writes the
    next version whole and then replaces the view, one catalog entry, so that readers find either
    the old rows or the new ones. The version before is kept for readers that began with it.
    """

    spark: SparkSession
    prefix: str = ""
    root: str | None = None

    def create(self, layers: Iterable[str] = LAYERS) -> "Layers":
        for layer in layers:
            place = f" LOCATION '{self.root}/{layer}'" if self.root else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}{place}")
        return self

    def reset(self, layers: Iterable[str] = LAYERS) -> None:
        """Drop the layers with all their tables."""
        for layer in layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{layer} CASCADE")

    def qualified(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.version(name) or self.qualified(name))

    def properties(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(name)}").collect()
        return {row.key: row.value for row in rows}

    def version(self, name: str) -> str | None:
        """The table that holds a stored table's present rows; None for tables stored otherwise."""
        return self.properties(name).get(_VERSION) if self.exists(name) else None

    def loads(self, name: str) -> DataFrame:
        return load_ids(self.spark, self.qualified(name))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    def tables(self, layer: str) -> list[str]:
        """Names of the stored tables of a layer, sorted; other views are left out."""
        listed = [t for t in self.spark.catalog.listTables(f"{self.prefix}{layer}") if not t.isTemporary]
        views = {t.name for t in listed if t.tableType == "VIEW"}
        plain = {t.name for t in listed} - views
        versions = {found[1] for found in map(_IS_VERSION.match, plain) if found}
        return sorted({name for name in plain if not _IS_VERSION.match(name)} | versions & views)

    def frames(self, layer: str) -> dict[str, DataFrame]:
        """The stored tables of a layer; tables without columns are left out."""
        frames = {name: self.table(f"{layer}.{name}") for name in self.tables(layer)}
        return {name: df for name, df in frames.items() if df.columns}

    def replace(self, df: DataFrame, name: str, definition: str = "", seen: Mapping[str, str] | None = None,
                audits: Iterable[Audit] = ()) -> None:
        """Full refresh of one table: the next version is written, then the view is moved to it.

        A write that fails leaves the old rows as they were. ``seen`` are the marks of the raw
        tables the rows were made from. The version before the last one is dropped. Those of the
        ``audits`` of this table that count rows one by one are measured while it is written.
        """
        target = self.qualified(name)
        version = f"{target}__v{uuid.uuid4().hex[:12]}"
        own = [a for a in audits if a.table == name.rsplit(".", 1)[-1] and a.measure is not None]
        watched = Observation()
        if own:
            df = df.observe(watched, *[a.measure.alias(f"m{i}") for i, a in enumerate(own)])
        try:
            df.write.option("compression", COMPRESSION).saveAsTable(version)
            measured = {a.key: watched.get[f"m{i}"] for i, a in enumerate(own)}
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
            raise
        known = self.exists(name)
        before = self.properties(name) if known else {}
        if known and _VERSION not in before:  # a plain table, stored otherwise
            self.spark.sql(f"DROP TABLE {target}")
        told = {_VERSION: version, _PREVIOUS: before.get(_VERSION, ""), _FINGERPRINT: definition,
                _SEEN: json.dumps(dict(seen or {}), sort_keys=True), _MEASURED: json.dumps(measured)}
        listed = ", ".join(f"'{key}' = '{value}'" for key, value in told.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {target} TBLPROPERTIES ({listed}) AS SELECT * FROM {version}")
        if before.get(_PREVIOUS):
            self.spark.sql(f"DROP TABLE IF EXISTS {before[_PREVIOUS]}")

    def drop_previous(self, name: str) -> None:
        """Gives up the version kept for readers of the rows before the last refresh."""
        previous = self.properties(name).get(_PREVIOUS)
        if previous:
            self.spark.sql(f"DROP TABLE IF EXISTS {previous}")

    def replace_all(self, frames: Mapping[str, DataFrame], audits: Iterable[Audit] = ()) -> None:
        """Full refresh of several tables that do not read each other."""
        audits = list(audits)
        in_parallel([lambda name=name, df=df: self.replace(df, name, audits=audits)
                     for name, df in frames.items()])

    def measured(self, layer: str) -> dict[str, int]:
        """The audits measured when the tables of a layer were written, by their keys."""
        told = [self.properties(f"{layer}.{name}").get(_MEASURED) for name in self.tables(layer)]
        return {key: count for found in told if found for key, count in json.loads(found).items()}

    def definition(self, name: str) -> str | None:
        return self.properties(name).get(_FINGERPRINT)

    def seen(self, name: str) -> dict[str, str]:
        """The marks of the raw tables that the stored rows were made from."""
        return json.loads(self.properties(name).get(_SEEN) or "{}")


@dataclass(frozen=True)
class Step:
    table: str
    action: str  # "load", "build" or "keep"
    reason: str
    rows: int | None = None


def _definition(model: Model, df: DataFrame) -> str:
    """A digest of what the model computes: its analysed plan, with columns numbered anew.

    The rows of a partition list are left out: a new load does not change the model.
    """
    plan = df._jdf.queryExecution().analyzed().toString()
    plan = re.sub(r"(CommandResult \[[^\n]*?Execute \w+)[^\n]*", r"\1", plan)
    plan = re.sub(r"__v[0-9a-f]{12}", "", plan)  # whichever version a stored table has
    numbers: dict[str, str] = {}
    plan = re.sub(r"(?<=[#=])\d+", lambda m: numbers.setdefault(m[0], str(len(numbers))), plan)
    text = f"{model.version}|{','.join(model.reads)}|{df.schema.simpleString()}|{plan}"
    return hashlib.sha256(text.encode()).hexdigest()


_WHOLE_PLANS = threading.Lock()
_in_use: dict[int, list] = {}


@contextmanager
def _whole_plans(spark: SparkSession) -> Iterator[None]:
    """Plans with all their columns spelled out, so that none is left out of a digest.

    Refreshes of one session side by side share the setting; the last to end puts it back.
    """
    key, own = "spark.sql.debug.maxToStringFields", id(spark)
    with _WHOLE_PLANS:
        if own not in _in_use:
            _in_use[own] = [0, spark.conf.get(key, None)]
            spark.conf.set(key, "100000")
        _in_use[own][0] += 1
    try:
        yield
    finally:
        with _WHOLE_PLANS:
            _in_use[own][0] -= 1
            if not _in_use[own][0]:
                before = _in_use.pop(own)[1]
                spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def refresh(layers: Layers, models: Iterable[Model], restate: bool = True,
            dry_run: bool = False, new_loads: bool = False, audits: Iterable[Audit] = ()) -> list[Step]:
    """Build the models in their given order and say what was done.

    With ``restate`` everything is rebuilt from the raw layer on. Without it a stored
    table is kept unless its definition changed or a table it reads was rebuilt in
    this call, so new loads stay unseen. With ``new_loads`` (and no ``restate``) also those
    models are built that read, directly or through others, a raw table written since their
    rows were made. A dry run only reports; there a model whose sources do not exist yet
    counts as new. ``audits`` are measured in the write where they can be.
    """
    models = list(models)
    with _whole_plans(layers.spark):
        # Taken before anything is built: a load that arrives meanwhile is unseen next time.
        return _refresh(layers, models, restate, dry_run, new_loads, _marks(layers, models), list(audits))


def sources_of(models: Iterable[Model]) -> dict[str, tuple[str, ...]]:
    """By model, the tables below it that no model builds."""
    found: dict[str, tuple[str, ...]] = {}
    for model in models:
        below = [table for name in model.reads for table in found.get(name, (name,))]
        found[model.name] = tuple(dict.fromkeys(below))
    return found


def _marks(layers: Layers, models: list[Model]) -> dict[str, dict[str, str | None]]:
    """By model, what the newest writes of the tables below it are known by."""
    below = sources_of(models)
    tables = sorted({table for found in below.values() for table in found})
    marks = dict(zip(tables, in_parallel([
        lambda table=table: last_write(layers.spark, layers.qualified(table)) if layers.exists(table) else None
        for table in tables])))
    return {name: {table: marks[table] for table in found} for name, found in below.items()}


def _refresh(layers: Layers, models: list[Model], restate: bool, dry_run: bool, new_loads: bool,
             marks: Mapping[str, dict[str, str | None]], audits: list[Audit]) -> list[Step]:
    steps: list[Step] = []
    rebuilt: set[str] = set()
    for wave in _waves(models):
        planned = [(model, _reason(layers, model, rebuilt, restate, marks[model.name] if new_loads else None))
                   for model in wave]
        due = [(model, reason) for model, reason in planned if reason]
        rebuilt |= {model.name for model, _ in due}
        steps += [Step(model.name, "build" if reason else "keep", reason or "unchanged")
                  for model, reason in planned]
        if not dry_run:
            in_parallel([lambda model=model: _build(layers, model, marks[model.name], audits)
                         for model, _ in due])
    return steps


def _waves(models: Iterable[Model]) -> list[list[Model]]:
    """The models in their given order, cut wherever one reads another of the same wave."""
    waves: list[list[Model]] = [[]]
    for model in models:
        if {other.name for other in waves[-1]} & set(model.reads):
            waves.append([])
        waves[-1].append(model)
    return waves


def _reason(layers: Layers, model: Model, rebuilt: set[str], restate: bool,
            marks: Mapping[str, str | None] | None) -> str:
    """Why a model is built now; empty when its stored table is kept."""
    if not layers.exists(model.name):
        return "new"
    if restate:
        return "restated"
    if rebuilt & set(model.reads):
        return "source rebuilt"
    if marks is not None:
        seen = layers.seen(model.name)
        # A table without a mark may have changed at any time.
        unseen = [table for table, mark in marks.items() if mark is None or seen.get(table) != mark]
        if unseen:
            return f"new load of {', '.join(unseen)}"
    current = _definition(model, model.build(layers.table))
    return "" if layers.definition(model.name) == current else "definition changed"


def _build(layers: Layers, model: Model, marks: Mapping[str, str | None], audits: list[Audit]) -> None:
    df = model.build(layers.table)
    seen = {table: mark for table, mark in marks.items() if mark is not None}
    layers.replace(df, model.name, _definition(model, df), seen, audits)


def ingest(layers: Layers, sources: Mapping[str, DataFrame], load_id: str,
           load_time: datetime | str, max_rows: int | None = None,
           dry_run: bool = False, widen: bool = False) -> list[Step]:
    """Append every source table to the raw layer as one load, ``max_rows`` of each if given."""

    def load(name: str, df: DataFrame) -> Step:
        rows = None
        if not dry_run:
            rows = append_load(row_limit(df, max_rows), layers.qualified(f"raw.{name}"),
                               load_id, load_time, widen=widen)
        return Step(f"raw.{name}", "load", load_id, rows)

    return in_parallel([lambda name=name, df=df: load(name, df) for name, df in sources.items()])


def run(layers: Layers, sources: Mapping[str, DataFrame], models: Iterable[Model], load_id: str,
        load_time: datetime | str, skip_ingest: bool = False, skip_transform: bool = False,
        restate: bool = True, dry_run: bool = False, max_rows: int | None = None,
        new_loads: bool = False, widen: bool = False, audits: Iterable[Audit] = ()) -> list[Step]:
    """Ingest, then transform; the first failure ends the run. Nothing to do gives no step."""
    steps: list[Step] = []
    if not skip_ingest:
        steps += ingest(layers, sources, load_id, load_time, max_rows, dry_run, widen)
    if not skip_transform:
        steps += refresh(layers, models, restate, dry_run, new_loads, audits)
    return steps
