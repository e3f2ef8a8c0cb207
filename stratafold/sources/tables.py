"""Reading source tables: by name list, over JDBC, and from a folder of CSV files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, types as T
from pyspark.sql import functions as F


def scan(names: Iterable[str], read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """Whole source tables by name; nothing is read until a table is used."""
    return {name: read(name) for name in names}


def parquet_reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """A reader of one folder; each table's schema is looked up once."""
    return cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))


def jdbc_reader(spark: SparkSession, url: str, options: Mapping[str, str] | None = None,
                split: Mapping[str, tuple[str, int, int, int]] | None = None,
                ) -> Callable[[str], DataFrame]:
    """A reader over JDBC.

    ``split`` names, per table, the numeric or date column, its lowest and highest
    value and the number of parallel reads; a table without it is read by one task.
    """

    def read(name: str) -> DataFrame:
        given = jdbc_options(url, name, options, (split or {}).get(name))
        return lower_names(spark.read.format("jdbc").options(**given).load())

    return read


def jdbc_options(url: str, table: str, options: Mapping[str, str] | None = None,
                 split: tuple[str, int, int, int] | None = None) -> dict[str, str]:
    merged = {"url": url, "dbtable": table, "fetchsize": "10000", **(options or {})}
    if split:
        column, low, high, tasks = split
        merged |= {"partitionColumn": column, "lowerBound": str(low),
                   "upperBound": str(high), "numPartitions": str(tasks)}
    return merged


def lower_names(df: DataFrame) -> DataFrame:
    """Column names as the raw contracts have them."""
    return df.toDF(*[name.lower() for name in df.columns])


def row_limit(df: DataFrame, rows: int | None, order_by: Iterable[str | Column] = ()) -> DataFrame:
    """At most ``rows`` rows (None: all); give an order when the choice must be stable."""
    if rows is None:
        return df
    order = list(order_by)
    return (df.orderBy(*order) if order else df).limit(rows)


# Timestamps in CSV extracts stay text, as declared for the raw layer; a quote inside a
# quoted value is doubled; spaces belong to the value.
CSV_QUOTING = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
_CSV_OPTIONS = {**CSV_QUOTING, "timestampFormat": "'none'", "timestampNTZFormat": "'none'",
                "preferDate": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             multiline: bool = False) -> DataFrame:
    """CSV with a header and lower-cased column names.

    Without a schema the types are inferred, which reads the file twice. ``multiline`` allows
    line breaks in quoted values; each file is then read by one task. ``read_csv_ranges`` reads
    a large one in parallel.
    """
    reader = spark.read.options(**_CSV_OPTIONS, multiLine=multiline)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return lower_names(reader.csv(path))


CSV_RANGE_BYTES = 32 << 20
_MORE_BYTES = 1 << 20
_MOST_TASKS = 1 << 16
_BATCH_BYTES = 4 << 20
_COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType,
                    range_bytes: int = CSV_RANGE_BYTES) -> DataFrame:
    """CSV with a header whose quoted values may hold line breaks, each file read by many tasks.

    Files are parted into byte ranges. A first pass counts the quotes of each range; the sum over
    the ranges before says whether a range starts within a quoted value. A line break outside
    of quotes ends a record, and a record belongs to the range that holds the break before it, whose
    task reads on past the range to its end. Spark's CSV reader parses the records one by one.

    Quotes must stand around values or be doubled within them (RFC 4180, and what ``write_csv``
    writes); a single quote inside an unquoted value would shift what follows, so such files
    need ``read_csv``. Compressed files can't be parted and are refused. Columns go by place;
    empty lines are left out. The files are listed when this is called, and read when the frame is.
    """
    if range_bytes < 1:
        raise ValueError(f"range_bytes is {range_bytes}")
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)),
                        F.lit(range_bytes).cast("bigint"))
    ranges = listed.where("length > 0").select("path", "length", F.explode(starts).alias("start"))
    # Given as a number, so that adaptive execution does not put these few rows into one task.
    tasks = min(_MOST_TASKS, max(1, ranges.count()))
    ranges = ranges.repartition(tasks, "path", "start")
    within = F.sum("quotes").over(
        Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    counted = ranges.mapInArrow(_quotes_of(range_bytes), "path string, length bigint, start bigint, quotes bigint")
    placed = counted.select("path", "length", "start", F.coalesce(within % 2, F.lit(0)).alias("quoted"))
    lines = placed.repartition(tasks, "path", "start").mapInArrow(_records_of(range_bytes), "line string")
    options = {**_CSV_OPTIONS, "multiLine": "true"}
    parsed = lines.select(F.from_csv("line", _ddl(schema), options).alias("row"))
    return lower_names(parsed.select("row.*"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _opened(path: str) -> pa.NativeFile:
    if path.endswith(_COMPRESSED):
        raise ValueError(f"{path} is compressed and can't be parted into ranges")
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


def _quotes_of(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = []
            for path, start in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                with _opened(path) as file:
                    file.seek(start)
                    quotes.append(file.read(range_bytes).count(b'"'))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())],
                                             names=["path", "length", "start", "quotes"])

    return run


def _breaks(data: bytes, quoted: int) -> np.ndarray:
    """Where line breaks outside of quotes stand, if the bytes start within quotes or not."""
    chars = np.frombuffer(data, np.uint8)
    breaks, quotes = np.flatnonzero(chars == 10), np.flatnonzero(chars == 34)
    return breaks[(np.searchsorted(quotes, breaks) + quoted) % 2 == 0]


def _rest(file: pa.NativeFile, data: bytes, quoted: int) -> bytes:
    """What follows a range's bytes up to the line break that ends its last record, or the file."""
    quoted, parts = (quoted + data.count(b'"')) % 2, []
    while more := file.read(_MORE_BYTES):
        ends = _breaks(more, quoted)
        if len(ends):
            return b"".join([*parts, more[:ends[0]]])
        parts.append(more)
        quoted = (quoted + more.count(b'"')) % 2
    return b"".join(parts)


def _records_of(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, _, start, quoted in zip(*(c.to_pylist() for c in batch.columns)):
                with _opened(path) as file:
                    file.seek(start)
                    data = file.read(range_bytes)
                    ends = _breaks(data, quoted)
                    if not len(ends):
                        continue  # no record but the header starts here
                    last, held, size = int(ends[0]) + 1, [], 0
                    for end in ends[1:].tolist():
                        held.append(data[last:end])
                        last, size = end + 1, size + end - last
                        if size >= _BATCH_BYTES:
                            yield _lines(held)
                            held, size = [], 0
                    yield _lines([*held, data[last:] + _rest(file, data, quoted)])

    return run


def _lines(records: list[bytes]) -> pa.RecordBatch:
    texts = [r.removesuffix(b"\r").decode("utf-8", "replace") for r in records]
    return pa.RecordBatch.from_arrays([pa.array([t for t in texts if t], pa.string())], names=["line"])


def read_csv_folder(spark: SparkSession, folder: str,
                    schemas: Mapping[str, T.StructType] | None = None,
                    multiline: Iterable[str] = ()) -> dict[str, DataFrame]:
    """One table per ``*.csv`` entry (a file, or a folder a CSV sink wrote), by sorted name.

    Entries may lie in folders below; names are lower-cased, and two entries of one name are
    refused. ``multiline`` names the tables whose values may hold line breaks; those with a schema
    are read by byte ranges.
    """
    entry = F.regexp_extract("path", r"^(.*?/([^/]+)\.csv)(/[^/]*)?$", 1)
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv").load(folder)
        .select(entry.alias("entry")).distinct()
    )
    found: dict[str, str] = {}
    for row in sorted(listing.collect()):
        name = row.entry.rsplit("/", 1)[-1][:-len(".csv")].lower()
        if name in found:
            raise ValueError(f"{found[name]} and {row.entry} are both table {name!r}")
        found[name] = row.entry
    if not found:
        raise FileNotFoundError(f"no CSV files in {folder}")
    several, schemas = set(multiline), schemas or {}
    return {name: read_csv_ranges(spark, found[name], schemas[name]) if name in several and name in schemas
            else read_csv(spark, found[name], schemas.get(name), name in several)
            for name in sorted(found)}
