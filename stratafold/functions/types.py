"""Type names: canonical names for comparison, and Spark types for casting."""

from __future__ import annotations

import re

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# Canonical type -> type names that compare equal to it, any engine.
GENERIC = {
    "INTEGER": ["INT", "BIGINT", "SMALLINT", "TINYINT", "MEDIUMINT", "SERIAL", "BIGSERIAL"],
    "VARCHAR": ["TEXT", "CHAR", "NVARCHAR", "NCHAR", "VARCHAR2", "CLOB", "NCLOB", "LONGTEXT",
                "MEDIUMTEXT", "TINYTEXT"],
    "DECIMAL": ["NUMERIC", "DOUBLE", "FLOAT", "REAL", "MONEY", "SMALLMONEY", "NUMBER"],
    "DATE": ["TIMESTAMP", "DATETIME", "DATETIME2", "TIME", "TIMESTAMPTZ"],
}

# What each engine's catalog reports beyond the generic names.
BY_ENGINE = {
    "postgres": {
        "VARCHAR": ["CHARACTER VARYING", "CHARACTER", "BPCHAR"],
        "INTEGER": ["INT2", "INT4", "INT8"],
        "DECIMAL": ["FLOAT4", "FLOAT8"],
        "DATE": [
            "TIMESTAMP WITHOUT TIME ZONE",
            "TIMESTAMP WITH TIME ZONE",
            "TIME WITHOUT TIME ZONE",
            "TIME WITH TIME ZONE",
            "TIMETZ",
        ],
        "BOOLEAN": ["BOOL"],
        "JSON": ["JSONB"],
    },
    "mssql": {
        "VARCHAR": ["NTEXT"],
        "DATE": ["SMALLDATETIME", "DATETIMEOFFSET"],
        "BOOLEAN": ["BIT"],
        "BINARY": ["VARBINARY", "IMAGE"],
        "UUID": ["UNIQUEIDENTIFIER"],
    },
    "mysql": {
        "DATE": ["YEAR"],
        "BINARY": ["BLOB", "TINYBLOB", "MEDIUMBLOB", "LONGBLOB", "VARBINARY"],
    },
    "duckdb": {
        "VARCHAR": ["STRING"],
        "INTEGER": ["HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"],
        "DATE": ["TIMESTAMP WITH TIME ZONE", "INTERVAL"],
        "BOOLEAN": ["BOOL"],
        "BINARY": ["BLOB"],
    },
    "spark": {
        "VARCHAR": ["STRING"],
        "DATE": ["TIMESTAMP_NTZ", "TIMESTAMP_LTZ"],
    },
}

_GENERIC_LOOKUP = {name: canonical for canonical, names in GENERIC.items() for name in names}
_ENGINE_LOOKUP = {
    engine: {name: canonical for canonical, names in groups.items() for name in names}
    for engine, groups in BY_ENGINE.items()
}


def alias_map(engine: str | None = None) -> dict[str, str]:
    """Exact type name -> canonical name for one engine, generic names included."""
    if engine is None:
        return dict(_GENERIC_LOOKUP)
    return {**_GENERIC_LOOKUP, **_ENGINE_LOOKUP[engine]}


# A declared type: its name (any DOUBLE is one name), then arguments or other qualifiers.
_TYPE = re.compile(r"\s*(?P<name>DOUBLE|[^(]*?)(?:(?<=DOUBLE)[^(]*)?\s*"
                   r"(?P<args>\(\s*(?P<first>\d+)?\s*(?:,\s*(?P<second>\d+)\s*)?.*)?", re.I | re.S)


def _declared(raw: str) -> re.Match:
    return _TYPE.fullmatch(raw)


def canonical_type(raw: str | None, engine: str | None = None) -> str:
    """Canonical name of one type name; unknown names come back upper-cased.

    What an engine's catalog reports is looked up as it stands, before the generic names.
    """
    if raw is None:
        return "UNKNOWN"
    name = _declared(raw)["name"].upper()
    return alias_map(engine).get(raw.upper()) or _GENERIC_LOOKUP.get(name, name)


def canonical_type_column(raw: Column, engine: str | None = None) -> Column:
    """The same rule as a column expression, for catalog rows read over JDBC."""

    def lookup(names: dict[str, str], key: Column) -> Column:
        pairs = [F.lit(text) for pair in names.items() for text in pair]
        return F.try_element_at(F.create_map(*pairs), key)

    name = F.upper(raw)
    base = F.trim(F.substring_index(name, "(", 1))
    base = F.when(base.startswith("DOUBLE"), F.lit("DOUBLE")).otherwise(base)
    canonical = F.coalesce(lookup(_GENERIC_LOOKUP, base), base)
    if engine:
        canonical = F.coalesce(lookup(_ENGINE_LOOKUP[engine], name), canonical)
    return F.coalesce(canonical, F.lit("UNKNOWN"))


_SPARK_TYPES = {
    "INT": T.IntegerType(), "INTEGER": T.IntegerType(), "MEDIUMINT": T.IntegerType(),
    "SERIAL": T.IntegerType(), "BIGINT": T.LongType(), "BIGSERIAL": T.LongType(),
    "SMALLINT": T.ShortType(), "TINYINT": T.ByteType(),
    "DOUBLE": T.DoubleType(), "DOUBLE PRECISION": T.DoubleType(), "FLOAT": T.DoubleType(),
    "REAL": T.FloatType(), "MONEY": T.DecimalType(19, 4), "SMALLMONEY": T.DecimalType(10, 4),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(),
    "DATETIME2": T.TimestampNTZType(), "TIMESTAMPTZ": T.TimestampType(),
    "TIMESTAMP WITH TIME ZONE": T.TimestampType(), "INTERVAL": T.DayTimeIntervalType(),
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "BIT": T.BooleanType(),
}
_TEXT_NAMES = {"VARCHAR", "CHARACTER VARYING", "STRING", "TIME", "UUID", "UNIQUEIDENTIFIER",
               "JSON", "JSONB", "ENUM", *GENERIC["VARCHAR"]}
_BINARY_NAMES = {"BLOB", "BYTEA", "BINARY", "VARBINARY", "IMAGE", "TINYBLOB", "MEDIUMBLOB",
                 "LONGBLOB", "GEOMETRY"}
_DECIMAL_NAMES = {"DECIMAL", "NUMERIC", "NUMBER"}
#: Names that only one engine has, by what they hold there.
_ENGINE_TYPES = {
    "INT2": T.ShortType(), "INT4": T.IntegerType(), "INT8": T.LongType(), "HUGEINT": T.DecimalType(38, 0),
    "UTINYINT": T.ShortType(), "USMALLINT": T.IntegerType(), "UINTEGER": T.LongType(),
    "UBIGINT": T.DecimalType(20, 0), "FLOAT4": T.FloatType(), "FLOAT8": T.DoubleType(),
    "YEAR": T.ShortType(), "DATETIMEOFFSET": T.TimestampType(), "TIMESTAMP_LTZ": T.TimestampType(),
    "TIME WITHOUT TIME ZONE": T.StringType(), "TIME WITH TIME ZONE": T.StringType(), "TIMETZ": T.StringType(),
}
_BY_CANONICAL = {"VARCHAR": T.StringType(), "DATE": T.TimestampNTZType(), "BOOLEAN": T.BooleanType(),
                 "JSON": T.StringType(), "UUID": T.StringType(), "BINARY": T.BinaryType()}
_ANY_ENGINE = {name: canonical for names in _ENGINE_LOOKUP.values() for name, canonical in names.items()}


def spark_type(raw: str) -> T.DataType:
    """The Spark type a declared column is cast to; text lengths live in the contract."""
    found = _declared(raw)
    name = " ".join(found["name"].upper().split())
    if name in _DECIMAL_NAMES:
        precision, scale = found["first"], found["second"]
        return T.DecimalType(int(precision or 38), int(scale or (0 if precision else 10)))
    if name in _TEXT_NAMES:
        return T.StringType()
    if name in _BINARY_NAMES:
        return T.BinaryType()
    kind = _SPARK_TYPES.get(name) or _ENGINE_TYPES.get(name) or _BY_CANONICAL.get(_ANY_ENGINE.get(name))
    if kind is None:
        raise ValueError(f"no Spark type for declared type {raw!r}")
    return kind


def declared_length(raw: str) -> int | None:
    """n of VARCHAR(n) and its relatives in any engine, else None."""
    found = _declared(raw)
    name = " ".join(found["name"].upper().split())
    text = "VARCHAR" in (name, _GENERIC_LOOKUP.get(name), _ANY_ENGINE.get(name))
    return int(found["first"]) if text and found["first"] else None


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 20)))  # decimal digits that hold any value, as Parquet readers ask


def wider_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both exactly, and under which Parquet files of
    either can be read; None if there is none.

    Whole numbers widen among themselves, up to INT into DOUBLE, and into decimals with room for
    all their digits; FLOAT into DOUBLE; DATE into a timestamp without time zone; decimals keep the
    larger number of digits on both sides of the point, 38 in all at most.
    """
    if one == other:
        return one
    kinds = {type(one), type(other)}
    if kinds <= set(_WHOLE):
        return max((one, other), key=lambda t: _WHOLE.index(type(t)))
    if T.DecimalType in kinds:
        parts = []
        for t in (one, other):
            if isinstance(t, T.DecimalType):
                parts.append((t.precision - t.scale, t.scale))
            elif type(t) in _DIGITS:
                parts.append((max(_DIGITS[type(t)], 10), 0))
            else:
                return None
        scale = max(p[1] for p in parts)
        precision = max(p[0] for p in parts) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    if T.DoubleType in kinds and kinds <= {T.DoubleType, T.FloatType, *_WHOLE[:3]}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None
