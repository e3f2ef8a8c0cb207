"""Column expressions with the exact value rules the layer models rely on."""

from __future__ import annotations

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def cast_to(col: Column, source: T.DataType, target: T.DataType, on_error: str = "fail") -> Column:
    """Cast with database rounding.

    A float becomes a whole number by rounding halves to even and a decimal by
    rounding halves away from zero; Spark's own cast would cut the fraction off.
    ``on_error`` is "fail" (a bad value ends the job) or "null".
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    if source == target:
        return col
    if isinstance(target, _WHOLE):
        if isinstance(source, (T.DoubleType, T.FloatType)):
            col = F.rint(col)
        elif isinstance(source, T.DecimalType):
            col = F.round(col, 0)
    return col.cast(target) if on_error == "fail" else col.try_cast(target)


def parse_date(text: Column, on_error: str = "fail") -> Column:
    """Text to timestamp to date, independent of the session time zone."""
    if on_error == "null":
        return text.try_cast("timestamp_ntz").cast("date")
    return text.cast("timestamp_ntz").cast("date")


def iso_text(moment: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def concat_key(*parts: Column, to: str = "int", on_error: str = "fail") -> Column:
    """Key parts joined as text, missing parts left out, then cast.

    Not injective (1001|12 and 10011|2 meet), so pair it with a uniqueness audit.
    """
    text = F.concat_ws("", *[part.cast("string") for part in parts])
    text = F.when(F.length(text) > 0, text)
    return text.cast(to) if on_error == "fail" else text.try_cast(to)


def email_for(name: Column, domain: str = "example.org") -> Column:
    return F.concat(F.replace(F.lower(name), F.lit(" "), F.lit(".")), F.lit(f"@{domain}"))
