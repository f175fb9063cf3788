"""Column expressions shared by the operators. All of them stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
OPEN_END_DATE = "9999-09-09"
OFFSET_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_as_column(value), F.lit(""))


def null_spellings(value: Column | str, spellings: Sequence[str] = ("", "null", "none")) -> Column:
    """Null where the text is one of the spellings, whatever its case."""
    text = _as_column(value)
    return F.when(~F.lower(text).isin(*[s.lower() for s in spellings]), text)


def parse_offset_timestamp(value: Column | str, source_zone: str | None = None, pattern: str = OFFSET_TIMESTAMP) -> Column:
    """ISO text with an offset to an instant; blank or malformed text gives null.

    ``source_zone`` applies a second shift from that zone to UTC, for results that must agree
    with pipelines which shift text that already carries its offset.
    """
    parsed = F.try_to_timestamp(blank_to_null(value), F.lit(pattern))
    return F.to_utc_timestamp(parsed, source_zone) if source_zone else parsed


def age_in_years(born: Column | str, as_of: Column) -> Column:
    """Nearest whole number of years between two dates."""
    return F.round(F.months_between(as_of, _as_column(born)) / 12, 0).cast("bigint")


def hash_key(*parts: Column | str) -> Column:
    """SHA-256 over the parts joined without a separator; null when any part is null."""
    return F.sha2(F.concat(*[_as_column(p).cast("string") for p in parts]), 256)


def open_end_date() -> Column:
    return F.to_date(F.lit(OPEN_END_DATE))


def decimal(value: Column | str, precision: int, scale: int) -> Column:
    return _as_column(value).cast(T.DecimalType(precision, scale))


def dirty_cast(value: Column | str, to: T.DataType | str) -> Column:
    """Cast that turns blank or unreadable text into null instead of failing."""
    ddl = to if isinstance(to, str) else to.simpleString()
    return blank_to_null(_as_column(value).cast("string")).try_cast(ddl)


def strip_line_breaks(value: Column | str) -> Column:
    return F.regexp_replace(_as_column(value), "\n", "")


def join_broken_fields(value: Column | str) -> Column:
    """Drop a line break that touches a comma, on either side of it."""
    return F.regexp_replace(F.regexp_replace(_as_column(value), "\n,", ","), ",\n", ",")


def array_difference(left: Column | str, right: Column | str) -> Column:
    """Element by element difference, as long as the shorter array."""
    a, b = _as_column(left), _as_column(right)
    n = F.least(F.size(a), F.size(b))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x - y)


def delimited_record(raw: Column | str, schema: T.StructType, sep: str = ",", charset: str | None = None) -> Column:
    """One struct from one delimited record: decoded, split, trimmed of its newline and typed.

    Missing and empty fields give null; so does text that does not fit the type.
    """
    text = _as_column(raw)
    if charset:
        text = F.decode(text, charset)
    fields = F.split(F.regexp_replace(text, "[\r\n]+$", ""), f"\\Q{sep}\\E", -1)
    return F.struct(
        *[
            dirty_cast(F.get(fields, F.lit(i)), field.dataType).alias(field.name)
            for i, field in enumerate(schema.fields)
        ]
    )


def xml_record(raw: Column | str, tags: Sequence[str]) -> Column:
    """Child tag to text, as a struct of strings; an empty element gives null."""
    schema = T.StructType([T.StructField(tag, T.StringType()) for tag in tags])
    record = F.from_xml(_as_column(raw), schema)
    return F.struct(*[blank_to_null(record[tag]).alias(tag) for tag in tags])
