"""Source text as typed values, in Spark expressions.

Strict casts raise on text that doesn't fit (the session keeps ANSI mode on), lenient ones give null.
Lenient are: dates and times, intervals, variants and list elements; for MySQL also
booleans.  Text stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import INTERVAL

EPOCH_2000_MS = 946_684_800_000
INVALID_TEMPORAL = -(2**63)
TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType, T.TimeType)


def is_interval(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and kind.fieldNames() == INTERVAL.fieldNames()


def cast_text(text: Column, kind: T.DataType, dialect: str = "pg") -> Column:
    """``text`` as ``kind``; ``dialect`` is ``pg`` or ``mysql``."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BinaryType):
        return bytea(text) if dialect == "pg" else F.unhex(text)
    if is_interval(kind):
        return pg_interval(text)
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(text)
    if isinstance(kind, T.ArrayType):
        return pg_array(text, kind)
    if isinstance(kind, TEMPORAL) or (dialect == "mysql" and isinstance(kind, T.BooleanType)):
        return text.try_cast(kind)
    return text.cast(kind)


def bytea(text: Column) -> Column:
    """``\\x48`` or plain hexadecimal digits as bytes."""
    return F.unhex(F.when(text.startswith("\\x"), F.substring(text, F.lit(3), F.length(text))).otherwise(text))


def _nested(kind: T.DataType, leaf: T.DataType) -> T.DataType:
    return T.ArrayType(_nested(kind.elementType, leaf)) if isinstance(kind, T.ArrayType) else leaf


def _elements(values: Column, kind: T.ArrayType, strict: bool) -> Column:
    inner = kind.elementType
    if isinstance(inner, T.ArrayType):
        return F.transform(values, lambda v: _elements(v, inner, strict))
    if isinstance(inner, T.StringType):
        return values
    return F.transform(values, (lambda v: v.cast(inner)) if strict else (lambda v: v.try_cast(inner)))


def pg_array(text: Column, kind: T.ArrayType, strict: bool = False) -> Column:
    """An array literal such as ``{1,NULL,"a,b"}`` as a list.

    Braces and commas count outside quotes only.  An element that doesn't fit becomes null, not the
    whole list; with ``strict`` it raises.  Text that isn't an array literal gives null.
    """
    tokens = F.regexp_extract_all(text, F.lit(r'"(?:[^"\\]|\\.)*"|[{},]|[^{},"]+'), F.lit(0))
    plain = lambda t: F.to_json(F.array(F.trim(t)))  # noqa: E731  a JSON list of one string, quoted and escaped
    one = lambda t: (
        F.when(t == "{", "[")
        .when(t == "}", "]")
        .when(t == ",", ",")
        .when(t.startswith('"'), F.regexp_replace(t, r'(\\["\\])|\\(.)', "$1$2"))
        .when(F.lower(F.trim(t)) == "null", "null")
        .otherwise(F.substring(plain(t), F.lit(2), F.length(plain(t)) - 2))
    )
    as_json = F.array_join(F.transform(tokens, one), "")
    parsed = F.from_json(as_json, _nested(kind, T.StringType()), {"allowUnquotedControlChars": "true"})
    return F.when(text.startswith("{"), _elements(parsed, kind, strict))


def pg_interval(text: Column) -> Column:
    """``1 year 2 mons 3 days 04:05:06.7`` as struct(months, days, micros); null if no part is found."""

    def part(name: str) -> Column:
        found = F.regexp_extract(text, rf"([-+]?\d+)\s+{name}s?\b", 1)
        return F.coalesce(F.when(found != "", found).try_cast("int"), F.lit(0))

    clock = r"([-+]?)(\d+):(\d+):(\d+(?:\.\d+)?)"
    field = lambda i: F.regexp_extract(text, clock, i)
    seconds = F.coalesce(F.when(field(4) != "", field(4)).try_cast("decimal(20,6)"), F.lit(0).cast("decimal(20,6)"))
    whole = lambda i: F.coalesce(F.when(field(i) != "", field(i)).try_cast("long"), F.lit(0).cast("long"))
    micros = (whole(2) * 3600 + whole(3) * 60) * 1_000_000 + (seconds * 1_000_000).cast("long")
    signed = F.when(field(1) == "-", -micros).otherwise(micros)
    months = part("year") * 12 + part("mon")
    found = F.struct(months.cast("int").alias("months"), part("day").cast("int").alias("days"), signed.cast("long").alias("micros"))
    return F.when(text.rlike(rf"\d+\s+(?:year|mon|day)s?\b|{clock}"), found)


def pg_epoch_ms(micros: Column) -> Column:
    """PostgreSQL's microseconds since 2000 as Unix milliseconds, rounded down."""
    return F.lit(EPOCH_2000_MS) + F.floor(micros / F.lit(1000)).cast("long")


def enum_label(labels: Column, index: Column) -> Column:
    """1-based label; an index outside the list stays a number."""
    return F.coalesce(F.when(index > 0, F.try_element_at(labels, index.cast("int"))), index.cast("string"))


def set_labels(labels: Column, mask: Column) -> Column:
    """Labels of the bits that are set, joined by commas; without labels the mask as an unsigned number."""
    hit = F.transform(labels, lambda name, i: F.when(F.getbit(mask, i) == 1, name))
    joined = F.array_join(F.filter(hit, lambda x: x.isNotNull()), ",")
    return F.when(F.coalesce(F.size(labels), F.lit(0)) > 0, joined).otherwise(unsigned(mask, 64).cast("string"))


def unsigned(value: Column, bits: int) -> Column:
    """A signed number of ``bits`` bits read as unsigned."""
    if bits == 64:
        wide = value.cast("decimal(20,0)")
        return F.when(value < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")
    return value.cast("long").bitwiseAND(F.lit((1 << bits) - 1))


def bit_text(bits: Column, width: int) -> Column:
    """BIT(1) as a boolean's text, wider ones as hexadecimal digits of their bytes."""
    if width == 1:
        return (F.getbit(bits, F.lit(0)) == 1).cast("string")
    return F.right(F.lpad(F.hex(bits), 16, "0"), F.lit((width + 7) // 8 * 2))


def bytes_text(value: Column, kind: T.DataType) -> Column:
    """Bytes as hexadecimal digits for a binary column, as UTF-8 otherwise."""
    return F.hex(value) if isinstance(kind, T.BinaryType) else F.decode(value, "UTF-8")


def temporal_text(micros: Column, kind: str) -> Column:
    """MySQL's microseconds as text: ``timestamp``, ``datetime``, ``date`` or ``time`` (signed, hours may pass 24)."""
    value = F.when(micros != INVALID_TEMPORAL, micros)
    if kind == "date":
        return F.date_from_unix_date(F.floor(value / F.lit(86_400_000_000)).cast("int")).cast("string")
    if kind == "time":
        size = F.abs(value)
        seconds = F.floor(size / F.lit(1_000_000)).cast("long")
        clock = F.format_string("%s%02d:%02d:%02d.%06d", F.when(value < 0, "-").otherwise(""), F.floor(seconds / 3600).cast("long"), F.floor(seconds / 60).cast("long") % 60, seconds % 60, size % 1_000_000)
        return F.when(value.isNotNull(), clock)
    shown = F.timestamp_micros(value)
    return F.date_format(shown, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'" if kind == "timestamp" else "yyyy-MM-dd HH:mm:ss.SSSSSS")


def lag_ms(delivered_ms: Column, source_ms: Column) -> Column:
    """Delay of a change, never negative; 0 without a source time."""
    return F.when(source_ms.isNull() | (source_ms <= 0), F.lit(0).cast("long")).otherwise(F.greatest(F.lit(0).cast("long"), delivered_ms - source_ms))


def iso_time(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(F.when(ms > 0, ms)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
