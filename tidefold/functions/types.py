"""Source column types as Spark types.

Text of a type goes in, a ``DataType`` comes out; what Spark can't hold without loss stays text.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

INTERVAL = T.StructType([T.StructField("months", T.IntegerType()), T.StructField("days", T.IntegerType()), T.StructField("micros", T.LongType())])
MAX_PRECISION = 38
UNSIGNED_LONG = T.DecimalType(20, 0)

# PostgreSQL type names (as format_type writes them, without modifiers).
PG_SCALARS: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "integer": T.IntegerType(),
    "smallint": T.ShortType(),
    "real": T.FloatType(),
    "double precision": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamp with time zone": T.TimestampType(),
    "date": T.DateType(),
    "time without time zone": T.TimeType(6),
    "bytea": T.BinaryType(),
    "uuid": T.StringType(),
    "interval": INTERVAL,
}
PG_ALIASES = {"timestamp": "timestamp without time zone", "timestamptz": "timestamp with time zone", "time": "time without time zone", "int8": "bigint", "int": "integer", "int4": "integer", "int2": "smallint", "float4": "real", "float8": "double precision", "bool": "boolean"}
# Element types whose arrays become lists; arrays of anything else stay text.
PG_LISTABLE = {"bigint", "integer", "smallint", "real", "double precision", "boolean", "timestamp without time zone", "timestamp with time zone", "date", "uuid", "numeric", "text", "character varying", "varchar", "character", "char", "bpchar", "name"}


def first_number(text: str) -> int | None:
    """The first number in parentheses: ``tinyint(1)`` gives 1."""
    found = re.search(r"\(\s*(\d+)", text)
    return int(found[1]) if found else None


def _decimal(arguments: str | None, default: T.DataType) -> T.DataType:
    if not arguments:
        return default
    numbers = [int(x) for x in re.findall(r"-?\d+", arguments)]
    precision, scale = numbers[0], numbers[1] if len(numbers) > 1 else 0
    if 1 <= precision <= MAX_PRECISION and 0 <= scale <= precision:
        return T.DecimalType(precision, scale)
    return T.StringType()


def pg_type(declared: str, dims: int = 0, json_as_variant: bool = True) -> T.DataType:
    """Spark type of a PostgreSQL type; ``dims`` counts array dimensions that the text doesn't show."""
    text = declared.strip().lower().removeprefix("pg_catalog.")
    while text.endswith("[]"):
        text, dims = text[:-2].strip(), dims + 1
    found = re.fullmatch(r"([a-z0-9_ ]*?)\s*(?:\(([^)]*)\))?\s*((?:with|without) time zone)?", text)
    if not found:
        return T.StringType()
    name = " ".join(x for x in (found[1].strip(), found[3]) if x)
    name = PG_ALIASES.get(name, name)
    if name in ("numeric", "decimal"):
        name, one = "numeric", _decimal(found[2], T.DecimalType(38, 18))
    elif name in ("json", "jsonb"):
        one = T.VariantType() if json_as_variant else T.StringType()
    else:
        one = PG_SCALARS.get(name, T.StringType())
    if not dims:
        return one
    if name not in PG_LISTABLE or (name == "numeric" and isinstance(one, T.StringType)):
        return T.StringType()
    for _ in range(dims):
        one = T.ArrayType(one)
    return one


def mysql_type(declared: str, length: int | None = None, scale: int | None = None, json_as_variant: bool = True) -> T.DataType:
    """Spark type of a MySQL column type such as ``bigint unsigned`` or ``decimal(12,2)``."""
    text = declared.strip().lower()
    base = re.match(r"[a-z]+", text)
    name, unsigned = base[0] if base else "", "unsigned" in text
    size = first_number(text) if first_number(text) is not None else length
    if name in ("bool", "boolean"):
        return T.BooleanType()
    if name == "tinyint":
        return T.BooleanType() if size == 1 else T.ShortType()
    if name == "smallint":
        return T.IntegerType() if unsigned else T.ShortType()
    if name in ("int", "integer"):
        return T.LongType() if unsigned else T.IntegerType()
    if name == "bigint":
        return UNSIGNED_LONG if unsigned else T.LongType()
    if name in ("decimal", "numeric", "dec", "fixed"):
        arguments = re.search(r"\(([^)]*)\)", text)
        written = arguments[1] if arguments else f"{length},{scale or 0}" if length else None
        return _decimal(written, T.DecimalType(10, 0))
    if name == "bit":
        return T.BooleanType() if (size or 1) == 1 else T.BinaryType()
    if name == "json":
        return T.VariantType() if json_as_variant else T.StringType()
    if name in ("binary", "varbinary") or name.endswith("blob") or name in MYSQL_SPATIAL:
        return T.BinaryType()
    return MYSQL_SCALARS.get(name, T.StringType())


# MySQL type names without modifiers.
MYSQL_SCALARS: dict[str, T.DataType] = {
    "mediumint": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "real": T.DoubleType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "time": T.TimeType(6),
    "year": T.IntegerType(),
}
# Types of shapes, which come as bytes.
MYSQL_SPATIAL = {"geometry", "point", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon", "geometrycollection", "geomcollection"}

# MySQL binary log column codes.
MYSQL_CODES = {
    0: "decimal", 1: "tiny", 2: "short", 3: "long", 4: "float", 5: "double", 7: "timestamp", 8: "longlong", 9: "int24",
    10: "date", 11: "time", 12: "datetime", 13: "year", 15: "varchar", 16: "bit", 17: "timestamp2", 18: "datetime2",
    19: "time2", 242: "vector", 245: "json", 246: "newdecimal", 247: "enum", 248: "set", 249: "tiny_blob", 250: "medium_blob",
    251: "long_blob", 252: "blob", 253: "var_string", 254: "string", 255: "geometry",
}


def effective_code(code: int, metadata: int) -> int:
    """ENUM and SET travel as STRING; the upper metadata byte then has their own code."""
    if code == 254 and metadata >= 256:
        real = metadata >> 8
        if real in (247, 248):
            return real
    return code


def mysql_physical_type(code: int, metadata: int = 0, unsigned: bool = False, json_as_variant: bool = True) -> T.DataType:
    """Spark type from the log alone, where the column's declaration can't be read."""
    name = MYSQL_CODES.get(effective_code(code, metadata), "")
    if name == "newdecimal":
        return _decimal(f"{metadata >> 8},{metadata & 255}", T.DecimalType(10, 0))
    if name == "bit":
        bits = (metadata >> 8) * 8 + (metadata & 255)
        return T.BooleanType() if bits == 1 else T.BinaryType()
    as_declared = {
        "tiny": "tinyint", "short": "smallint", "int24": "mediumint", "long": "int", "longlong": "bigint", "timestamp2": "timestamp",
        "datetime2": "datetime", "time2": "time", "vector": "blob", "tiny_blob": "blob", "medium_blob": "blob", "long_blob": "blob",
    }.get(name, name)
    return mysql_type(as_declared + (" unsigned" if unsigned else ""), json_as_variant=json_as_variant)


WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType),
    T.ShortType: (T.IntegerType, T.LongType),
    T.IntegerType: (T.LongType,),
    T.FloatType: (T.DoubleType,),
}


def reads_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether Parquet files of one type can be read as another without a rewrite."""
    if stored == wanted:
        return True
    if isinstance(stored, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return wanted.scale >= stored.scale and wanted.precision - wanted.scale >= stored.precision - stored.scale
    return type(wanted) in WIDER.get(type(stored), ())
