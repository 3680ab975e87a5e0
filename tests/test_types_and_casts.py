import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.functions import casts
from tidefold.functions.types import INTERVAL, mysql_physical_type, mysql_type, pg_type, reads_as


@pytest.mark.parametrize(
    ("declared", "dims", "wanted"),
    [
        ("numeric(12,2)", 1, "array<decimal(12,2)>"),
        ("numeric(10,3)", 2, "array<array<decimal(10,3)>>"),
        ("numeric", 1, "array<decimal(38,18)>"),
        ("timestamp(3)", 1, "array<timestamp_ntz>"),
        ("character varying(32)", 1, "array<string>"),
        ("timestamp with time zone", 2, "array<array<timestamp>>"),
        ("numeric(40,2)", 1, "string"),
        ("public.composite_amount", 1, "string"),
        ("text[]", 0, "array<string>"),
        ("jsonb[]", 0, "string"),
        ("jsonb", 0, "variant"),
        ("bigint", 0, "bigint"),
        ("numeric(50,2)", 0, "string"),
        ("bytea", 0, "binary"),
        ("time(3) without time zone", 0, "time(6)"),
        ("time with time zone", 0, "string"),
        ("uuid", 0, "string"),
    ],
)
def test_pg_types(declared, dims, wanted):
    assert pg_type(declared, dims).simpleString() == wanted


def test_pg_interval_and_json_switch():
    assert pg_type("interval") == INTERVAL
    assert pg_type("json", json_as_variant=False) == T.StringType()


@pytest.mark.parametrize(
    ("declared", "wanted"),
    [
        ("tinyint(1)", "boolean"), ("tinyint", "smallint"), ("smallint unsigned", "int"), ("mediumint", "int"), ("int unsigned", "bigint"),
        ("bigint", "bigint"), ("bigint(20) unsigned", "decimal(20,0)"), ("decimal(12,2)", "decimal(12,2)"), ("decimal", "decimal(10,0)"),
        ("decimal(60,2)", "string"), ("double", "double"), ("bit(1)", "boolean"), ("bit(9)", "binary"), ("datetime(6)", "timestamp_ntz"),
        ("timestamp", "timestamp"), ("date", "date"), ("year", "int"), ("json", "variant"), ("varbinary(5)", "binary"), ("longblob", "binary"),
        ("point", "binary"), ("varchar(3)", "string"), ("enum('a','b')", "string"),
    ],
)
def test_mysql_types(declared, wanted):
    assert mysql_type(declared).simpleString() == wanted


def test_mysql_physical_types():
    assert mysql_physical_type(246, 12 << 8 | 2) == T.DecimalType(12, 2)
    assert mysql_physical_type(1) == T.ShortType()
    assert mysql_physical_type(8, unsigned=True) == T.DecimalType(20, 0)
    assert mysql_physical_type(16, 1) == T.BooleanType()
    assert mysql_physical_type(254, 247 << 8) == T.StringType()
    assert mysql_physical_type(252) == T.BinaryType()


def test_reads_as():
    assert reads_as(T.IntegerType(), T.LongType())
    assert reads_as(T.DecimalType(10, 2), T.DecimalType(12, 2))
    assert not reads_as(T.LongType(), T.IntegerType())
    assert not reads_as(T.IntegerType(), T.StringType())


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "declared", "wanted"),
    [
        ('{"a,b",c}', "text[]", ["a,b", "c"]),
        ("{}", "text[]", []),
        (None, "text[]", None),
        ('{NULL,"NULL"}', "text[]", [None, "NULL"]),
        (r'{"x\"y","b\\s"}', "text[]", ['x"y', "b\\s"]),
        ('{"{1}",2}', "text[]", ["{1}", "2"]),
        ("{1.23,bad}", "numeric(12,2)[]", [Decimal("1.23"), None]),
        ("{{1.234,2.345},{3.456,4.567}}", "numeric(10,3)[][]", [[Decimal("1.234"), Decimal("2.345")], [Decimal("3.456"), Decimal("4.567")]]),
        ("nothing", "bigint[]", None),
    ],
)
def test_pg_arrays(spark, text, declared, wanted):
    assert one(spark, casts.cast_text(F.lit(text).cast("string"), pg_type(declared))) == wanted


def test_pg_array_strict_element_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, casts.pg_array(F.lit("{1,x}"), T.ArrayType(T.LongType()), strict=True))


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("1 year 2 mons 3 days 04:05:06.7", (14, 3, 14706700000)),
        ("-1 days +00:00:01", (0, -1, 1000000)),
        ("-00:00:01.5", (0, 0, -1500000)),
        ("1 mon", (1, 0, 0)),
        ("junk", None),
    ],
)
def test_interval(spark, text, wanted):
    got = one(spark, casts.pg_interval(F.lit(text)))
    assert (tuple(got) if got else None) == wanted


def test_strict_and_lenient(spark):
    assert one(spark, casts.cast_text(F.lit("t"), T.BooleanType())) is True
    assert one(spark, casts.cast_text(F.lit("2024-02-30"), T.DateType())) is None
    assert one(spark, casts.cast_text(F.lit("nope"), T.BooleanType(), "mysql")) is None
    assert one(spark, casts.cast_text(F.lit("838:59:59"), T.TimeType(6), "mysql")) is None
    assert one(spark, casts.cast_text(F.lit("12:34:56.123456"), T.TimeType(6))) == dt.time(12, 34, 56, 123456)
    assert one(spark, casts.cast_text(F.lit(r"\x48656c6c6f"), T.BinaryType())) == b"Hello"
    assert one(spark, casts.cast_text(F.lit("4869"), T.BinaryType(), "mysql")) == b"Hi"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, casts.cast_text(F.lit("x"), T.LongType()))


def test_values(spark):
    long = lambda v: F.lit(v).cast("long")
    assert one(spark, casts.unsigned(long(-1), 64)) == Decimal(2**64 - 1)
    assert one(spark, casts.unsigned(long(-1), 24)) == 2**24 - 1
    labels = F.array(F.lit("gold"), F.lit("silver"))
    assert one(spark, casts.enum_label(labels, F.lit(2))) == "silver"
    assert one(spark, casts.enum_label(labels, F.lit(9))) == "9"
    assert one(spark, casts.enum_label(labels, F.lit(0))) == "0"
    assert one(spark, casts.set_labels(labels, long(3))) == "gold,silver"
    assert one(spark, casts.set_labels(F.array().cast("array<string>"), long(-1))) == str(2**64 - 1)
    assert one(spark, casts.pg_epoch_ms(long(-1))) == 946684799999
    assert one(spark, casts.temporal_text(long(casts.INVALID_TEMPORAL), "date")) is None
    assert one(spark, casts.temporal_text(long(-3_600_000_001), "time")) == "-01:00:00.000001"
    assert one(spark, casts.temporal_text(long(0), "timestamp")) == "1970-01-01T00:00:00.000000Z"
    assert one(spark, casts.bit_text(long(5), 12)) == "0005"
    assert one(spark, casts.bit_text(long(5), 1)) == "true"
    assert one(spark, casts.lag_ms(long(5), long(9))) == 0
    assert one(spark, casts.lag_ms(long(9), F.lit(None).cast("long"))) == 0
    assert one(spark, casts.iso_time(long(1))) == "1970-01-01T00:00:00.001Z"
