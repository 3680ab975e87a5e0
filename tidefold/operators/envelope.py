"""Change events as rows of one DataFrame, and table shapes.

Every source delivers the same envelope.  A tuple is a list of texts in column order;
``unchanged`` marks columns that an update didn't send (large values left alone), which is not
the same as null.  (lsn, seq) gives the total order of a source.  A row with op ``KEEP`` has no table: it
says that the source is at its lsn (``after``: the position as JSON, if it is more than that number).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import cast_text

ENVELOPE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("xid", T.LongType()),
        T.StructField("commit_ts", T.TimestampType()),
        T.StructField("table", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("before", T.ArrayType(T.StringType())),
        T.StructField("after", T.ArrayType(T.StringType())),
        T.StructField("unchanged", T.ArrayType(T.BooleanType())),
        T.StructField("schema_id", T.IntegerType()),
    ]
)
INSERT, UPDATE, DELETE, TRUNCATE, DDL, KEEP = "I", "U", "D", "T", "DDL", "KEEP"


@dataclass(frozen=True)
class Shape:
    """A source table: its name, columns in order and key columns."""

    table: str
    columns: tuple[tuple[str, T.DataType], ...]
    keys: tuple[str, ...] = ()
    dialect: str = "pg"
    comments: dict = field(default_factory=dict, compare=False)

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.columns]


def typed(values: Column, shape: Shape) -> Column:
    """A text tuple as a struct of typed columns."""
    return F.struct(*[cast_text(F.get(values, F.lit(i)), kind, shape.dialect).alias(name) for i, (name, kind) in enumerate(shape.columns)])


def decode(events: DataFrame, shape: Shape) -> DataFrame:
    """op, at (struct lsn, seq), xid, commit_ts, old and new (structs or null), held (array<boolean>) of one table."""
    own = events.where(F.col("table") == shape.table)
    tuple_of = lambda c: F.when(F.col(c).isNotNull(), typed(F.col(c), shape))
    held = F.transform(F.sequence(F.lit(0), F.lit(len(shape.columns) - 1)), lambda i: F.coalesce(F.get("unchanged", i), F.lit(False)))
    return own.select("op", F.struct("lsn", "seq").alias("at"), "xid", "commit_ts", tuple_of("before").alias("old"), tuple_of("after").alias("new"), held.alias("held"))


def changelog(rows: DataFrame, shape: Shape, op: Column, lsn: Column, source: str = "test", before: list[Column] | None = None, unchanged: Column | None = None, commit_ts: Column | None = None, xid: Column | None = None) -> DataFrame:
    """The envelope for rows of a table that has the shape's columns."""
    tuple_of = lambda cols: F.array(*[c.cast("string") for c in cols])
    after = F.when(op.isin(INSERT, UPDATE), tuple_of([F.col(n) for n in shape.names]))
    old = tuple_of(before) if before is not None else F.when(op == DELETE, tuple_of([F.col(n) for n in shape.names]))
    flags = unchanged if unchanged is not None else F.lit(None).cast("array<boolean>")
    return rows.select(
        F.lit(source).alias("source"), lsn.cast("long").alias("lsn"), F.lit(0).cast("long").alias("seq"),
        (xid if xid is not None else lsn).cast("long").alias("xid"),
        (commit_ts if commit_ts is not None else F.lit(None)).cast("timestamp").alias("commit_ts"),
        F.lit(shape.table).alias("table"), op.alias("op"), old.alias("before"), after.alias("after"), flags.alias("unchanged"), F.lit(0).alias("schema_id"),
    )
