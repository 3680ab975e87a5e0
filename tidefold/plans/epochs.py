"""Order inside a batch: segments, epochs, pairing of DDL rows.

The fold needs no step-by-step replay; what has to stay apart is decided here, over all
tables of a batch at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DATA, PATCH, BARRIER = "DATA", "PATCH", "BARRIER"


def kind_of(op: Column, held: Column) -> Column:
    """DATA for full rows, PATCH for updates with columns that weren't sent, BARRIER for truncate and DDL."""
    holes = F.coalesce(F.exists(held, lambda x: x), F.lit(False))
    return F.when(op.isin("T", "DDL"), op).when((op == "U") & holes, F.lit(PATCH)).otherwise(F.lit(DATA))


def segments(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``events`` with ``kind`` and ``segment``: runs of one table and kind in the order (lsn, seq).

    Truncates and DDL stand alone; patches of one run send the same columns.  ``by`` (the source,
    unless given) partitions the order.
    """
    window = Window.partitionBy(*(by or ["source"])).orderBy("lsn", "seq")
    held = F.col("unchanged")
    marked = events.withColumn("kind", kind_of(F.col("op"), held))
    mask = F.when(F.col("kind") == PATCH, held.cast("string"))
    before = lambda c: F.lag(c).over(window)
    same = (
        F.col("table").eqNullSafe(before("table"))
        & F.col("kind").eqNullSafe(before("kind"))
        & F.col("__mask").eqNullSafe(before("__mask"))
        & ~F.col("kind").isin("T", "DDL")
    )
    marked = marked.withColumn("__mask", mask)
    marked = marked.withColumn("__new", F.when(same, 0).otherwise(1))
    return marked.withColumn("segment", F.sum("__new").over(window).cast("long")).drop("__mask", "__new")


def epochs(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``events`` with ``epoch``: the number of truncates up to the event, per table."""
    window = Window.partitionBy(*(by or ["source", "table"])).orderBy("lsn", "seq")
    return events.withColumn("epoch", F.sum(F.when(F.col("op") == "T", 1).otherwise(0)).over(window).cast("long"))


def paired_ddl(audit: DataFrame) -> DataFrame:
    """Audit rows of a batch with ``drops``: what the same transaction dropped (identities of its sql_drop rows, sorted).

    The end row of an ALTER doesn't say what went; the drop rows of its transaction do.
    """
    dropped = audit.where(F.col("ev") == "sql_drop").groupBy("xid").agg(F.array_sort(F.collect_list("object_identity")).alias("drops"))
    ends = audit.where(F.col("ev") == "ddl_command_end")
    return ends.join(dropped, "xid", "left").withColumn("drops", F.coalesce("drops", F.array().cast("array<string>")))


def must_replay(changes: DataFrame, keys: list[str]) -> Column | None:
    """Condition for updates that move a key *and* leave columns unsent: these end a step and are applied by themselves."""
    if not keys:
        return None
    differs = F.struct(*[F.col(f"old.{k}") for k in keys]) != F.struct(*[F.col(f"new.{k}") for k in keys])
    return (F.col("op") == "U") & F.col("old").isNotNull() & differs & F.exists("held", lambda x: x)
