"""The mirror fold: a batch of changes and the current rows give the new current rows.

All functions take the decoded form (``op, at, old, new, held``; see ``envelope.decode``) and
are plain DataFrame expressions: one window per key, one anti join.  A hot key costs a task
no more than its last row, since Spark limits each group before the shuffle.

Null keys never match, as in SQL; ties of ``at`` don't occur within a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.epochs import must_replay
from ..scratch import shared_folder
from .envelope import DELETE, INSERT, TRUNCATE, UPDATE


def split_moves(changes: DataFrame, keys: list[str], moves: bool = True) -> DataFrame:
    """An update that changes its key becomes a delete of the old key, then a write of the new row.

    Columns that the update didn't send can't be carried over here: ``replay`` takes such moves out
    first.  ``step`` orders the two halves.  With ``moves`` false no update carries an old key.
    """
    if not moves:
        return changes.withColumn("order", F.struct("at.lsn", "at.seq", F.lit(1).alias("step"))).drop("at")
    moved = (F.col("op") == UPDATE) & F.col("old").isNotNull()
    for_key = lambda side: F.struct(*[F.col(f"{side}.{k}").alias(k) for k in keys])
    moved = moved & (for_key("old") != for_key("new"))
    empty = F.lit(None).cast(changes.schema["new"].dataType)
    halves = F.array(
        F.struct(F.lit(DELETE).alias("op"), F.lit(0).alias("step"), F.col("old"), empty.alias("new")),
        F.struct(F.lit(INSERT).alias("op"), F.lit(1).alias("step"), empty.alias("old"), F.col("new")),
    )
    whole = F.array(F.struct(F.col("op"), F.lit(1).alias("step"), F.col("old"), F.col("new")))
    parts = F.explode(F.when(moved, halves).otherwise(whole)).alias("p")
    rest = [c for c in changes.columns if c not in ("op", "old", "new")]
    return changes.select(*rest, parts).select(*rest, "p.op", "p.old", "p.new", F.struct("at.lsn", "at.seq", "p.step").alias("order"))


def row_of(keys: list[str]) -> list[Column]:
    """The key of a change, from whichever side has it."""
    return [F.coalesce(F.col(f"new.{k}"), F.col(f"old.{k}")).alias(k) for k in keys]


def latest(changes: DataFrame, keys: list[str], order: str = "at") -> DataFrame:
    """The last change of each key: op, row (struct) and the key columns."""
    keyed = changes.where(F.col("op").isin(INSERT, UPDATE, DELETE)).select("op", order, F.col("new").alias("row"), *[c.alias(f"__k_{k}") for c, k in zip(row_of(keys), keys, strict=True)])
    window = Window.partitionBy(*[f"__k_{k}" for k in keys]).orderBy(F.desc(order))
    return keyed.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n", order)


def after_truncate(changes: DataFrame) -> tuple[DataFrame, Column]:
    """Changes behind the last truncate, and a condition (without columns of either side) for keeping the base."""
    cut = changes.where(F.col("op") == TRUNCATE).select(F.max("at")).scalar()
    return changes.where((F.col("op") != TRUNCATE) & (cut.isNull() | (F.col("at") > cut))), cut.isNull()


def mirror(base: DataFrame | None, changes: DataFrame, keys: list[str], cut: bool = True, moves: bool = True) -> DataFrame:
    """Current rows after a batch of full changes (fast path: no patches).

    Rows of ``base`` (none: no rows) whose key is touched go, the last live row of each key comes.  Without keys
    the table only grows: live inserts are appended.  ``cut`` and ``moves`` are false where it is known that
    the batch holds no truncate and no old keys.
    """
    live, keep = after_truncate(changes) if cut else (changes, F.lit(True))
    kept = base.where(keep) if base is not None and cut else base
    if not keys:
        fresh = live.where(F.col("op").isin(INSERT, UPDATE) & F.col("new").isNotNull()).select("new.*")
        return fresh if kept is None else kept.unionByName(fresh)
    last = latest(split_moves(live, keys, moves), keys, "order")
    if kept is None:
        return last.where(F.col("op") != DELETE).select("row.*")
    touched = last.select(*[F.col(f"__k_{k}").alias(f"__t_{k}") for k in keys])
    same = None
    for k in keys:
        one = F.col(k) == F.col(f"__t_{k}")
        same = one if same is None else same & one
    fresh = last.where(F.col("op") != DELETE).select("row.*")
    return kept.join(touched, same, "left_anti").unionByName(fresh)


def patch(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows after a batch that has updates with columns that weren't sent (no key moves among those).

    Per key, changes behind the last full one are patches; a column's value is the last one
    sent.  A key whose changes are all patches takes the missing columns from ``base`` and, if
    it isn't there, is dropped: the initial load will bring it.  Patches behind a delete are dropped.
    """
    live, keep = after_truncate(changes)
    names = base.columns
    kept = base.where(keep)
    moved = split_moves(live, keys)
    full = F.col("op").isin(INSERT, DELETE) | ((F.col("op") == UPDATE) & ~F.exists("held", lambda x: x))
    rows = moved.select("op", "order", "new", "held", full.alias("full"), *[c.alias(f"__k_{k}") for c, k in zip(row_of(keys), keys, strict=True)])
    key_names = [f"__k_{k}" for k in keys]
    by_time = Window.partitionBy(*key_names).orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("part", F.sum(F.col("full").cast("int")).over(by_time))
    newest = Window.partitionBy(*key_names)
    rows = rows.withColumn("newest", F.max("part").over(newest)).where("part = newest")
    box = lambda i, n: F.when((F.col("op") != DELETE) & (F.col("full") | ~F.get("held", F.lit(i))), F.struct(F.col(f"new.{n}").alias("v")))
    boxed = rows.select("order", "part", "op", *key_names, *[box(i, n).alias(f"__b_{i}") for i, n in enumerate(names)])
    stamped = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("order")))
    one = boxed.groupBy(*key_names).agg(
        F.max("part").alias("part"), F.min_by("op", "order").alias("first_op"), *[stamped(f"__b_{i}").alias(f"__b_{i}") for i in range(len(names))]
    )
    whole = one.where("part > 0 and first_op <> 'D'").select(*[F.col(f"__b_{i}.v").alias(n) for i, n in enumerate(names)])
    holes = one.where("part = 0")
    same = None
    for k in keys:
        match = F.col(f"__x_{k}") == F.col(f"__k_{k}")
        same = match if same is None else same & match
    old = kept.select(*[F.col(n).alias(f"__x_{n}") for n in names])
    filled = holes.join(old, same).select(*[F.when(F.col(f"__b_{i}").isNotNull(), F.col(f"__b_{i}.v")).otherwise(F.col(f"__x_{n}")).alias(n) for i, n in enumerate(names)])
    survivors = old.join(one.select(*key_names), same, "left_anti").select(*[F.col(f"__x_{n}").alias(n) for n in names])
    return survivors.unionByName(whole).unionByName(filled)


def move(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Updates that move a key and leave columns unsent, one per key: the new row takes those columns from the old one.

    Where the old row isn't there, nothing happens: the initial load will bring the row.
    """
    names = base.columns
    old = base.select(*[F.col(n).alias(f"__x_{n}") for n in names])
    hit = None
    for k in keys:
        one = F.col(f"__x_{k}") == F.col(f"old.{k}")
        hit = one if hit is None else hit & one
    value = lambda i, n: F.when(F.get("held", F.lit(i)), F.col(f"__x_{n}")).otherwise(F.col(f"new.{n}")).alias(n)
    found = changes.join(old, hit).select(*[value(i, n) for i, n in enumerate(names)], *[F.col(f"old.{k}").alias(f"__o_{k}") for k in keys])
    gone = found.select(*[F.col(f"__o_{k}").alias(k) for k in keys]).union(found.select(*keys))
    return base.join(gone, keys, "left_anti").select(*names).unionByName(found.select(*names))


def _written(rows: DataFrame) -> DataFrame:
    path = shared_folder(rows.sparkSession, "replay")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def replay(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``patch``, also with moves that leave columns unsent: rare changes, each of which ends a step.

    Only the places of these changes reach the driver.  Each step's rows are written to the shared
    folder, since a step uses its base twice and plans would double.
    """
    moves = must_replay(changes, keys)
    stops = [r["at"] for r in changes.where(moves).select("at").orderBy("at").collect()]
    point = lambda p: F.struct(F.lit(p["lsn"]).cast("long").alias("lsn"), F.lit(p["seq"]).cast("long").alias("seq"))
    last = None
    for stop in [*stops, None]:
        part = changes if last is None else changes.where(F.col("at") > point(last))
        part = part if stop is None else part.where(F.col("at") < point(stop))
        base = patch(base, part, keys)
        if stop is not None:
            base = _written(move(base, changes.where(F.col("at") == point(stop)), keys))
        last = stop
    return base


def insert_missing(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` and those of ``rows`` whose key it doesn't have (initial load, refill): what the stream wrote stays."""
    return base.unionByName(rows.join(base.select(*keys), keys, "left_anti").select(*base.columns))


def update_from(base: DataFrame, patches: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` with the columns of ``patches`` set where the keys match (null-safe)."""
    marked = patches.select(*[F.col(c).alias(f"__p_{c}") for c in patches.columns], F.lit(True).alias("__hit"))
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__p_{k}"))
        same = one if same is None else same & one
    value = lambda c: F.when(F.col("__hit"), F.col(f"__p_{c}")).otherwise(F.col(c)).alias(c) if c in patches.columns and c not in keys else F.col(c)
    return base.join(marked, same, "left").select(*[value(c) for c in base.columns])
