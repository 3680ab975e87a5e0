"""The mirror as a streaming query: one published version per micro-batch.

``foreachBatch`` folds the rows of all tables and publishes data and offset in one manifest.  A
batch that comes again after a failure is recognised by that offset, which is looked at inside the commit, so rows are
applied exactly once, also for tables without keys and with two writers of one source.  A batch without rows
for any table (all filtered, or a source at rest) moves the offset alone.  An error ends the query; started again, it
replays from the checkpoint.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ddl import Evolver
from ..operators.envelope import KEEP, Shape, decode
from ..operators.lake import Lake, kind
from ..operators.progress import SyncState
from ..plans.ddl_text import Action, classify, from_audit

#: Columns of the audit table in the order of its tuple.
AUDIT = ("id", "ev", "tag", "object_type", "object_identity", "query_text", "xid", "occurred_at")


class Mirror:
    def __init__(self, lake: Lake, source: str, shape_of: Callable[[str], Shape], evolver: Evolver | None = None, state: SyncState | None = None, dialect: str = "pg", acknowledge: Callable[[dict], None] = lambda _: None):
        self.lake, self.source, self.shape_of, self.dialect, self.acknowledge = lake, source, shape_of, dialect, acknowledge
        self.evolver, self.state = evolver or Evolver(lake), state or SyncState(source)

    def offset(self, manifest: dict | None = None) -> int:
        return int((manifest or self.lake.manifest())["offsets"].get(self.source, {}).get("lsn", -1))

    def initialise(self, lsn: int) -> int:
        """Set the offset of a source that has none; the offset that holds."""

        def edit(m):
            if self.source in m["offsets"]:
                return False
            m["offsets"][self.source] = {"lsn": lsn}
            return None

        return self.offset(self.lake.commit(edit))

    def apply(self, batch: DataFrame, batch_id: int = 0) -> None:
        """Apply one micro-batch of envelope rows."""
        stages: dict[str, float] = {}
        batch = batch.persist()
        try:
            with self.state.timed(stages, "append"):
                found = self.survey(batch)
            if not found:
                return
            inside = lambda: sum(stages.get(s, 0.0) for s in ("lock_wait", "plan", "ensure", "staging_ddl", "mirror_dml"))
            began, before = time.perf_counter(), inside()
            waited = lambda ms: stages.update(lock_wait=ms)
            done: list[bool] = []
            new = self.lake.commit(lambda m: self.edit(m, batch, found, stages, done), waited)
            stages["lake_commit"] = (time.perf_counter() - began) * 1000 - (inside() - before)
        except Exception:
            self.state.failed()
            raise
        finally:
            with self.state.timed(stages, "cleanup"):
                batch.unpersist()
        with self.state.timed(stages, "offset_ack"):
            self.acknowledge(new["offsets"].get(self.source, {}))
        if not done[-1]:
            return
        times = [r["ts"] for r in found if r["ts"]]
        newest = int(max(times).timestamp() * 1000) if times else None
        rows = sum(r["n"] for r in found if r["table"] is not None)
        if not rows:
            self.state.filtered(newest)
            return
        self.state.delivered(newest)
        self.state.committed(rows, stages)

    @staticmethod
    def survey(batch: DataFrame) -> list:
        """A row for each table of a batch: what it holds, in one job.  Marks of the source's position have no table."""
        holes = (F.col("op") == "U") & F.coalesce(F.exists("unchanged", lambda x: x), F.lit(False))
        return batch.groupBy("table").agg(
            F.min("lsn").alias("first"), F.max("lsn").alias("lsn"), F.max("commit_ts").alias("ts"), F.count(F.lit(1)).alias("n"),
            F.bool_or(F.col("op") == "T").alias("cut"), F.bool_or(holes).alias("holes"), F.bool_or(F.col("op") == "DDL").alias("ddl"),
            F.bool_or((F.col("op") == "U") & F.col("before").isNotNull()).alias("moves"),
            F.coalesce(F.sum(F.octet_length(F.array_join("after", ""))), F.lit(0)).alias("bytes"),
            F.max_by(F.get("after", F.lit(0)), F.when(F.col("op") == KEEP, F.col("lsn"))).alias("position"),
        ).collect()

    def steps(self, batch: DataFrame) -> list[tuple]:
        """In order: ("rows", first lsn, first seq, end lsn, end seq) and ("ddl", actions).  DDL rows are few; only they reach the driver."""
        ddl = batch.where("op = 'DDL'").orderBy("lsn", "seq").select("lsn", "seq", "xid", "after").collect()
        found, at, i = [], (-1, -1), 0
        while i < len(ddl):
            j = i + 1
            while j < len(ddl) and ddl[j]["lsn"] == ddl[i]["lsn"] and ddl[j]["seq"] == ddl[j - 1]["seq"] + 1:
                j += 1  # rows of one run are read together: drops and ends of a transaction belong together
            found.append(("rows", at, (ddl[i]["lsn"], ddl[i]["seq"])))
            found.append(("ddl", self.actions([r["after"] for r in ddl[i:j]])))
            at, i = (ddl[j - 1]["lsn"], ddl[j - 1]["seq"]), j
        return [*found, ("rows", at, None)]

    def actions(self, tuples: list[list[str | None]]) -> list[Action]:
        if self.dialect == "mysql":
            return [a for sql, schema, *_ in tuples for a in classify(sql, schema)]
        return from_audit([dict(zip(AUDIT, t, strict=False)) for t in tuples])

    def edit(self, manifest: dict, batch: DataFrame, found: list, stages: dict, done: list[bool]) -> bool | None:
        """Edit a manifest: rows beyond its offset, and the offset.  ``found`` is the survey; ``done`` takes whether there was anything to do."""
        now, lsn = self.offset(manifest), max(r["lsn"] for r in found)
        done.append(lsn > now)
        if lsn <= now:
            return False
        position = next((r["position"] for r in found if r["table"] is None and r["position"]), None)
        manifest["offsets"][self.source] = {"lsn": lsn} | ({"position": json.loads(position)} if position else {})
        fresh = min(r["first"] for r in found) > now
        batch = batch if fresh else batch.where(F.col("lsn") > now)
        with self.state.timed(stages, "plan"):
            steps = self.steps(batch) if any(r["ddl"] for r in found) else [("rows", (-1, -1), None)]
        known = {r["table"]: r.asDict() for r in found if r["table"] is not None} if len(steps) == 1 and fresh else None
        if known == {}:
            return None
        rows = batch.where(~F.col("op").isin("DDL", KEEP))
        for what, *rest in steps:
            if what == "ddl":
                with self.state.timed(stages, "staging_ddl"):
                    self.state.counts["ddl_applied"] += self.evolver.apply(manifest, rest[0])
                continue
            start, end = rest
            place = F.struct("lsn", "seq")
            point = lambda p: F.struct(F.lit(p[0]).cast("long").alias("lsn"), F.lit(p[1]).cast("long").alias("seq"))
            part = rows.where(place > point(start))
            part = part.where(place < point(end)) if end else part
            for table in sorted(known if known is not None else (r[0] for r in part.select("table").distinct().collect())):
                shape = self.shape_of(table)
                name = self.lake.name_of(table)
                with self.state.timed(stages, "ensure"):
                    self.evolver.ensure(manifest, name, list(shape.columns), list(shape.keys))
                with self.state.timed(stages, "mirror_dml"):
                    columns = manifest["tables"][name]["columns"]
                    changes = widened(decode(part, shape), shape, columns)
                    same = known and columns_match(columns, shape)
                    self.lake.apply_changes(manifest, name, changes, known[table] if same else None)
        return None

    def start(self, stream: DataFrame, checkpoint: str, **trigger):
        """The running query; ``trigger`` as for ``writeStream.trigger``, by default all that is there."""
        return stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def columns_match(columns: list[dict], shape: Shape) -> bool:
    return [c["name"] for c in columns] == shape.names


def widened(changes: DataFrame, shape: Shape, columns: list[dict]) -> DataFrame:
    """Decoded changes in the lake's column order.  Columns that the source no longer has count as not sent by updates, and are null in new rows."""
    place, kinds = {n: i for i, n in enumerate(shape.names)}, dict(shape.columns)
    if columns_match(columns, shape):
        return changes
    value = lambda s, c: F.col(f"{s}.{c['name']}").cast(kinds[c["name"]]) if c["name"] in place else F.lit(None).cast(kind(c))
    side = lambda s: F.when(F.col(s).isNotNull(), F.struct(*[value(s, c).alias(c["name"]) for c in columns]))
    held = F.array(*[F.get("held", F.lit(place[c["name"]])) if c["name"] in place else F.col("op") == "U" for c in columns])
    return changes.withColumns({"old": side("old"), "new": side("new"), "held": held})
