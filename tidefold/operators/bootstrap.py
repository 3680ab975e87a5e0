"""Initial load of rows that were there before the stream began.

The stream starts first; then each table's current rows are added where their key isn't in the lake yet.
What the stream wrote meanwhile stays, and later events overwrite what was loaded, so the
order of the two doesn't matter.  A checklist in the manifest makes the load resumable: a table and its
tick are published together.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ddl import Definition, Evolver
from .lake import Lake

PENDING, DONE, SKIPPED = "pending", "done", "no-pk-skip"


def capture_filter(include: str = "", exclude: str = "", infrastructure: tuple[str, ...] = ()) -> Callable[[str], bool]:
    """Whether ``schema.table`` is captured: include patterns are matched against the schema, exclude patterns against the whole name.

    Both are comma-separated regular expressions that have to match in full, without regard to case.
    """
    parts = lambda text: [re.compile(p.strip(), re.I) for p in text.split(",") if p.strip()]
    wanted, unwanted = parts(include), parts(exclude)

    def captured(name: str) -> bool:
        schema, _, table = name.partition(".")
        if schema.lower() in SYSTEM_SCHEMAS or table in infrastructure:
            return False
        if wanted and not any(p.fullmatch(schema) for p in wanted):
            return False
        return not any(p.fullmatch(name) for p in unwanted)

    return captured


# Schemas of the database systems themselves.
SYSTEM_SCHEMAS = {"information_schema", "mysql", "performance_schema", "sys", "pg_catalog", "pg_toast"}


class Bootstrap:
    def __init__(self, lake: Lake, tables: Callable[[], list[str]], define: Callable[[str], Definition | None], load: Callable[[str, Definition], DataFrame], captured: Callable[[str], bool] = lambda _: True):
        self.lake, self.tables, self.define, self.load, self.captured = lake, tables, define, load, captured

    def checklist(self) -> dict[str, dict]:
        return self.lake.manifest()["control"].get("bootstrap", {})

    def wanted(self, enabled: bool = True, readable: bool = True, first_start: bool = True) -> bool:
        """Whether to load: switched on, the source readable, and a first start or unfinished tables."""
        pending = any(x["status"] == PENDING for x in self.checklist().values())
        return enabled and readable and (pending or (first_start and not self.checklist()))

    def seed(self) -> int:
        """Put all captured tables on an empty checklist; the number of tables on it."""

        def edit(manifest):
            if manifest["control"].get("bootstrap"):
                return False
            manifest["control"]["bootstrap"] = {t: {"status": PENDING, "rows": 0, "at": None} for t in sorted(self.tables()) if self.captured(t)}
            return None

        return len(self.lake.commit(edit)["control"].get("bootstrap", {}))

    def run(self) -> dict[str, str]:
        """Load what is pending, table by table; the status of each.  A failure leaves its table pending and stops no other."""
        self.seed()
        for table, item in self.checklist().items():
            if item["status"] == PENDING:
                try:
                    self.lake.commit(lambda m, t=table: self.load_one(m, t))
                except Exception as e:  # noqa: BLE001  reported in the checklist; the table stays pending
                    self.lake.commit(lambda m, t=table, e=e: m["control"]["bootstrap"][t].update(error=str(e)[:500]))
        return {t: x["status"] for t, x in self.checklist().items()}

    def load_one(self, manifest: dict, table: str) -> None:
        item = manifest["control"]["bootstrap"][table]
        definition = self.define(table)
        if definition is None or not definition.keys:
            item.update(status=SKIPPED, at=self.lake.clock())
            return
        name = self.lake.name_of(table)
        Evolver(self.lake).ensure(manifest, name, definition.columns, definition.keys)
        target = manifest["tables"][name]
        have = [c["name"] for c in target["columns"]]
        rows = self.load(table, definition)
        rows = rows.select(*[rows[n] for n in have if n in rows.columns])
        base = self.lake.rows(target)
        fresh = rows.join(base.select(*target["keys"]), target["keys"], "left_anti")
        before = sum(f["rows"] for f in target["files"]) + len(target["inline"])
        self.lake.put(target, fresh.select(*[fresh[n] if n in fresh.columns else F.lit(None).alias(n) for n in have]))
        item.update(status=DONE, rows=sum(f["rows"] for f in target["files"]) + len(target["inline"]) - before, at=self.lake.clock(), error=None)


