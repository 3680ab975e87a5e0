"""Snapshot tables: Parquet files plus one versioned manifest for all tables.

``<root>/_manifests/<version>.json`` is written once and names everything a version consists
of: tables, columns with stable ids, the lists of their files, and how far each
source has been applied.  Publishing a version is the exclusive creation of its file, so a
batch over several tables and its offset become visible together or not at all, and of two
writers one has to start over on the other's version.

A table's files (row counts, sizes, key ranges) stand in file lists of up to ``LIST_FILES`` entries
below ``_lists``, which are never changed: a version that touches some files writes the lists
anew that held them and names the others again.  Lists are read when a table's files are asked for, and kept.

Files store columns as ``c<id>``: renaming, dropping, adding and reordering columns touches
the manifest alone.  A change of rows rewrites only the files that hold touched keys, found
first by a join of the keys with the files' key ranges, then by the file a matching row came from.
"""

from __future__ import annotations

import copy
import json
import math
import threading
import time
import uuid
from collections import OrderedDict, defaultdict
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import reads_as
from . import fold
from .files import Store

EMPTY = {"version": 0, "ts": 0, "next_id": 1, "tables": {}, "offsets": {}, "control": {}}

#: Up to so many bytes (files as stored, changes as text) a rewrite gives one file, sorted by key; more are dealt into key ranges.
ONE_FILE_BYTES = 64 << 20
#: Entries of one file list, and the number of lists that aren't full which a table may have before they are merged.
LIST_FILES, LOOSE_LISTS = 4096, 32
#: Up to so many files the keys are looked for without a look at key ranges first.
FEW_FILES = 8
#: File lists that a lake keeps in memory.
KEPT_LISTS = 1024
#: Types whose text has the order that is needed to compare key ranges again; others (fractions by their rounding) have no range.
RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


class Conflict(Exception):
    """Another writer kept publishing first."""


def kind(column: dict) -> T.DataType:
    return T.DataType.fromDDL(column["type"]) if not column["type"].startswith("{") else T.StructType.fromJson(json.loads(column["type"]))


def written(data_type: T.DataType) -> str:
    return data_type.json() if isinstance(data_type, T.StructType) else data_type.simpleString()


class Table(dict):
    """A table of a manifest; ``files`` is read from the table's lists when it is first asked for."""

    def __init__(self, items: dict, load: Callable[[dict], list[dict]]):
        super().__init__(items)
        self.load = load

    def __missing__(self, key: str):
        if key != "files":
            raise KeyError(key)
        self["files"] = self.load(self)
        return self["files"]

    def __or__(self, other: dict) -> Table:
        return Table({**self, **other}, self.load)

    def __deepcopy__(self, memo: dict) -> Table:
        return Table({k: list(v) if k == "files" else copy.deepcopy(v, memo) for k, v in self.items()}, self.load)


def bound(value: str, kind: T.DataType):
    """A stored end of a key range as something that Python orders alike."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return Decimal(value)
    return bytes.fromhex(value) if isinstance(kind, T.BinaryType) else value.encode()


class Lake:
    def __init__(self, spark: SparkSession, root: str, prefix: str = "", retries: int = 20, pause: float = 0.1, growth: float = 1.5, inline_rows: int = 0, sort_by_key: bool = True, clock: Callable[[], float] = time.time):
        if not all(c.islower() or c.isdigit() or c == "_" for c in prefix):
            raise ValueError("a schema prefix has lower-case letters, digits and underscores only")
        self.spark, self.store, self.prefix = spark, Store(spark, root), prefix
        self.retries, self.pause, self.growth, self.inline_rows, self.sort_by_key, self.clock = retries, pause, growth, inline_rows, sort_by_key, clock
        self.lock = threading.RLock()
        self.lists: OrderedDict[str, list[dict]] = OrderedDict()

    # versions

    def versions(self) -> list[int]:
        names = (p.rsplit("/", 1)[1] for p, _, _ in self.store.list("_manifests"))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None, timestamp: float | None = None) -> dict:
        """The newest manifest, that of a version, or the newest at a time (seconds)."""
        if version == 0:
            return copy.deepcopy(EMPTY)
        if version is not None:
            if not self.store.exists(f"_manifests/{version}.json"):
                raise LookupError(f"version {version} is gone")
            return self.parsed(version)
        for v in reversed(self.versions()):
            m = self.parsed(v)
            if timestamp is None or m["ts"] <= timestamp:
                return m
        return copy.deepcopy(EMPTY)

    def parsed(self, version: int) -> dict:
        found = json.loads(self.store.read(f"_manifests/{version}.json"))
        found["tables"] = {name: Table(t, self.listed) for name, t in found["tables"].items()}
        return found

    def listed(self, table: dict) -> list[dict]:
        """The file entries of a table's lists."""
        return [f for item in table["lists"] for f in self.file_list(item["name"])]

    def file_list(self, name: str) -> list[dict]:
        if name not in self.lists:
            self.lists[name] = [f | {"list": name} for f in json.loads(self.store.read(f"_lists/{name}"))]
        self.lists.move_to_end(name)
        while len(self.lists) > KEPT_LISTS:
            self.lists.popitem(last=False)
        return self.lists[name]

    def sealed(self, table: dict) -> dict:
        """A table as a manifest stores it.  Lists of which an entry is gone, and many short ones, are written anew."""
        plain = {k: v for k, v in table.items() if k != "files"}
        if "files" not in table:
            return plain
        own: dict[str | None, list[dict]] = defaultdict(list)
        for f in table["files"]:
            own[f.get("list")].append(f)
        kept = [item for item in table["lists"] if len(own[item["name"]]) == item["n"]]
        short = [item for item in kept if item["n"] < LIST_FILES // 2]
        if len(short) > LOOSE_LISTS:
            kept = [item for item in kept if item not in short]
        names = {item["name"] for item in kept}
        loose = [{k: v for k, v in f.items() if k != "list"} for f in table["files"] if f.get("list") not in names]
        for at in range(0, len(loose), LIST_FILES):
            part, name = loose[at : at + LIST_FILES], f"{uuid.uuid4().hex}.json"
            self.store.write(f"_lists/{name}", json.dumps(part))
            self.lists[name] = [f | {"list": name} for f in part]
            kept.append({"name": name, "n": len(part)})
        used = {f["shape"] for item in kept for f in self.file_list(item["name"])} if len(plain["shapes"]) > 64 else None
        if used is not None:
            plain["shapes"] = {k: v for k, v in plain["shapes"].items() if int(k) in used}
        return plain | {"lists": kept}

    def commit(self, edit: Callable[[dict], bool | None], waited: Callable[[float], None] = lambda _: None) -> dict:
        """Apply ``edit`` to the newest manifest and publish it as the next version; ``waited`` is told the milliseconds until the lake's lock was free.

        ``edit`` may write data files; it returns False to publish nothing.  If another writer
        publishes first, the edit is made anew on top of that version.
        """
        wait, began = self.pause, time.perf_counter()
        with self.lock:
            waited((time.perf_counter() - began) * 1000)
            for _ in range(self.retries + 1):
                new = self.manifest()
                version = new["version"]
                if edit(new) is False:
                    return self.manifest(version)
                new["version"], new["ts"] = version + 1, self.clock()
                text = json.dumps(new | {"tables": {name: self.sealed(t) for name, t in new["tables"].items()}})
                if self.store.create(f"_manifests/{new['version']}.json", text):
                    return new
                time.sleep(wait)
                wait *= self.growth
        raise Conflict(f"no version published in {self.retries + 1} attempts")

    def snapshots(self) -> DataFrame:
        """version, ts, tables, files of each kept version."""
        rows = []
        for v in self.versions():
            m = self.manifest(v)
            rows.append((v, float(m["ts"]), len(m["tables"]), sum(item["n"] for t in m["tables"].values() for item in t["lists"])))
        return self.spark.createDataFrame(rows, "version long, ts double, tables int, files int")

    # shapes

    def name_of(self, source: str) -> str:
        """Lake name of a source table: the schema gets the prefix."""
        return self.prefix + source

    def source_of(self, name: str) -> str:
        return name.removeprefix(self.prefix)

    @staticmethod
    def table(manifest: dict, name: str) -> dict:
        if name not in manifest["tables"]:
            raise LookupError(f"no table {name}")
        return manifest["tables"][name]

    @staticmethod
    def new_column(manifest: dict, name: str, data_type: T.DataType, comment: str | None = None) -> dict:
        manifest["next_id"] += 1
        return {"id": manifest["next_id"], "name": name, "type": written(data_type), "comment": comment}

    def add_table(self, manifest: dict, name: str, columns: list[tuple[str, T.DataType]], keys: list[str], comment: str | None = None, comments: dict | None = None) -> dict:
        """Put an empty table into a manifest, unless it is there."""
        if name not in manifest["tables"]:
            own = [self.new_column(manifest, n, t, (comments or {}).get(n)) for n, t in columns]
            made = {"table_id": uuid.uuid4().hex[:12], "columns": own, "keys": list(keys), "comment": comment, "lists": [], "shapes": {}, "inline": []}
            manifest["tables"][name] = Table(made, self.listed)
        return manifest["tables"][name]

    @staticmethod
    def schema(table: dict) -> T.StructType:
        meta = lambda c: {"comment": c["comment"]} if c.get("comment") else {}
        return T.StructType([T.StructField(c["name"], kind(c), True, meta(c)) for c in table["columns"]])

    # rows

    def read(self, name: str, version: int | None = None, timestamp: float | None = None) -> DataFrame:
        """The rows of a table now, in a version, or at a time."""
        return self.rows(self.table(self.manifest(version, timestamp), name))

    def rows(self, table: dict, files: list[dict] | None = None, inline: bool = True) -> DataFrame:
        chosen = table["files"] if files is None else files
        stored = T.StructType([T.StructField(f"c{c['id']}", kind(c)) for c in table["columns"]])
        found = self.spark.read.schema(stored).parquet(*[self.store.at(f["path"]) for f in chosen])
        named = found.select(*[F.col(f"c{c['id']}").alias(c["name"], metadata={"comment": c["comment"]} if c.get("comment") else {}) for c in table["columns"]])
        if inline and files is None and table["inline"]:
            text = self.spark.createDataFrame([(json.dumps(r),) for r in table["inline"]], "j string")
            named = named.unionByName(text.select(F.from_json("j", stored).alias("r")).select(*[F.col(f"r.c{c['id']}").alias(c["name"]) for c in table["columns"]]))
        return named

    def write(self, table: dict, rows: DataFrame, partitions: int | None = None) -> list[dict]:
        """Write rows as new files; their entries, with key ranges.  The manifest doesn't know them yet.

        One partition is observed while it is written; of more the key column is read again, on the cluster.
        """
        folder = f"data/{table['table_id']}/{uuid.uuid4().hex}"
        physical = rows.select(*[F.col(c["name"]).cast(kind(c)).alias(f"c{c['id']}") for c in table["columns"]])
        by_name = {c["name"]: c for c in table["columns"]}
        keys = [f"c{by_name[k]['id']}" for k in table["keys"] if k in by_name]
        if partitions:
            physical = physical.repartition(partitions)
        if keys and self.sort_by_key:
            physical = (physical.repartitionByRange(*keys) if not partitions else physical).sortWithinPartitions(*keys)
        lead = by_name[table["keys"][0]] if keys and table["keys"][0] in by_name else None
        lead = lead if lead and isinstance(kind(lead), RANGED) else None
        end = lambda f: (F.hex(f(f"c{lead['id']}")) if isinstance(kind(lead), T.BinaryType) else f(f"c{lead['id']}").cast("string")) if lead else F.lit(None).cast("string")
        ends = [F.count(F.lit(1)).alias("n"), end(F.min).alias("lo"), end(F.max).alias("hi")]
        common = {"shape": self.shape_number(table), **({"lead": lead["id"]} if lead else {})}
        if partitions == 1:
            seen = Observation()
            physical.observe(seen, *ends).write.parquet(self.store.at(folder))
            files = [(p, size) for p, size, _ in self.store.list(folder) if p.endswith(".parquet")]
            if len(files) == 1:
                one = seen.get
                return [{"path": f"{folder}/{files[0][0].rsplit('/', 1)[1]}", "rows": one["n"], "bytes": files[0][1], "lo": one["lo"], "hi": one["hi"]} | common] if one["n"] else []
        else:
            physical.write.parquet(self.store.at(folder))
        stats = self.spark.read.schema(physical.schema).parquet(self.store.at(folder)).select("*", "_metadata.file_path", "_metadata.file_size")
        found = stats.groupBy("file_path", "file_size").agg(*ends).collect()
        return [{"path": f"{folder}/{r['file_path'].rsplit('/', 1)[1]}", "rows": r["n"], "bytes": r["file_size"], "lo": r["lo"], "hi": r["hi"]} | common for r in found]

    @staticmethod
    def shape_number(table: dict) -> int:
        """The number under which the table keeps the stored types of its files: column id to type, once for all files alike."""
        types = {str(c["id"]): c["type"] for c in table["columns"]}
        for number, known in table["shapes"].items():
            if known == types:
                return int(number)
        number = max(map(int, table["shapes"]), default=0) + 1
        table["shapes"][str(number)] = types
        return number

    def put(self, table: dict, rows: DataFrame, partitions: int | None = None) -> None:
        """Add rows to a table of a manifest: inline if they are few, as files otherwise."""
        if self.inline_rows:
            few = rows.select(*[F.col(c["name"]).alias(f"c{c['id']}") for c in table["columns"]]).limit(self.inline_rows + 1)
            taken = [json.loads(r[0]) for r in few.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()] if not any(isinstance(kind(c), (T.VariantType, T.BinaryType)) for c in table["columns"]) else None
            if taken is not None and len(taken) + len(table["inline"]) <= self.inline_rows:
                table["inline"] = table["inline"] + taken
                return
        table["files"] = table["files"] + self.write(table, rows, partitions)

    def replace_rows(self, table: dict, rows: DataFrame) -> None:
        """All rows of a table of a manifest anew, in new files."""
        files = self.write(table, rows)
        table["files"], table["inline"] = files, []

    def near_files(self, table: dict, keys: DataFrame) -> list[dict]:
        """Files whose range holds one of the keys.

        A range join in two levels: files in key order form groups of about the root of their number, keys meet
        the groups' ranges (a broadcast of as many rows), then the files of the groups they fell into.
        """
        lead = next(c for c in table["columns"] if c["name"] == table["keys"][0])
        own = kind(lead)
        ranged = [f for f in table["files"] if f.get("lead") == lead["id"]] if isinstance(own, RANGED) else []
        if len(ranged) <= FEW_FILES:
            return table["files"]
        known = sorted((f for f in ranged if f["lo"] is not None), key=lambda f: bound(f["lo"], own))  # others hold null keys only, which match nothing
        size = math.isqrt(len(known)) + 1
        groups = []
        for g in range(0, len(known), size):
            part = known[g : g + size]
            groups.append((g // size, min((f["lo"] for f in part), key=lambda x: bound(x, own)), max((f["hi"] for f in part), key=lambda x: bound(x, own))))
        value = lambda c: F.unhex(c) if isinstance(own, T.BinaryType) else F.col(c).cast(own)
        ends = "g int, lo string, hi string"
        wide = self.spark.createDataFrame(groups, ends).select("g", value("lo").alias("lo"), value("hi").alias("hi"))
        narrow = self.spark.createDataFrame([(i // size, f["lo"], f["hi"], i) for i, f in enumerate(known)], f"{ends}, i int").select("g", value("lo").alias("lo"), value("hi").alias("hi"), "i")
        one = keys.select(F.col(lead["name"]).alias("k")).distinct()
        met = one.join(F.broadcast(wide), F.col("k").between(F.col("lo"), F.col("hi"))).select("k", "g")
        met = met.join(narrow, "g").where(F.col("k").between(F.col("lo"), F.col("hi")))
        hit = {known[r["i"]]["path"] for r in met.select("i").distinct().collect()}  # at most the table's number of files
        measured = {f["path"] for f in ranged}
        return [f for f in table["files"] if f["path"] in hit or f["path"] not in measured]

    def touched_files(self, table: dict, keys: DataFrame) -> list[dict]:
        """Files that hold a row with one of the keys: pruned by range first, then by a semi join."""
        names = table["keys"]
        ids = {c["name"]: c for c in table["columns"]}
        files = self.near_files(table, keys) if table["files"] else []
        if not files:
            return []
        stored = T.StructType([T.StructField(f"c{ids[n]['id']}", kind(ids[n])) for n in names])
        own = self.spark.read.schema(stored).parquet(*[self.store.at(f["path"]) for f in files])
        own = own.select(*[F.col(f"c{ids[n]['id']}").alias(n) for n in names], F.col("_metadata.file_path").alias("__file"))
        found = {r[0].rsplit("/", 2)[-2] + "/" + r[0].rsplit("/", 1)[1] for r in own.join(keys, names, "left_semi").select("__file").distinct().collect()}
        return [f for f in files if "/".join(f["path"].rsplit("/", 2)[-2:]) in found]

    def apply_changes(self, manifest: dict, name: str, changes: DataFrame, summary: dict | None = None) -> None:
        """Fold decoded changes (see ``envelope.decode``) of one table into a manifest.

        ``summary`` says what the changes hold (cut: a truncate, holes: unsent columns, n: rows, bytes: as text); it is
        counted if not given.
        """
        table = self.table(manifest, name)
        keys = table["keys"]
        if summary is None:
            summary = changes.agg(
                F.coalesce(F.bool_or(F.col("op") == "T"), F.lit(False)).alias("cut"),
                F.coalesce(F.bool_or((F.col("op") == "U") & F.exists("held", lambda x: x)), F.lit(False)).alias("holes"),
                F.coalesce(F.bool_or((F.col("op") == "U") & F.col("old").isNotNull()), F.lit(False)).alias("moves"),
                F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum(F.octet_length(F.col("new").cast("string"))), F.lit(0)).alias("bytes"),
            ).first()
        if not summary["n"]:
            return
        if not keys:
            if summary["cut"]:
                table["files"], table["inline"] = [], []
            self.put(table, fold.mirror(None, changes, [], summary["cut"]), 1 if summary["bytes"] <= ONE_FILE_BYTES else None)
            return
        step = fold.replay if summary["holes"] else lambda b, c, k: fold.mirror(b, c, k, summary["cut"], summary["moves"])
        if summary["cut"]:
            self.replace_rows(table, step(self.rows(table, []), changes, keys))
            return
        hit = []
        if table["files"]:
            names = fold.split_moves(changes, keys, summary["moves"]).select(*fold.row_of(keys))
            hit = self.touched_files(table, names.where(" and ".join(f"`{k}` is not null" for k in keys)))
        if not hit and not table["inline"] and not summary["holes"]:
            few = summary["bytes"] <= ONE_FILE_BYTES
            self.put(table, step(None, changes, keys), 1 if few else None)
            return
        base = self.rows(table, hit)
        if table["inline"]:
            base = base.unionByName(self.rows(table | {"files": []}).select(*base.columns))
            table["inline"] = []
        gone = {f["path"] for f in hit}
        table["files"] = [f for f in table["files"] if f["path"] not in gone]
        few = sum(f["bytes"] for f in hit) + summary["bytes"] <= ONE_FILE_BYTES
        self.put(table, step(base, changes, keys), 1 if few else None)

    def truncate(self, manifest: dict, name: str) -> None:
        if name in manifest["tables"]:
            manifest["tables"][name]["files"], manifest["tables"][name]["inline"] = [], []

    def conform(self, table: dict) -> None:
        """Rewrite the files whose stored types can't be read as the table's (strict casts): one job for all files with the same types."""
        by_id = {str(c["id"]): c for c in table["columns"]}
        for number, types in dict(table["shapes"]).items():
            if all(i not in by_id or reads_as(kind({"type": t}), kind(by_id[i])) for i, t in types.items()):
                continue
            stale = [f for f in table["files"] if f["shape"] == int(number)]
            if not stale:
                continue
            stored = T.StructType([T.StructField(f"c{i}", kind({"type": t})) for i, t in types.items()])
            old = self.spark.read.schema(stored).parquet(*[self.store.at(f["path"]) for f in stale])
            value = lambda c: rewritten(F.col(f"c{c['id']}"), kind({"type": types[str(c["id"])]}), kind(c)) if str(c["id"]) in types else F.lit(None).cast(kind(c))  # noqa: E731,B023
            few = sum(f["bytes"] for f in stale) <= ONE_FILE_BYTES
            files = self.write(table, old.select(*[value(c).alias(c["name"]) for c in table["columns"]]), 1 if few else None)
            gone = {f["path"] for f in stale}
            table["files"] = [f for f in table["files"] if f["path"] not in gone] + files

    def changes(self, name: str, start: int, end: int) -> DataFrame:
        """Differences between two versions: change (insert, delete, update_before, update_after) and the columns of the later one.

        Tables with a key are compared row by row of a key; without one, as multisets.  Files that both versions name
        hold the same rows, so only the others are read, unless the columns differ in more than their order.
        """
        late = self.table(self.manifest(end), name)
        before = self.manifest(start)["tables"].get(name)
        same = before is not None and before["table_id"] == late["table_id"] and {(c["id"], c["type"]) for c in before["columns"]} == {(c["id"], c["type"]) for c in late["columns"]}
        both = {f["path"] for f in before["files"]} & {f["path"] for f in late["files"]} if same else set()
        differing = lambda t: self.rows(t | {"files": [f for f in t["files"] if f["path"] not in both]})
        new = differing(late)
        old = differing(before) if before else new.limit(0)
        kept = {c["id"]: c["name"] for c in before["columns"]} if before else {}
        old = old.select(*[(F.col(kept[c["id"]]) if c["id"] in kept else F.lit(None)).cast(kind(c)).alias(c["name"]) for c in late["columns"]]) if before else old
        names = [c["name"] for c in late["columns"]]
        keyed = late["keys"] and set(late["keys"]) <= set(names) and not any(isinstance(kind(c), T.VariantType) for c in late["columns"])
        if not keyed:
            gone, come = old.exceptAll(new), new.exceptAll(old)
            return gone.select(F.lit("delete").alias("change"), *names).unionByName(come.select(F.lit("insert").alias("change"), *names))
        # one join by key, null-safe; rows that are equal on both sides go
        side = lambda df, mark: df.select(F.struct(*names).alias(mark), *[F.col(k).alias(f"__{mark}_{k}") for k in late["keys"]])
        match = None
        for k in late["keys"]:
            one = F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}"))
            match = one if match is None else match & one
        pairs = side(old, "o").join(side(new, "n"), match, "full").where(~F.col("o").eqNullSafe(F.col("n")))
        change = lambda what, row: F.struct(F.lit(what).alias("change"), F.col(row).alias("row"))
        found = F.when(F.col("n").isNull(), F.array(change("delete", "o"))).when(F.col("o").isNull(), F.array(change("insert", "n")))
        found = found.otherwise(F.array(change("update_before", "o"), change("update_after", "n")))
        return pairs.select(F.explode(found).alias("x")).select("x.change", "x.row.*")

    def views(self) -> list[str]:
        """Register every table as a temporary view (dots become underscores); their names."""
        found = []
        manifest = self.manifest()
        for name, table in manifest["tables"].items():
            self.rows(table).createOrReplaceTempView(view := name.replace(".", "_"))
            found.append(view)
        return found

    def scalar(self, sql: str):
        """The first value of a query over the views."""
        self.views()
        row = self.spark.sql(sql).first()
        return None if row is None else row[0]


def rewritten(value, old: T.DataType, new: T.DataType):
    """A value under a new type; fractions round half up on the way to whole numbers."""
    if isinstance(new, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) and isinstance(old, T.StringType):
        return F.round(value.cast("decimal(38,6)")).cast(new)
    if isinstance(new, T.ArrayType) and isinstance(old, T.StringType):
        from ..functions.casts import pg_array

        return pg_array(value, new, strict=True)
    return value.cast(new)
