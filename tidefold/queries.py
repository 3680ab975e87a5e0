"""Queries over the driver's tables, one or more per operator, and DuckDB SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import casts
from .functions.types import mysql_type, pg_type
from .operators import fold
from .operators.bootstrap import Bootstrap, capture_filter
from .operators.ddl import Definition, Evolver
from .operators.envelope import Shape, changelog, decode
from .operators.lake import Lake
from .operators.maintain import Maintenance
from .operators.progress import percentiles, watermark
from .plans import epochs
from .plans.ddl_text import Action, classify
from .scratch import shared_folder
from .streaming.mirror import Mirror

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it has any."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EVENTS = Shape("app.events", (("user_id", T.LongType()), ("event_id", T.LongType()), ("event_type", T.StringType()), ("value", T.DoubleType())), ("user_id",))
ORDERS = Shape("app.orders", (("o_orderkey", T.LongType()), ("o_custkey", T.LongType()), ("o_totalprice", T.DoubleType()), ("o_orderstatus", T.StringType())), ("o_orderkey",))
CUSTOMER = Shape("app.customer", (("c_custkey", T.LongType()), ("c_name", T.StringType()), ("c_acctbal", T.DoubleType())), ("c_custkey",))
SUPPLIER = Shape("app.supplier", (("s_suppkey", T.LongType()), ("s_name", T.StringType()), ("s_acctbal", T.DoubleType())), ("s_suppkey",))


def event_log(spark: SparkSession, sf_dir: str, shape: Shape = EVENTS) -> DataFrame:
    """The events as a change log per user; an error deletes the user's row."""
    rows = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "error", "D").otherwise("U")
    return changelog(rows, shape, op, F.col("event_id"), commit_ts=F.col("ts"))


def empty(spark: SparkSession, shape: Shape) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in shape.columns]))


LATEST_SQL = """SELECT user_id, event_id, event_type, value FROM
(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'error'"""


@query(LATEST_SQL)
def mirror_latest(spark, sf_dir):
    return fold.mirror(empty(spark, EVENTS), decode(event_log(spark, sf_dir), EVENTS), ["user_id"])


@query("SELECT user_id, event_id AS last_event FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1 AND event_type = 'error'")
def mirror_delete(spark, sf_dir):
    last = fold.latest(decode(event_log(spark, sf_dir), EVENTS).withColumn("new", F.coalesce("new", "old")), ["user_id"])
    return last.where("op = 'D'").select(F.col("__k_user_id").alias("user_id"), F.col("row.event_id").alias("last_event"))


@query(LATEST_SQL)
def mirror_two_batches(spark, sf_dir):
    log = event_log(spark, sf_dir)
    half = F.col("lsn") < 5000
    first = fold.mirror(empty(spark, EVENTS), decode(log.where(half), EVENTS), ["user_id"])
    return fold.mirror(first, decode(log.where(~half), EVENTS), ["user_id"])


@query(LATEST_SQL)
def mirror_replay_idempotent(spark, sf_dir):
    changes = decode(event_log(spark, sf_dir), EVENTS)
    return fold.mirror(fold.mirror(empty(spark, EVENTS), changes, ["user_id"]), changes, ["user_id"])


@query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events WHERE event_type <> 'error' GROUP BY event_type")
def mirror_nopk_append(spark, sf_dir):
    rows = fold.mirror(empty(spark, EVENTS), decode(event_log(spark, sf_dir), EVENTS), [])
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("""SELECT CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey, o_custkey,
CASE WHEN o_orderkey % 10 = 0 THEN 1.5 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders""")
def mirror_key_move(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    base = rows.select(*ORDERS.names)
    moved = rows.where("o_orderkey % 10 = 0")
    old = [F.col(n) for n in ORDERS.names]
    new = moved.withColumns({"o_totalprice": F.lit(1.5), "old_key": F.col("o_orderkey"), "o_orderkey": F.col("o_orderkey") + 100_000_000})
    log = changelog(new, ORDERS, F.lit("U"), F.col("old_key"), before=[F.col("old_key"), *old[1:]])
    return fold.mirror(base, decode(log, ORDERS), ["o_orderkey"])


@query("""SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
arg_max(value, event_id) FILTER (event_type <> 'view') AS value FROM events
WHERE event_id >= (SELECT min(e.event_id) FROM events e WHERE e.user_id = events.user_id AND e.event_type <> 'view') GROUP BY user_id""")
def patch_unchanged(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    view = F.col("event_type") == "view"
    flags = F.when(view, F.array(F.lit(False), F.lit(False), F.lit(False), F.lit(True)))
    log = changelog(rows.withColumn("value", F.when(~view, F.col("value"))), EVENTS, F.when(view, "U").otherwise("I"), F.col("event_id"), unchanged=flags)
    return fold.patch(empty(spark, EVENTS), decode(log, EVENTS), ["user_id"])


@query("SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def patch_without_base(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    base = rows.where("c_custkey % 2 = 0").select(*CUSTOMER.names)
    flags = F.array(F.lit(False), F.lit(True), F.lit(False))
    sent = rows.withColumns({"c_name": F.lit(None).cast("string"), "c_acctbal": F.col("c_acctbal") + 1})
    return fold.patch(base, decode(changelog(sent, CUSTOMER, F.lit("U"), F.col("c_custkey"), unchanged=flags), CUSTOMER), ["c_custkey"])


@query("""SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n
FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE event_id % 400 = 299)) WHERE n = 1""")
def truncate_epoch(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    log = changelog(rows, EVENTS, F.when(F.col("event_id") % 400 == 299, "T").otherwise("I"), F.col("event_id"))
    base = rows.groupBy("user_id").agg(F.lit(-1).cast("long").alias("event_id"), F.lit("old").alias("event_type"), F.lit(0.0).alias("value"))
    return fold.mirror(base, decode(log, EVENTS), ["user_id"])


@query("SELECT epoch, count(*) AS n, min(event_id) AS first_event FROM (SELECT *, count(*) FILTER (event_id % 400 = 299) OVER (ORDER BY event_id) AS epoch FROM events) GROUP BY epoch")
def epoch_plan(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    log = changelog(rows, EVENTS, F.when(F.col("event_id") % 400 == 299, "T").otherwise("I"), F.col("event_id"))
    return epochs.epochs(log).groupBy("epoch").agg(F.count(F.lit(1)).alias("n"), F.min("lsn").alias("first_event"))


@query("""SELECT segment, any_value(kind) AS kind, count(*) AS n, min(event_id) AS first_event FROM (
SELECT *, sum(fresh) OVER (ORDER BY event_id)::BIGINT AS segment FROM (
SELECT *, CASE WHEN kind = 'T' OR lag(kind) OVER (ORDER BY event_id) IS DISTINCT FROM kind THEN 1 ELSE 0 END AS fresh FROM (
SELECT event_id, CASE event_type WHEN 'view' THEN 'PATCH' WHEN 'signup' THEN 'T' ELSE 'DATA' END AS kind FROM events))) GROUP BY segment""")
def segment_plan(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    flags = F.when(kind == "view", F.array(F.lit(False), F.lit(False), F.lit(False), F.lit(True)))
    log = changelog(rows, EVENTS, F.when(kind == "view", "U").when(kind == "signup", "T").otherwise("I"), F.col("event_id"), unchanged=flags)
    return epochs.segments(log).groupBy("segment").agg(F.any_value("kind").alias("kind"), F.count(F.lit(1)).alias("n"), F.min("lsn").alias("first_event"))


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders""")
def bootstrap_antijoin(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(*ORDERS.names)
    streamed = rows.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0))
    return fold.insert_missing(streamed, rows, ["o_orderkey"])


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal FROM customer")
def update_from(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    patches = rows.where("c_custkey % 5 = 0").select("c_custkey", (-F.col("c_acctbal")).alias("c_acctbal"))
    return fold.update_from(rows, patches, ["c_custkey"])


# snapshot tables


def new_lake(spark: SparkSession, **options) -> Lake:
    return Lake(spark, shared_folder(spark, "lake"), **options)


def loaded(lake: Lake, shape: Shape, rows: DataFrame) -> None:
    """A version with the table and its rows."""

    def edit(m):
        lake.put(lake.add_table(m, shape.table, list(shape.columns), list(shape.keys)), rows.select(*shape.names))

    lake.commit(edit)


def customer_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = new_lake(spark)
    loaded(lake, CUSTOMER, table(spark, sf_dir, "customer"))
    return lake


def evolved(spark: SparkSession, sf_dir: str, actions: list[Action], definition: Definition | None = None) -> DataFrame:
    lake = customer_lake(spark, sf_dir)
    lake.commit(lambda m: Evolver(lake, lambda _: definition).apply(m, actions) > 0)
    return lake.read("app.customer") if "app.customer" in lake.manifest()["tables"] else lake.read("app.client")


@query("SELECT c_custkey, c_name, c_acctbal, NULL::VARCHAR AS note FROM customer")
def schema_add(spark, sf_dir):
    return evolved(spark, sf_dir, [Action("define", "app.customer")], Definition([*CUSTOMER.columns, ("note", T.StringType())], ["c_custkey"]))


@query("SELECT c_custkey, c_name AS full_name, c_acctbal FROM customer")
def schema_rename(spark, sf_dir):
    return evolved(spark, sf_dir, [a for a in classify("ALTER TABLE customer RENAME COLUMN c_name TO full_name", "app") if a.kind == "rename_column"])


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def schema_rename_table(spark, sf_dir):
    return evolved(spark, sf_dir, classify("RENAME TABLE app.customer TO app.client", "app"))


@query("SELECT c_custkey, c_acctbal FROM customer")
def schema_drop(spark, sf_dir):
    return evolved(spark, sf_dir, [Action("drop_column", "app.customer", "c_name")])


@query("SELECT c_acctbal, c_name, c_custkey FROM customer")
def schema_reorder(spark, sf_dir):
    return evolved(spark, sf_dir, [Action("define", "app.customer")], Definition(list(reversed(CUSTOMER.columns)), ["c_custkey"]))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def schema_widen(spark, sf_dir):
    shape = Shape("app.nation", (("n_nationkey", T.IntegerType()), ("n_name", T.StringType())), ("n_nationkey",))
    lake = new_lake(spark)
    loaded(lake, shape, table(spark, sf_dir, "nation"))
    before = {f["path"] for f in lake.manifest()["tables"]["app.nation"]["files"]}
    wider = Definition([("n_nationkey", T.LongType()), ("n_name", T.StringType())], ["n_nationkey"])
    new = lake.commit(lambda m: Evolver(lake, lambda _: wider).apply(m, [Action("define", "app.nation")]) > 0)
    assert before == {f["path"] for f in new["tables"]["app.nation"]["files"]}, "widening rewrites nothing"
    return lake.read("app.nation")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_acctbal FROM customer")
def schema_retype_rewrite(spark, sf_dir):
    return evolved(spark, sf_dir, [Action("define", "app.customer")], Definition([("c_custkey", T.StringType()), *CUSTOMER.columns[1:]], ["c_custkey"]))


@query("SELECT 'app.customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'app.supplier', count(*) FROM supplier UNION ALL SELECT 'versions', 1")
def multi_table_commit(spark, sf_dir):
    lake = new_lake(spark)

    def edit(m):
        for shape, name in ((CUSTOMER, "customer"), (SUPPLIER, "supplier")):
            lake.put(lake.add_table(m, shape.table, list(shape.columns), list(shape.keys)), table(spark, sf_dir, name).select(*shape.names))

    lake.commit(edit)
    n = [lake.read(t).select(F.lit(t).alias("t"), F.lit(1).alias("one")).groupBy("t").agg(F.count("one").alias("n")) for t in ("app.customer", "app.supplier")]
    return n[0].union(n[1]).union(lake.snapshots().select(F.lit("versions").alias("t"), F.count(F.lit(1)).alias("n")))


def moved_balances(spark: SparkSession, sf_dir: str) -> Lake:
    """Version 1: all customers; version 2: every seventh deleted, every fifth with a new balance."""
    lake = customer_lake(spark, sf_dir)
    rows = table(spark, sf_dir, "customer").where("c_custkey % 5 = 0 or c_custkey % 7 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 10)
    log = changelog(rows, CUSTOMER, F.when(F.col("c_custkey") % 7 == 0, "D").otherwise("U"), F.col("c_custkey"))
    lake.commit(lambda m: lake.apply_changes(m, CUSTOMER.table, decode(log, CUSTOMER)))
    return lake


@query("""SELECT 1::BIGINT AS version, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer UNION ALL
SELECT 2, count(*), round(sum(CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 10 ELSE c_acctbal END), 2) FROM customer WHERE c_custkey % 7 <> 0""")
def time_travel(spark, sf_dir):
    lake = moved_balances(spark, sf_dir)
    one = lambda v: lake.read("app.customer", version=v).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")).select(F.lit(v).cast("long").alias("version"), "n", "total")
    return one(1).union(one(2))


@query("""SELECT 'delete' AS change, c_custkey, c_acctbal FROM customer WHERE c_custkey % 7 = 0 UNION ALL
SELECT 'update_before', c_custkey, c_acctbal FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 7 <> 0 UNION ALL
SELECT 'update_after', c_custkey, c_acctbal + 10 FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 7 <> 0""")
def change_feed(spark, sf_dir):
    return moved_balances(spark, sf_dir).changes("app.customer", 1, 2).select("change", "c_custkey", "c_acctbal")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def compaction_rows(spark, sf_dir):
    lake = new_lake(spark)
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    for i in range(6):
        lake.commit(lambda m, i=i: lake.put(lake.add_table(m, CUSTOMER.table, list(CUSTOMER.columns), ["c_custkey"]), rows.where(F.col("c_custkey") % 6 == i), 1))
    parts = {f["path"] for f in lake.manifest()["tables"][CUSTOMER.table]["files"]}
    Maintenance(lake).tiers()
    assert not parts & {f["path"] for f in lake.manifest()["tables"][CUSTOMER.table]["files"]}, "all parts are merged, whatever their size"
    return lake.read("app.customer")


@query("SELECT 'app.customer' AS \"table\", 5 AS files")
def small_file_count(spark, sf_dir):
    """Five small files of one table."""
    lake = new_lake(spark)
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    for i in range(5):
        lake.commit(lambda m, i=i: lake.put(lake.add_table(m, CUSTOMER.table, list(CUSTOMER.columns), ["c_custkey"]), rows.where((F.col("c_custkey") % 5 == i) & (F.col("c_custkey") < 2000)), 1))
    return Maintenance(lake).small_files()


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 2 = 0")
def inline_rows(spark, sf_dir):
    shape = Shape("app.nation", (("n_nationkey", T.IntegerType()), ("n_name", T.StringType())), ("n_nationkey",))
    lake = new_lake(spark, inline_rows=512)
    loaded(lake, shape, table(spark, sf_dir, "nation"))
    log = changelog(table(spark, sf_dir, "nation").where("n_nationkey % 2 = 1"), shape, F.lit("D"), F.col("n_nationkey"))
    lake.commit(lambda m: lake.apply_changes(m, shape.table, decode(log, shape)))
    assert not lake.manifest()["tables"]["app.nation"]["files"], "few rows stay in the manifest"
    Maintenance(lake).flush()
    return lake.read("app.nation")


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def bootstrap_resumable(spark, sf_dir):
    lake = new_lake(spark)
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    loaded(lake, CUSTOMER, rows.where("c_custkey % 4 = 0").withColumn("c_acctbal", F.lit(0.0)))
    define = lambda t: Definition(list(CUSTOMER.columns), ["c_custkey"]) if t == CUSTOMER.table else None
    boot = Bootstrap(lake, lambda: ["app.customer", "app.nokey"], define, lambda t, d: rows)
    boot.run()
    assert boot.run() == {"app.customer": "done", "app.nokey": "no-pk-skip"}
    return lake.read("app.customer")


@query(LATEST_SQL)
def mirror_batches_lake(spark, sf_dir):
    """Four micro-batches into snapshot tables, the third one delivered twice."""
    lake = new_lake(spark)
    mirror = Mirror(lake, "events", lambda _: EVENTS)
    log = event_log(spark, sf_dir)
    for low, high in ((0, 3000), (3000, 6000), (6000, 8000), (6000, 8000), (8000, 10**12)):
        mirror.apply(log.where((F.col("lsn") >= low) & (F.col("lsn") < high)))
    return lake.read(EVENTS.table).select(*EVENTS.names)


@query("SELECT 1::BIGINT AS version, max(epoch_us(ts) // 1000) AS source_commit_ms, count(*) AS events, 1::BIGINT AS batches, 0::BIGINT AS failures, 0::BIGINT AS ddl_applied FROM events")
def watermark_report(spark, sf_dir):
    lake = new_lake(spark)
    mirror = Mirror(lake, "events", lambda _: EVENTS)
    mirror.apply(event_log(spark, sf_dir))
    return watermark(lake, mirror.state).select("version", "source_commit_ms", "events", "batches", "failures", "ddl_applied")


@query("""SELECT md5(o_orderkey::VARCHAR) AS id, CASE WHEN o_orderkey % 50 = 0 THEN -1.0 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 70 <> 0""")
def mirror_binary_key(spark, sf_dir):
    """Keys of sixteen bytes: updates and deletes find the files that hold them."""
    shape = Shape("app.b", (("id", T.BinaryType()), ("price", T.DoubleType())), ("id",))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.md5(F.col("o_orderkey").cast("string").cast("binary"))).alias("id"), F.col("o_totalprice").alias("price"))
    lake = new_lake(spark)
    lake.commit(lambda m: lake.put(lake.add_table(m, shape.table, list(shape.columns), ["id"]), rows.select("id", "price"), 12))
    sent = rows.where("o_orderkey % 50 = 0 or o_orderkey % 70 = 0").withColumns({"id": F.concat(F.lit("\\x"), F.hex("id")), "price": F.lit(-1.0)})
    log = changelog(sent, shape, F.when(F.col("o_orderkey") % 70 == 0, "D").otherwise("U"), F.col("o_orderkey"))
    lake.commit(lambda m: lake.apply_changes(m, shape.table, decode(log, shape)))
    return lake.read(shape.table).select(F.lower(F.hex("id")).alias("id"), "price")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY event_type")
def mirror_conflict_once(spark, sf_dir):
    """Two drivers deliver one batch to a table without a key; the second publishes while the first is at work."""
    shape = Shape(EVENTS.table, EVENTS.columns)
    root, log = shared_folder(spark, "lake"), event_log(spark, sf_dir)
    one, two = (Mirror(Lake(spark, root, pause=0.01), "events", lambda _: shape) for _ in range(2))
    edit = one.edit

    def late(*given):
        found = edit(*given)
        two.apply(log)
        return found

    one.edit = late
    one.apply(log)
    return one.lake.read(shape.table).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'new' ELSE n_name END AS n_name FROM nation")
def schema_drop_key(spark, sf_dir):
    """One column of a key goes; the next batch is folded by the other."""
    shape = Shape("app.nation", (("n_regionkey", T.IntegerType()), ("n_nationkey", T.IntegerType()), ("n_name", T.StringType())), ("n_regionkey", "n_nationkey"))
    lake, rows = new_lake(spark), table(spark, sf_dir, "nation")
    loaded(lake, shape, rows)
    lake.commit(lambda m: Evolver(lake).apply(m, classify("ALTER TABLE nation DROP COLUMN n_regionkey", "app") or [Action("drop_column", shape.table, "n_regionkey")]) > 0)
    if "n_regionkey" in lake.read(shape.table).columns:
        lake.commit(lambda m: Evolver(lake).apply(m, [Action("drop_column", shape.table, "n_regionkey")]) > 0)
    after = Shape(shape.table, shape.columns[1:], ("n_nationkey",))
    log = changelog(rows.where("n_nationkey % 4 = 0").withColumn("n_name", F.lit("new")), after, F.lit("U"), F.col("n_nationkey"))
    lake.commit(lambda m: lake.apply_changes(m, shape.table, decode(log, after)))
    return lake.read(shape.table)


@query("SELECT max(event_id) + 7 AS lsn, 2::BIGINT AS versions, 1::BIGINT AS batches, 1::BIGINT AS filtered FROM events")
def offset_only_commit(spark, sf_dir):
    """A batch without captured rows moves the lake's offset and rewrites nothing."""
    lake = new_lake(spark)
    mirror, log = Mirror(lake, "events", lambda _: EVENTS), event_log(spark, sf_dir)
    mirror.apply(log)
    files = lake.manifest()["tables"][EVENTS.table]["files"]
    mark = log.orderBy(F.desc("lsn")).limit(1).withColumns({"lsn": F.col("lsn") + 7, "op": F.lit("KEEP"), "table": F.lit(None).cast("string")})
    mirror.apply(mark)
    assert files == lake.manifest()["tables"][EVENTS.table]["files"]
    return spark.createDataFrame([(mirror.offset(), len(lake.versions()), mirror.state.counts["batches"], mirror.state.counts["filtered"])], "lsn long, versions long, batches long, filtered long")


@query("SELECT 'app.customer' AS t, count(*) AS n FROM customer WHERE c_custkey % 3 <> 0")
def schema_drop_tables(spark, sf_dir):
    """A schema is dropped, and one table of another; what stays is listed with its rows."""
    lake = new_lake(spark)
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    for name in ("app.customer", "app.gone", "shop.a", "shop.b"):
        loaded(lake, Shape(name, CUSTOMER.columns, CUSTOMER.keys), rows.where("c_custkey % 3 <> 0"))
    lake.commit(lambda m: Evolver(lake).apply(m, [*classify("DROP DATABASE shop", "app"), *classify("DROP TABLE IF EXISTS gone", "app")]) > 0)
    parts = [lake.read(t).select(F.lit(t).alias("t")) for t in sorted(lake.manifest()["tables"])]
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    return found.groupBy("t").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'table' AS what, 'buyers' AS note, count(*) AS n FROM customer UNION ALL SELECT 'c_name', 'as printed', count(*) FROM customer")
def schema_comments(spark, sf_dir):
    lake = customer_lake(spark, sf_dir)
    lake.commit(lambda m: Evolver(lake).apply(m, [Action("comment_table", "app.customer", new="buyers"), Action("comment_column", "app.customer", "c_name", "as printed")]) > 0)
    rows = lake.read("app.customer")
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    notes = [("table", lake.manifest()["tables"]["app.customer"]["comment"]), *[(f.name, f.metadata["comment"]) for f in rows.schema if f.metadata.get("comment")]]
    return n.crossJoin(spark.createDataFrame(notes, "what string, note string")).select("what", "note", "n")  # one row each


@query("SELECT 'files merged' AS what, 6::BIGINT AS n UNION ALL SELECT 'versions expired', 7 UNION ALL SELECT 'files deleted', 6 UNION ALL SELECT 'rows', count(*) FROM customer")
def upkeep_counts(spark, sf_dir):
    """Merge, expire and clean up: only what no kept version names goes."""
    now = [1000.0]
    lake = new_lake(spark, clock=lambda: now[0])
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    for i in range(6):
        lake.commit(lambda m, i=i: lake.put(lake.add_table(m, CUSTOMER.table, list(CUSTOMER.columns), ["c_custkey"]), rows.where(F.col("c_custkey") % 6 == i), 1))
    work = Maintenance(lake)
    merged = work.compact(0, None, 2, None)
    lake.commit(lambda m: m["control"].update(seen=True))
    now[0] = 4e9
    found = [("files merged", merged), ("versions expired", len(work.expire(30))), ("files deleted", work.cleanup(0)), ("rows", lake.read("app.customer").count())]
    return spark.createDataFrame(found, "what string, n long")


@query("""SELECT event_id, event_id % 2 = 1 AS flag, CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts::DATE END AS d, upper(to_hex((event_id % 200 + 16)::INTEGER)) AS raw FROM events""")
def cast_mysql(spark, sf_dir):
    """MySQL's rules: booleans and dates that don't fit become null, bytes come as hexadecimal digits."""
    rows = table(spark, sf_dir, "events")
    text = lambda name, value: casts.cast_text(value, mysql_type(name), "mysql")
    day = F.when(F.col("event_id") % 5 == 0, "0000-00-00").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    flag = F.when(F.col("event_id") % 2 == 1, "true").otherwise("false")
    return rows.select("event_id", text("tinyint(1)", flag).alias("flag"), text("date", day).alias("d"), F.hex(text("varbinary(9)", F.hex(F.col("event_id") % 200 + 16))).alias("raw"))


@query("SELECT n_nationkey, (n_nationkey % 2 = 1)::VARCHAR AS one, lpad(upper(to_hex(n_nationkey)), 4, '0') AS ten FROM nation")
def bit_decode(spark, sf_dir):
    bits = F.col("n_nationkey").cast("long")
    return table(spark, sf_dir, "nation").select("n_nationkey", casts.bit_text(bits, 1).alias("one"), casts.bit_text(bits, 10).alias("ten"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') || 'Z' AS at FROM events")
def commit_time_text(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", casts.iso_time(F.unix_millis(F.col("ts").cast("timestamp"))).alias("at"))


@query("""SELECT 'pg' AS source, event_type AS stage, count(*) AS batches, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY event_type""")
def stage_percentiles(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.lit("pg").alias("source"), F.col("event_type").alias("stage"), F.col("value").alias("ms"))
    return percentiles(rows)


@query("SELECT max(epoch_us(ts) // 1000) AS source_commit_ms, count(*) AS events, 0::BIGINT AS lag_ms FROM events")
def commit_clock(spark, sf_dir):
    """The newest commit time of a source, and a delay that is never negative."""
    rows = table(spark, sf_dir, "events").agg(F.max(F.unix_millis(F.col("ts").cast("timestamp"))).alias("source_commit_ms"), F.count(F.lit(1)).alias("events"))
    return rows.withColumn("lag_ms", casts.lag_ms(F.col("source_commit_ms") - 5, F.col("source_commit_ms")))


# functions


@query("SELECT l_orderkey, l_linenumber, l_extendedprice::DECIMAL(12,2) AS price FROM lineitem")
def cast_decimal(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    text = F.format_string("%.2f", "l_extendedprice")
    return rows.select("l_orderkey", "l_linenumber", casts.cast_text(text, pg_type("numeric(12,2)")).alias("price"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts::DATE END AS d FROM events")
def try_cast_temporal(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, "0000-13-45").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select("event_id", casts.cast_text(text, pg_type("date")).alias("d"))


@query("SELECT n_nationkey, n_name AS name, octet_length(encode(n_name))::INTEGER AS n FROM nation")
def bytea_decode(spark, sf_dir):
    raw = casts.cast_text(F.concat(F.lit("\\x"), F.lower(F.hex("n_name"))), pg_type("bytea"))
    return table(spark, sf_dir, "nation").select("n_nationkey", casts.bytes_text(raw, T.StringType()).alias("name"), F.octet_length(raw).alias("n"))


@query("""SELECT o_orderkey, o_custkey AS first, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 7 END AS second, 3 AS n FROM orders""")
def pg_array_parse(spark, sf_dir):
    text = F.format_string('{%d,%s," 9 "}', "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, "NULL").otherwise("7"))
    values = casts.cast_text(text, pg_type("bigint[]"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.get(values, F.lit(0)).alias("first"), F.get(values, F.lit(1)).cast("int").alias("second"), F.size(values).alias("n"))


@query("SELECT event_id, (event_id % 12)::INTEGER + 24 AS months, (event_id % 28)::INTEGER AS days, (event_id % 60) * 1000000 AS micros FROM events")
def interval_parse(spark, sf_dir):
    text = F.format_string("2 years %d mons %d days 00:00:%02d", F.col("event_id") % 12, F.col("event_id") % 28, F.col("event_id") % 60)
    found = casts.cast_text(text, pg_type("interval"))
    return table(spark, sf_dir, "events").select("event_id", found["months"].alias("months"), found["days"].alias("days"), found["micros"].alias("micros"))


@query("SELECT event_id, (props::JSON ->> 'k')::INTEGER AS k FROM events")
def json_extract(spark, sf_dir):
    value = casts.cast_text(F.col("props"), pg_type("jsonb"))
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(value, "$.k", "int").alias("k"))


@query("SELECT n_nationkey, CASE n_regionkey WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' ELSE n_regionkey::VARCHAR END AS tier FROM nation")
def enum_decode(spark, sf_dir):
    labels = F.array(F.lit("gold"), F.lit("silver"))
    return table(spark, sf_dir, "nation").select("n_nationkey", casts.enum_label(labels, F.col("n_regionkey")).alias("tier"))


@query("""SELECT n_nationkey, concat_ws(',', CASE WHEN n_nationkey & 1 > 0 THEN 'red' END, CASE WHEN n_nationkey & 2 > 0 THEN 'blue' END,
CASE WHEN n_nationkey & 4 > 0 THEN 'green' END) AS labels FROM nation""")
def set_decode(spark, sf_dir):
    labels = F.array(F.lit("red"), F.lit("blue"), F.lit("green"))
    return table(spark, sf_dir, "nation").select("n_nationkey", casts.set_labels(labels, F.col("n_nationkey").cast("long")).alias("labels"))


@query("""SELECT n_nationkey, (256 - n_nationkey - 1)::BIGINT AS tiny, 4294967296 - n_nationkey - 1 AS wide, (18446744073709551616::HUGEINT - n_nationkey - 1)::DECIMAL(20,0) AS huge FROM nation""")
def unsigned_restore(spark, sf_dir):
    value = -F.col("n_nationkey").cast("long") - 1
    return table(spark, sf_dir, "nation").select("n_nationkey", casts.unsigned(value, 8).alias("tiny"), casts.unsigned(value, 32).alias("wide"), casts.unsigned(value, 64).alias("huge"))


@query("SELECT n_nationkey, strftime(make_timestamp(n_nationkey * 86400000001), '%Y-%m-%d %H:%M:%S.%f') AS at, strftime(make_timestamp(n_nationkey * 86400000001), '%Y-%m-%d') AS day FROM nation")
def temporal_decode(spark, sf_dir):
    micros = F.col("n_nationkey").cast("long") * 86_400_000_001
    return table(spark, sf_dir, "nation").select("n_nationkey", casts.temporal_text(micros, "datetime").alias("at"), casts.temporal_text(micros, "date").alias("day"))


@query("SELECT n_nationkey, 946684800000 + floor((n_nationkey - 12) * 1500.0 / 1000)::BIGINT AS ms FROM nation")
def pg_epoch(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", casts.pg_epoch_ms((F.col("n_nationkey").cast("long") - 12) * 1500).alias("ms"))


@query("SELECT r_name || '.' || n_name AS t FROM nation JOIN region ON n_regionkey = r_regionkey WHERE regexp_full_match(r_name, 'A.*') AND NOT regexp_full_match(r_name || '.' || n_name, '.*A')")
def capture_filter_regex(spark, sf_dir):
    captured = capture_filter("A.*", ".*A")
    names = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    names = names.select(F.concat_ws(".", "r_name", "n_name").alias("t"))
    kept = [r["t"] for r in names.collect() if captured(r["t"])]  # names of tables: a list that the driver holds anyway
    return names.where(F.col("t").isin(kept))


@query("""WITH a AS (SELECT o_orderkey % 500 AS xid, CASE WHEN o_orderkey % 3 = 0 THEN 'sql_drop' ELSE 'ddl_command_end' END AS ev, o_orderkey::VARCHAR AS id FROM orders)
SELECT e.xid, e.id AS object_identity, coalesce(d.n, 0) AS n_drops FROM a e LEFT JOIN (SELECT xid, count(*) AS n FROM a WHERE ev = 'sql_drop' GROUP BY xid) d ON d.xid = e.xid WHERE e.ev = 'ddl_command_end'""")
def ddl_xid_pairing(spark, sf_dir):
    audit = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 500).alias("xid"), F.when(F.col("o_orderkey") % 3 == 0, "sql_drop").otherwise("ddl_command_end").alias("ev"), F.col("o_orderkey").cast("string").alias("object_identity")
    )
    return epochs.paired_ddl(audit).select("xid", "object_identity", F.size("drops").cast("long").alias("n_drops"))


@query("""SELECT * FROM (VALUES (1, 'rename_column', 'app.t', 'a', 'b'), (1, 'define', 'app.t', NULL, NULL), (2, 'drop_table', 'app.x', NULL, NULL), (2, 'drop_table', 'o.y', NULL, NULL),
(3, 'truncate', 'app.t', NULL, NULL), (4, 'rename_table', 'app.a', NULL, 'b'), (4, 'define', 'app.b', NULL, NULL), (5, 'rebuild', 'app.t', NULL, NULL), (6, 'drop_schema', 'shop', NULL, NULL)) v(id, kind, tab, old_name, new_name)""")
def ddl_classify(spark, sf_dir):
    statements = [
        "ALTER TABLE `t` CHANGE COLUMN a b INT NOT NULL", "DROP TABLE IF EXISTS x, `o`.`y` /* generated by server */", "TRUNCATE TABLE t", "RENAME TABLE a TO b",
        "ALTER TABLE t ADD COLUMN id BIGINT PRIMARY KEY", "DROP DATABASE shop", "DROP TEMPORARY TABLE t", "INSERT INTO t VALUES (1)",
    ]
    rows = [(i + 1, a.kind, a.table, a.name, a.new) for i, s in enumerate(statements) for a in classify(s, "app")]
    return spark.createDataFrame(rows, "id int, kind string, tab string, old_name string, new_name string")


@query("SELECT * FROM (VALUES ('bigint unsigned', 'decimal(20,0)'), ('tinyint(1)', 'boolean'), ('decimal(12,2)', 'decimal(12,2)'), ('bit(8)', 'binary'), ('enum(''a'')', 'string')) v(declared, kind)")
def type_map(spark, sf_dir):
    names = ["bigint unsigned", "tinyint(1)", "decimal(12,2)", "bit(8)", "enum('a')"]
    return spark.createDataFrame([(n, mysql_type(n).simpleString()) for n in names], "declared string, kind string")


@query("SELECT 1::BIGINT AS version, 1 AS tables, 3 AS files UNION ALL SELECT 2, 1, 6")
def snapshot_list(spark, sf_dir):
    lake = new_lake(spark)
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    for half in (0, 1):
        lake.commit(lambda m, half=half: lake.put(lake.add_table(m, CUSTOMER.table, list(CUSTOMER.columns), ["c_custkey"]), rows.where(F.col("c_custkey") % 2 == half), 3))
    return lake.snapshots().select("version", "tables", "files")
