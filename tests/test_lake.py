import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.operators.bootstrap import Bootstrap, capture_filter
from tidefold.operators.ddl import Definition, Evolver, NeedsReload, Policy
from tidefold.operators.envelope import ENVELOPE, Shape, decode
from tidefold.operators.lake import Conflict, Lake
from tidefold.operators.maintain import Maintenance
from tidefold.operators.progress import SyncState, percentiles, watermark
from tidefold.plans.ddl_text import Action, classify, from_audit

COLUMNS = [("k", T.LongType()), ("a", T.StringType()), ("b", T.IntegerType())]
SHAPE = Shape("s.t", tuple(COLUMNS), ("k",))


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(20).select(F.col("id").alias("k"), F.concat(F.lit("a"), "id").alias("a"), F.col("id").cast("int").alias("b"))
    lake.commit(lambda m: lake.put(lake.add_table(m, "s.t", COLUMNS, ["k"]), rows))
    return lake


def log(spark, *rows):
    return decode(spark.createDataFrame([("s", i, 0, 1, None, "s.t", op, b, a, u, 0) for i, (op, b, a, u) in enumerate(rows)], ENVELOPE), SHAPE)


def state(lake, **at):
    return {r["k"]: (r["a"], r["b"]) for r in lake.read("s.t", **at).collect()}


def test_changes_rewrite_touched_files_only(spark, lake):
    more = spark.range(100, 120).select(F.col("id").alias("k"), F.lit("m").alias("a"), F.lit(1).alias("b"))
    lake.commit(lambda m: lake.put(m["tables"]["s.t"], more, 1))
    before = {f["path"] for f in lake.manifest()["tables"]["s.t"]["files"]}
    changes = log(spark, ("U", None, ["3", "new", "7"], None), ("D", ["4", None, None], None, None), ("U", ["5", None, None], ["50", "moved", "1"], None), ("U", None, ["6", None, "66"], [False, True, False]))
    lake.commit(lambda m: lake.apply_changes(m, "s.t", changes))
    after = {f["path"] for f in lake.manifest()["tables"]["s.t"]["files"]}
    assert len(before & after) >= 1, "the file of keys 100 to 119 stays"
    now = state(lake)
    assert (now[3], now[50], now[6]) == (("new", 7), ("moved", 1), ("a6", 66)) and 4 not in now and 5 not in now
    assert state(lake, version=1)[4] == ("a4", 4)
    feed = {(r["change"], r["k"]) for r in lake.changes("s.t", 2, 3).collect()}
    assert feed == {("update_before", 3), ("update_after", 3), ("update_before", 6), ("update_after", 6), ("delete", 4), ("delete", 5), ("insert", 50)}


@pytest.mark.parametrize("n_files", [1, 30])
def test_binary_keys_and_key_order(spark, tmp_path, n_files):
    """Keys that aren't text, and a key whose first column isn't the table's first."""
    lake = Lake(spark, str(tmp_path / "bin"))
    columns = [("a", T.IntegerType()), ("id", T.BinaryType()), ("v", T.StringType())]
    shape = Shape("s.b", tuple(columns), ("id", "a"))
    rows = spark.range(60).select((60 - F.col("id")).cast("int").alias("a"), F.unhex(F.sha1(F.col("id").cast("string"))).alias("id"), F.lit("old").alias("v"))
    lake.commit(lambda m: lake.put(lake.add_table(m, "s.b", columns, ["id", "a"]), rows, n_files))
    picked = rows.where("a % 20 = 0").select(F.hex("id").alias("h"), "a").collect()
    events = [("s", i, 0, 1, None, "s.b", "U", None, [str(r["a"]), "\\x" + r["h"], "new"], None, 0) for i, r in enumerate(picked)]
    lake.commit(lambda m: lake.apply_changes(m, "s.b", decode(spark.createDataFrame(events, ENVELOPE), shape)))
    got = lake.read("s.b")
    assert got.count() == 60 and got.select("id").distinct().count() == 60 and got.where("v = 'new'").count() == 3


def test_ten_thousand_files(spark, lake):
    """Entries of files that are never read: a change of one key names few files, and a version rewrites few lists."""

    def many(m):
        t = m["tables"]["s.t"]
        lead, own = next(c["id"] for c in t["columns"] if c["name"] == "k"), t["files"]
        made = [{"path": f"data/x/y/{i}.parquet", "rows": 10, "bytes": 1000, "lead": lead, "lo": str(1000 + 10 * i), "hi": str(1009 + 10 * i), "shape": own[0]["shape"]} for i in range(10_000)]
        t["files"] = own + made

    new = lake.commit(many)
    before = {item["name"] for item in lake.manifest()["tables"]["s.t"]["lists"]}
    t = lake.manifest()["tables"]["s.t"]
    keys = spark.createDataFrame([(5,), (1005,), (90_000,), (10**9,)], "k long")
    assert {f["path"] for f in lake.near_files(t, keys)} - {f["path"] for f in t["files"] if not f["path"].startswith("data/x/")} == {"data/x/y/0.parquet", "data/x/y/8900.parquet"}
    lake.commit(lambda m: lake.apply_changes(m, "s.t", log(spark, ("U", None, ["5", "z", "1"], None))))
    after = {item["name"] for item in lake.manifest()["tables"]["s.t"]["lists"]}
    assert len(before) >= 3 and len(before & after) >= 2 and len(lake.manifest()["tables"]["s.t"]["files"]) == len(new["tables"]["s.t"]["files"])
    assert len(json.dumps(json.loads(lake.store.read(f"_manifests/{lake.manifest()['version']}.json")))) < 5000, "the manifest names lists, not files"


def test_dropped_key_column(spark, lake):
    lake.commit(lambda m: lake.add_table(m, "s.two", COLUMNS, ["k", "b"]) and None)
    lake.commit(lambda m: lake.put(m["tables"]["s.two"], spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "k long, a string, b int")))
    lake.commit(lambda m: Evolver(lake).apply(m, [Action("drop_column", "s.two", "b")]) > 0)
    shape = Shape("s.two", tuple(COLUMNS[:2]), ("k",))
    rows = spark.createDataFrame([("s", 1, 0, 1, None, "s.two", "U", None, ["1", "z"], None, 0)], ENVELOPE)
    lake.commit(lambda m: lake.apply_changes(m, "s.two", decode(rows, shape)))
    assert sorted(map(tuple, lake.read("s.two").collect())) == [(1, "z"), (2, "y")] and lake.manifest()["tables"]["s.two"]["keys"] == ["k"]
    lake.commit(lambda m: Evolver(lake).apply(m, [Action("drop_column", "s.two", "k")]) > 0)
    assert lake.manifest()["tables"]["s.two"]["keys"] == [] and lake.read("s.two").count() == 2


def test_truncate_then_insert_and_time_travel(spark, lake):
    lake.clock = lambda: 10**12
    lake.commit(lambda m: lake.apply_changes(m, "s.t", log(spark, ("I", None, ["1", "x", None], None), ("T", None, None, None), ("I", None, ["2", "y", None], None))))
    assert state(lake) == {2: ("y", None)}
    assert len(state(lake, timestamp=10**11)) == 20


def test_conflict_makes_the_edit_anew(spark, tmp_path):
    one, two = Lake(spark, str(tmp_path / "x"), pause=0.01), Lake(spark, str(tmp_path / "x"), pause=0.01)
    tries = []

    def edit(m):
        if not tries:
            two.commit(lambda n: n["offsets"].update(b=1))
        tries.append(m["version"])
        m["offsets"]["a"] = 1

    assert one.commit(edit)["offsets"] == {"a": 1, "b": 1}
    assert tries == [0, 1]


def test_gives_up_after_retries(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "y"), retries=2, pause=0.001)
    monkeypatch.setattr(lake.store, "create", lambda *a: False)
    with pytest.raises(Conflict):
        lake.commit(lambda m: None)


def test_crash_between_files_and_manifest(spark, lake):
    def edit(m):
        lake.put(m["tables"]["s.t"], lake.read("s.t"))
        raise RuntimeError("lost power")

    with pytest.raises(RuntimeError):
        lake.commit(edit)
    assert len(state(lake)) == 20
    work = Maintenance(lake)
    assert len(work.orphans()) >= 1
    assert work.cleanup(grace_hours=2) == 0
    assert work.cleanup(grace_hours=0) >= 1
    assert len(state(lake)) == 20


def test_stale_lock_is_removed(spark, lake):
    nxt = f"_manifests/{lake.manifest()['version'] + 1}.json"
    lake.store.fs.createNewFile(lake.store.path(lake.store.at(f"{nxt}.lock")))
    assert not lake.store.create(nxt, "{}")
    assert not lake.store.create(nxt, "{}", stale=-1)
    assert lake.store.create(nxt, json.dumps(lake.manifest()))


def test_schema_changes_without_rewrites(spark, lake):
    files = {f["path"] for f in lake.manifest()["tables"]["s.t"]["files"]}
    wanted = Definition([("b", T.LongType()), ("k", T.LongType()), ("n", T.StringType())], ["k"], "a table", {"n": "new"})
    evolver = Evolver(lake, lambda _: wanted)
    actions = [Action("rename_column", "s.t", "a", "n"), Action("define", "s.t")]
    lake.commit(lambda m: evolver.apply(m, actions) > 0)
    now = lake.read("s.t")
    assert now.columns == ["b", "k", "n"] and now.schema["b"].dataType == T.LongType() and now.schema["n"].metadata == {"comment": "new"}
    assert {r["n"] for r in now.collect()} == {f"a{i}" for i in range(20)}
    assert {f["path"] for f in lake.manifest()["tables"]["s.t"]["files"]} == files
    assert lake.commit(lambda m: evolver.apply(m, actions) > 0)["version"] == 2, "a replay changes nothing"


def test_drop_and_add_again_leaks_nothing(spark, lake):
    evolver = Evolver(lake)
    lake.commit(lambda m: evolver.apply(m, [Action("drop_column", "s.t", "a")]) > 0)
    lake.commit(lambda m: evolver.ensure(m, "s.t", [("a", T.StringType())], ["k"]))
    assert lake.read("s.t").where("a is not null").count() == 0


def test_retype_rewrites_and_narrowing_rounds(spark, lake):
    evolver = Evolver(lake)
    lake.commit(lambda m: evolver.ensure(m, "s.t", [("b", T.StringType())], ["k"]))
    assert lake.read("s.t").where("b = '7'").count() == 1
    lake.commit(lambda m: evolver.ensure(m, "s.t", [("b", T.IntegerType())], ["k"]))
    assert lake.read("s.t").agg(F.sum("b")).first()[0] == 190


def test_policy_switches(spark, lake):
    off = Evolver(lake, policy=Policy(drop_column=False, truncate=False, drop_table=False, type_change=False))
    acts = [Action("drop_column", "s.t", "a"), Action("truncate", "s.t"), Action("drop_table", "s.t"), Action("drop_schema", "s")]
    assert lake.commit(lambda m: off.apply(m, acts) > 0)["version"] == 1
    lake.commit(lambda m: off.ensure(m, "s.t", [("b", T.LongType())], ["k"]))
    assert off.warned == {"s.t"} and lake.read("s.t").schema["b"].dataType == T.IntegerType()


def test_rebuild_needs_a_reader(spark, lake):
    wanted = Definition(COLUMNS, ["k", "a"])
    with pytest.raises(NeedsReload):
        lake.commit(lambda m: Evolver(lake, lambda _: wanted).apply(m, [Action("rebuild", "s.t")]) > 0)
    load = lambda t, d: spark.createDataFrame([(1, "z", 1)], "k long, a string, b int")
    lake.commit(lambda m: Evolver(lake, lambda _: wanted, load).apply(m, [Action("rebuild", "s.t")]) > 0)
    assert state(lake) == {1: ("z", 1)} and lake.manifest()["tables"]["s.t"]["keys"] == ["k", "a"]


def test_mysql_statements():
    kinds = lambda sql: [(a.kind, a.table, a.name, a.new) for a in classify(sql, "d")]
    assert kinds("alter table t rename column a to b, rename to u") == [("rename_column", "d.t", "a", "b"), ("rename_table", "d.t", None, "u"), ("define", "d.u", None, None)]
    assert kinds("ALTER TABLE t RENAME INDEX a TO b") == [("define", "d.t", None, None)]
    assert kinds("ALTER TABLE t CHANGE a a BIGINT, ADD c INT COMMENT 'rename column x to y'") == [("define", "d.t", None, None)]
    assert kinds("ALTER TABLE t DROP PRIMARY KEY") == [("rebuild", "d.t", None, None)]
    assert kinds("RENAME TABLE a TO b, x.c TO y.c") == [("rename_table", "d.a", None, "b"), ("define", "d.b", None, None)]
    assert kinds("CREATE TABLE IF NOT EXISTS `o`.`t` (id int)") == [("define", "o.t", None, None)]
    assert kinds("DROP SCHEMA IF EXISTS shop") == [("drop_schema", "shop", None, None)]
    assert kinds("DROP TEMPORARY TABLE t") == kinds("ANALYZE TABLE t") == kinds("") == []


def audit(ev, tag, kind, identity, sql, xid=1):
    return {"ev": ev, "tag": tag, "object_type": kind, "object_identity": identity, "query_text": sql, "xid": xid}


def test_audit_rows():
    end = lambda sql, identity="p.t", kind="table", tag="ALTER TABLE": audit("ddl_command_end", tag, kind, identity, sql)
    assert from_audit([end("ALTER TABLE p.t RENAME a TO b")])[0] == Action("rename_column", "p.t", "a", "b")
    assert from_audit([end("ALTER TABLE ONLY old RENAME TO new", "p.new")])[0] == Action("rename_table", "p.old", None, "new")
    drop = audit("sql_drop", "ALTER TABLE", "table column", "p.t.a", None)
    got = from_audit([drop, end("ALTER TABLE p.t DROP COLUMN a, ADD COLUMN b int")])
    assert got == [Action("drop_column", "p.t", "a"), Action("define", "p.t")], "a drop and an addition are no rename"
    assert from_audit([audit("sql_drop", "DROP SCHEMA", "table", "p.t", None)]) == [Action("drop_table", "p.t")]
    assert from_audit([end("COMMENT ON COLUMN p.t.a IS 'it''s';", "p.t.a", "table column", "COMMENT")]) == [Action("comment_column", "p.t", "a", "it's")]
    assert from_audit([end("COMMENT ON TABLE p.t IS NULL", "p.t", "table", "COMMENT")]) == [Action("comment_table", "p.t")]
    assert from_audit([end("ALTER TABLE p.t ADD PRIMARY KEY (a)")]) == [Action("rebuild", "p.t")]
    assert from_audit([end("ALTER TABLE p.t DROP CONSTRAINT t_pkey")]) == [Action("define", "p.t")]


def test_bootstrap_keeps_streamed_rows_and_resumes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "b"), prefix="p_")
    rows = spark.createDataFrame([(1, "old", 1), (2, "old", 2)], "k long, a string, b int")
    fail = [True]

    def load(table, definition):
        if fail:
            raise OSError("source is away")
        return rows

    define = lambda t: Definition(COLUMNS, ["k"] if t == "s.t" else [])
    boot = Bootstrap(lake, lambda: ["s.t", "s.nokey", "sys.x"], define, load, capture_filter())
    assert boot.wanted() and boot.run() == {"s.nokey": "no-pk-skip", "s.t": "pending"}
    lake.commit(lambda m: lake.put(m["tables"].get("p_s.t") or lake.add_table(m, "p_s.t", COLUMNS, ["k"]), rows.where("k = 2").withColumn("a", F.lit("streamed"))))
    fail.clear()
    assert boot.wanted(first_start=False) and boot.run()["s.t"] == "done"
    assert {r["k"]: r["a"] for r in lake.read("p_s.t").collect()} == {1: "old", 2: "streamed"}
    assert boot.checklist()["s.t"]["rows"] == 1 and not boot.wanted()


def test_prefix_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        Lake(spark, str(tmp_path / "c"), prefix="Bad-")


def test_capture_filter():
    f = capture_filter("shop.*", r"shop\.secret, .*_tmp", ("heartbeat",))
    assert f("shop.t") and f("SHOP2.t") and not f("shop.secret") and not f("other.t") and not f("shop.a_tmp") and not f("shop.heartbeat") and not capture_filter()("mysql.user")


def test_maintenance(spark, tmp_path):
    now = [1000.0]
    lake = Lake(spark, str(tmp_path / "m"), inline_rows=10, clock=lambda: now[0])
    row = lambda i: spark.createDataFrame([(i, f"r{i}", i)], "k long, a string, b int")
    for i in range(7):
        lake.commit(lambda m, i=i: lake.put(lake.add_table(m, "s.t", COLUMNS, ["k"]), row(i)))
        if i < 6:
            Maintenance(lake).flush()
    work = Maintenance(lake)
    assert lake.read("s.t").count() == 7 and len(lake.manifest()["tables"]["s.t"]["inline"]) == 1
    assert work.small_files().first()["files"] == 6
    done = work.run("flush", "small")
    assert done == {"flush": 1, "small": 7} and lake.read("s.t").count() == 7
    assert work.small_files().first()["files"] == 1
    now[0] += 40 * 86400
    versions = lake.versions()
    assert work.expire(50) == [] and work.expire(30) == versions[:-1] and lake.versions() == versions[-1:]
    assert lake.read("s.t").count() == 7
    work.compact = lambda *a: 1 / 0
    assert isinstance(work.run("small", "flush")["small"], ZeroDivisionError)


def test_progress(spark, lake):
    s = SyncState("pg")
    s.delivered(5000, 4000)
    assert s.lag_ms == 0
    s.delivered(3000, 9000)
    assert s.source_commit_ms == 5000 and s.lag_ms == 4000
    s.filtered(None, 9000)
    for ms in (10, 20, 30):
        s.committed(5, {"decode": ms, "plan": -1})
    s.committed(0)
    s.failed()
    got = {r["stage"]: r for r in percentiles(s.timing_rows(spark)).collect()}
    assert got["decode"]["p50"] == 20 and got["plan"]["p95"] == 0
    row = watermark(lake, s).first()
    assert (row["events"], row["batches"], row["failures"], row["version"]) == (15, 4, 1, 1)
    with pytest.raises(ValueError):
        s.committed(1, {"nope": 1})


def test_views_and_scalar(lake):
    assert lake.scalar("select count(*) from s_t where k between 3 and 5") == 3
    assert lake.scalar("select k from s_t where false") is None
