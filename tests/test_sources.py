import struct
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tidefold.operators.ddl import Evolver
from tidefold.operators.envelope import ENVELOPE, Shape
from tidefold.operators.lake import Lake
from tidefold.sources import binlog, pgoutput
from tidefold.sources.datasource import ChangeReader, ChangeSource, LostSlot, frame
from tidefold.sources.scanner import Scanner
from tidefold.streaming.mirror import Mirror

# messages of the replication protocol, put together field by field


def cstr(s):
    return s.encode() + b"\0"


def relation(oid, schema, table, columns):
    body = b"".join(struct.pack(">B", key) + cstr(name) + struct.pack(">Ii", 25, -1) for name, key in columns)
    return b"R" + struct.pack(">I", oid) + cstr(schema) + cstr(table) + b"d" + struct.pack(">H", len(columns)) + body


def fields(*values):
    out = struct.pack(">H", len(values))
    for v in values:
        out += b"n" if v is None else b"u" if v is ... else b"t" + struct.pack(">I", len(v.encode())) + v.encode()
    return out


def begin(xid, micros=0):
    return b"B" + struct.pack(">QqI", 1, micros, xid)


def commit(end):
    return b"C" + struct.pack(">BQQq", 0, end - 1, end, 0)


def row(kind, oid, *parts):
    return kind + struct.pack(">I", oid) + b"".join(parts)


def insert(oid, *v):
    return row(b"I", oid, b"N", fields(*v))


def update(oid, *v, old=None):
    return row(b"U", oid, *([b"K", fields(*old)] if old else []), b"N", fields(*v))


def delete(oid, *v):
    return row(b"D", oid, b"K", fields(*v))


def truncate(*oids):
    return b"T" + struct.pack(">IB", len(oids), 0) + b"".join(struct.pack(">I", o) for o in oids)


T1 = relation(7, "s", "t", [("k", 1), ("a", 0)])


def test_pgoutput_transaction():
    d = pgoutput.Decoder()
    messages = [T1, begin(5, -1), insert(7, "1", "é"), update(7, "2", ..., old=("1", None)), delete(7, "2", None), truncate(7, 99), b"Y rest", commit(40)]
    got = [d.feed(m) for m in messages][-1]
    assert (got.xid, got.end_lsn, got.commit_ms) == (5, 40, 946684799999)
    assert got.rows == [
        ("s.t", "I", None, ["1", "é"], [False, False]),
        ("s.t", "U", ["1", None], ["2", None], [False, True]),
        ("s.t", "D", ["2", None], None, None),
        ("s.t", "T", None, None, None),
    ]
    assert d.relations[7].keys == ["k"]


def test_pgoutput_filter_and_errors():
    d = pgoutput.Decoder(captured=lambda t: t != "s.t")
    for m in (T1, begin(1), insert(7, "1", "a")):
        d.feed(m)
    done = d.feed(commit(9))
    assert done.rows == [] and done.skipped == 1
    with pytest.raises(ValueError, match="outside"):
        d.feed(insert(7, "1", "a"))
    d.feed(begin(2))
    with pytest.raises(ValueError, match="before its description"):
        d.feed(insert(8, "1"))


AUDIT = relation(9, "public", "dbz_ddl_log", [(n, 0) for n in ("id", "ev", "tag", "object_type", "object_identity", "query_text", "xid", "occurred_at")])
SHAPES = {1: Shape("s.t", (("k", T.LongType()), ("a", T.StringType())), ("k",))}


def write(path, messages, mode="wb"):
    with open(path, mode) as f:
        for m in messages:
            f.write(frame(0, m))


def test_stream_into_lake_with_ddl_and_restart(spark, tmp_path):
    spark.dataSource.register(ChangeSource)
    log = tmp_path / "log"
    write(log, [T1, AUDIT, begin(1), insert(7, "1", "a"), insert(7, "2", "b"), commit(10), begin(2), update(7, "1", "z"), commit(20)])
    lake = Lake(spark, str(tmp_path / "lake"))
    shape = {"s.t": Shape("s.t", (("k", T.LongType()), ("a", T.StringType())), ("k",))}
    mirror = Mirror(lake, "pg", shape.__getitem__, Evolver(lake))

    def run(checkpoint="c"):
        stream = spark.readStream.format("pg_cdc").option("path", str(log)).option("maxRows", "2").load()
        q = mirror.start(stream, str(tmp_path / checkpoint), processingTime="0 seconds")
        q.processAllAvailable()
        q.stop()
        return {r["k"]: r[1] for r in lake.read("s.t").collect()}

    assert run() == {1: "z", 2: "b"} and mirror.offset() == 20
    versions = lake.versions()
    assert run("fresh checkpoint") == {1: "z", 2: "b"}
    assert lake.versions() == versions, "a replay from the start publishes nothing"
    renamed = relation(7, "s", "t", [("k", 1), ("b", 0)])
    ddl = insert(9, "1", "ddl_command_end", "ALTER TABLE", "table", "s.t", "ALTER TABLE s.t RENAME COLUMN a TO b", "3", None)
    shape["s.t"] = Shape("s.t", (("k", T.LongType()), ("b", T.StringType())), ("k",))
    write(log, [begin(3), ddl, renamed, insert(7, "3", "c"), commit(30), begin(4), delete(7, "2", None), commit(40)], "ab")
    assert run() == {1: "z", 3: "c"} and lake.read("s.t").columns == ["k", "b"]
    assert mirror.state.counts["ddl_applied"] == 1


def test_insert_only_rows_come_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    mirror = Mirror(lake, "pg", lambda _: Shape("s.n", (("v", T.StringType()),), ()))
    batch = spark.createDataFrame([("pg", 5, 0, 1, None, "s.n", "I", None, ["x"], None, 0)], ENVELOPE)
    mirror.apply(batch)
    mirror.apply(batch)
    assert lake.read("s.n").count() == 1


def test_two_drivers_of_one_source_apply_a_batch_once(spark, tmp_path):
    """The second one publishes while the first is at work; a table without a key would show rows twice."""
    shape = Shape("s.n", (("v", T.StringType()),), ())
    one, two = (Mirror(Lake(spark, str(tmp_path / "lake"), pause=0.01), "pg", lambda _: shape) for _ in range(2))
    batch = spark.createDataFrame([("pg", 5, i, 1, None, "s.n", "I", None, [str(i)], None, 0) for i in range(5)], ENVELOPE)
    real, tried = one.lake.store.create, []

    def slow(name, text, *rest):
        if not tried:
            tried.append(name)
            two.apply(batch)
        return real(name, text, *rest)

    one.lake.store.create = slow
    one.apply(batch)
    assert one.lake.read("s.n").count() == 5 and len(one.lake.versions()) == 1 and one.state.counts["events"] == 0
    older = spark.createDataFrame([("pg", 4, 0, 1, None, "s.n", "I", None, ["old"], None, 0)], ENVELOPE)
    one.apply(older)
    assert one.offset() == 5 and one.initialise(1) == 5, "an offset never moves back"


class FakeServer:
    """A slot, its messages by LSN, and what was acknowledged."""

    held: list = []
    confirmed: int | None = None
    acknowledged: list = []

    def __init__(self, options):
        self.options = options

    def slot(self):
        return FakeServer.confirmed

    def create_slot(self):
        FakeServer.confirmed = 0
        return 0

    def messages(self, after, at=0):
        yield from ((0, m) for m in FakeServer.held)

    def acknowledge(self, lsn):
        FakeServer.acknowledged.append(lsn)
        FakeServer.confirmed = lsn


def test_slot_is_checked_and_acknowledged_after_the_batch():
    FakeServer.held, FakeServer.confirmed, FakeServer.acknowledged = [T1, begin(1), insert(7, "1", "a"), commit(10), begin(2), commit(20)], None, []
    reader = ChangeReader({"transport": f"{__name__}:FakeServer", "slot": "x"})
    start = reader.initialOffset()
    rows, end = reader.read(start)
    assert [(r[1], r[5], r[6]) for r in rows] == [(10, "s.t", "I"), (20, None, "KEEP")] and end["lsn"] == 20
    assert FakeServer.acknowledged == [] and list(reader.readBetweenOffsets(start, end))[-1][6] == "KEEP"
    reader.commit(end)
    assert FakeServer.acknowledged == [20]
    again = ChangeReader({"transport": f"{__name__}:FakeServer"})
    assert list(again.read(end)[0]) == []
    with pytest.raises(LostSlot, match="confirmed up to 20"):
        ChangeReader({"transport": f"{__name__}:FakeServer"}).read({"lsn": 15, "at": 0})
    FakeServer.confirmed = None
    with pytest.raises(LostSlot, match="gone"):
        ChangeReader({"transport": f"{__name__}:FakeServer"}).read(end)


def test_resume_decodes_only_what_is_new(tmp_path, monkeypatch):
    log = tmp_path / "log"
    write(log, [T1] + [m for i in range(50) for m in (begin(i), insert(7, str(i), "a"), commit(10 * i + 10))])
    options = {"path": str(log), "maxRows": "10"}
    reader, seen, fed = ChangeReader(options), [], []
    real = pgoutput.Decoder.feed
    monkeypatch.setattr(pgoutput.Decoder, "feed", lambda self, m: fed.append(m) or real(self, m))
    end = reader.initialOffset()
    for _ in range(6):
        rows, end = reader.read(end)
        seen += [r[8][0] for r in rows]
    assert seen == [str(i) for i in range(50)] and len(fed) == 151 + 5, "each message once, the relation once more for each batch"
    assert ChangeReader(options | {"maxMillis": "0"}).read(reader.initialOffset())[1]["lsn"] == 10, "time closes a batch too"


def test_batch_without_rows_moves_the_offset_alone(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    mirror = Mirror(lake, "pg", lambda _: SHAPES[1])
    row = lambda lsn, table, op, after: ("pg", lsn, 0, 1, None, table, op, None, after, None, 0)
    mirror.apply(spark.createDataFrame([row(5, "s.t", "I", ["1", "a"])], ENVELOPE))
    files = lake.manifest()["tables"]["s.t"]["files"]
    mirror.apply(spark.createDataFrame([row(9, None, "KEEP", ['{"file": "b.2", "gtid": "x:1-9"}'])], ENVELOPE))
    now = lake.manifest()
    assert now["offsets"]["pg"] == {"lsn": 9, "position": {"file": "b.2", "gtid": "x:1-9"}} and now["tables"]["s.t"]["files"] == files
    assert (mirror.state.counts["filtered"], mirror.state.counts["batches"]) == (1, 1)
    assert {s for _, _, s, _ in mirror.state.timings} >= {"append", "lock_wait", "ensure", "mirror_dml", "lake_commit", "cleanup", "offset_ack"}


def test_failed_batch_leaves_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    mirror = Mirror(lake, "pg", lambda _: Shape("s.n", (("v", T.LongType()),), ()))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        mirror.apply(spark.createDataFrame([("pg", 5, 0, 1, None, "s.n", "I", None, ["x"], None, 0)], ENVELOPE))
    assert lake.versions() == [] and mirror.state.counts["failures"] == 1


# MySQL events


def shop(**more):
    event = {
        "type": "table_map", "table_id": 1, "schema": "shop", "table": "t", "names": ["id", "tier", "labels", "n", "j", "at"], "codes": [8, 254, 254, 1, 245, 18],
        "metadata": [0, 247 << 8, 248 << 8, 0, 4, 6], "unsigned": [True, False, False, False, False, False], "enum_labels": [("gold", "silver")], "set_labels": [("red", "blue")], "primary_key": [0],
    }
    return event | more


def test_binlog_transaction():
    d = binlog.Decoder(position={"file": "b.1"})
    d.feed(shop())
    d.feed({"type": "query", "sql": "BEGIN"})
    d.feed({"type": "write", "table_id": 1, "rows": [[-1, 2, 3, -5, '{"a": 1}', 0]], "next_pos": 50})
    d.feed({"type": "update", "table_id": 1, "rows": [([1, 1, 0, 0, None, -(2**63)], [2, 9, 1, 0, None, None])]})
    d.feed({"type": "write", "table_id": 77, "rows": [[1]]})
    done = d.feed({"type": "xid", "ms": 7, "next_pos": 90})
    assert done.rows == [
        ("shop.t", "I", None, [str(2**64 - 1), "silver", "red,blue", "-5", '{"a": 1}', "1970-01-01 00:00:00.000000"], None),
        ("shop.t", "U", ["1", "gold", "", "0", None, None], ["2", "9", "red", "0", None, None], None),
    ]
    assert done.position == {"file": "b.1", "pos": 90} and done.commit_ms == 7


def test_binlog_rules():
    d = binlog.Decoder(captured=lambda t: False)
    d.feed(shop())
    d.feed({"type": "write", "table_id": 1, "rows": [[1, 1, 1, 1, None, 0]]})
    done = d.feed({"type": "xid"})
    assert done.rows == [] and done.skipped == 1 and done.position is None
    d = binlog.Decoder()
    d.feed(shop())
    d.feed({"type": "write", "table_id": 1, "rows": [[1, 1, 1, 1, None, 0]]})
    for bad in ({"type": "query", "sql": "BEGIN"}, {"type": "query", "sql": "ALTER TABLE t ADD x INT"}, {"type": "rotate", "file": "b.2"}):
        with pytest.raises(ValueError):
            d.feed(bad)
    d.feed({"type": "query", "sql": "ROLLBACK"})
    assert d.feed({"type": "rotate", "file": "b.2"}).position == {"file": "b.2", "pos": 4} and not d.maps
    assert d.feed({"type": "query", "sql": "TRUNCATE t;", "schema": "shop"}).ddl == ("TRUNCATE t", "shop")
    assert d.feed({"type": "query", "sql": "GRANT ALL ON x TO y"}) is None
    with pytest.raises(ValueError, match="metadata"):
        d.feed(shop(names=None))


def test_binlog_values():
    c = lambda code, **k: binlog.Column("x", code, **k)
    assert binlog.text_of(Decimal("1E+2"), c(246)) == "100"
    assert binlog.text_of(b"\x01\x02", c(252, binary=True)) == "0102"
    assert binlog.text_of("é".encode(), c(252)) == "é"
    assert binlog.text_of(b"\x01", c(16, metadata=1)) == "true"
    assert binlog.text_of(b"\x01\xff", c(16, metadata=1 << 8 | 1)) == "01FF"
    assert binlog.text_of(-3020399000000, c(19)) == "-838:59:59.000000"
    assert binlog.text_of(86_400_000_000, c(10)) == "1970-01-02"
    assert binlog.text_of(1, c(17)) == "1970-01-01T00:00:00.000001Z"
    assert binlog.expand([1, 2], [True, False, True]) == [1, None, 2]


def test_binary_json():
    # {"a": [1, "x", null]}: small object with one key, an array of an int16, a string and a literal
    array = struct.pack("<HH", 3, 15) + b"\x05" + struct.pack("<H", 1) + b"\x0c" + struct.pack("<H", 13) + b"\x04\x00\x00" + b"\x01x"
    head = struct.pack("<HH", 1, 12 + len(array)) + struct.pack("<HH", 11, 1) + b"\x02" + struct.pack("<H", 12) + b"a"
    assert binlog.json_text(b"\x00" + head + array) == '{"a": [1, "x", null]}'
    assert binlog.json_text(b"\x0b" + struct.pack("<d", 1.5)) == "1.5"
    assert binlog.json_text(b"") == "null"


def test_source_contract():
    binlog.check_source({"binlog_format": "ROW", "binlog_row_image": "full"})
    with pytest.raises(ValueError, match="binlog_row_metadata"):
        binlog.check_source({"binlog_row_metadata": "MINIMAL"})


def test_scanner_over_jdbc(spark, tmp_path):
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    options = {"url": url, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "password": "hidden"}
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, a string")
    rows.write.format("jdbc").options(**options).option("dbtable", "T1").save()
    one = "SELECT 'k' AS c, 'bigint' AS d, 0 AS n, CAST(NULL AS VARCHAR(9)) AS r, 'note' AS t, 1 AS p, 1 AS o FROM SYSIBM.SYSDUMMY1 WHERE '{table}' = 'T1'"
    two = " UNION ALL SELECT 'a' AS c, 'text' AS d, 0 AS n, 'text of it' AS r, 'note' AS t, 0 AS p, 2 AS o FROM SYSIBM.SYSDUMMY1 WHERE '{table}' = 'T1'"
    scanner = Scanner(spark, "pg", options, one + two, "SELECT 'APP' AS s, TABLENAME AS t FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'")
    assert "hidden" not in repr(scanner)
    assert scanner.ready("T1") and not scanner.ready("NOPE")
    assert "APP.T1" in scanner.tables()
    d = scanner.definition("APP.T1")
    assert d.columns == [("k", T.LongType()), ("a", T.StringType())] and d.keys == ["k"] and d.comment == "note" and d.comments == {"a": "text of it"}
    assert scanner.definition("APP.GONE") is None
    assert len(scanner.load("T1", d).where("k > 1").collect()) == 2
    assert scanner.table("T1", "k", 1, 3, 2).rdd.getNumPartitions() == 2


def test_mysql_stream_with_ddl_key_move_and_restart(spark, tmp_path):
    import json

    from tidefold.sources.datasource import EventSource, place

    assert place({"file": "b.000002", "pos": 4}) > place({"file": "b.000001", "pos": 10**9})
    spark.dataSource.register(EventSource)
    log = tmp_path / "events"
    table = {"type": "table_map", "table_id": 1, "schema": "shop", "table": "t", "names": ["id", "v"], "codes": [8, 15], "primary_key": [0]}
    events = [
        {"type": "rotate", "file": "b.000001"}, table, {"type": "query", "sql": "BEGIN"},
        {"type": "write", "table_id": 1, "rows": [[1, "a"], [2, "b"], [3, "c"]]}, {"type": "xid", "next_pos": 100, "ms": 1000},
        table | {"table_id": 2, "schema": "mysql"}, {"type": "write", "table_id": 2, "rows": [[1, "x"]]}, {"type": "xid", "next_pos": 150},
        {"type": "update", "table_id": 1, "rows": [[[1, "a"], [9, {"hex": "c3a9"}]]]}, {"type": "delete", "table_id": 1, "rows": [[2, "b"]]}, {"type": "xid", "next_pos": 200},
        {"type": "query", "sql": "ALTER TABLE t RENAME COLUMN v TO w", "schema": "shop", "next_pos": 250},
        table | {"names": ["id", "w"]}, {"type": "write", "table_id": 1, "rows": [[4, "d"]]}, {"type": "xid", "next_pos": 300},
    ]
    log.write_text("".join(json.dumps(e) + "\n" for e in events))
    lake = Lake(spark, str(tmp_path / "lake"))
    names = iter(["v", "w"])
    now = [next(names)]

    def shape(_):
        have = lake.manifest()["tables"].get("shop.t")
        renamed = have and any(f["lsn"] >= place({"file": "b.000001", "pos": 250}) for f in lake.manifest()["offsets"].values())
        return Shape("shop.t", (("id", T.LongType()), ("w" if renamed else now[0], T.StringType())), ("id",), "mysql")

    mirror = Mirror(lake, "mysql", shape, Evolver(lake), dialect="mysql")
    for _ in range(2):
        stream = spark.readStream.format("mysql_cdc").option("path", str(log)).load()
        q = mirror.start(stream, str(tmp_path / "c"), processingTime="0 seconds")
        q.processAllAvailable()
        q.stop()
        assert {r["id"]: r["w"] for r in lake.read("shop.t").collect()} == {9: "é", 3: "c", 4: "d"}
    assert lake.read("shop.t").columns == ["id", "w"] and lake.manifest()["offsets"]["mysql"]["position"] == {"file": "b.000001", "pos": 300}


def test_mysql_changes_need_a_file(tmp_path):
    import json

    from tidefold.sources.datasource import EventReader

    log = tmp_path / "events"
    table = {"type": "table_map", "table_id": 1, "schema": "shop", "table": "t", "names": ["id"], "codes": [8], "primary_key": [0]}
    events = [table, {"type": "write", "table_id": 1, "rows": [[1]]}, {"type": "xid", "next_pos": 9}]
    log.write_text("".join(json.dumps(e) + "\n" for e in events))
    with pytest.raises(ValueError, match="file is known"):
        EventReader({"path": str(log)}).read({"file": "", "pos": 0})
    reader = EventReader({"path": str(log), "startPosition": '{"file": "b.7"}'})
    rows, end = reader.read(reader.initialOffset())
    assert [r[6] for r in rows] == ["I", "KEEP"] and end["file"] == "b.7"
