"""Change streams as envelope rows: ``spark.readStream.format("pg_cdc")`` and ``format("mysql_cdc")``.

For PostgreSQL a transport delivers framed messages; ``transport`` names its class, by default a file
(``path``).  Offsets are the LSNs at which commits end, so a micro-batch never
splits a transaction; it closes at the first commit at or beyond ``maxRows`` or after ``maxMillis``, and behind a
transaction with DDL.  A batch whose last transaction has no captured row ends with a ``KEEP`` row, so that the lake's
offset follows the source.  An offset without a slot, or one that the slot has passed, is refused: rows would be missing.
"""

from __future__ import annotations

import importlib
import json
import re
import struct
import time
from collections.abc import Iterator
from datetime import UTC, datetime
from decimal import Decimal
from typing import Protocol

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..operators.bootstrap import capture_filter
from ..operators.envelope import ENVELOPE, KEEP
from .binlog import Decoder as MySqlDecoder
from .pgoutput import Decoder, Transaction

FRAME = struct.Struct(">QI")


class LostSlot(Exception):
    """The source no longer holds what follows a saved offset: the tables have to be loaded anew."""


class Transport(Protocol):
    """A replication connection.  It is made from the source's options (slot, publication, host and so on)."""

    def slot(self) -> int | None:
        """Up to where the slot has been confirmed; None without a slot."""

    def create_slot(self) -> int:
        """Make the slot; from where it holds changes."""

    def messages(self, after: int, at: int = 0) -> Iterator[tuple[int, bytes]]:
        """(place behind it, message) from a transaction's beginning on; ``at`` is a place that was given before, or 0."""

    def acknowledge(self, lsn: int) -> None:
        """The source may forget what lies before this LSN."""


class FileTransport:
    """Frames of (LSN, length, message) in a file, which is slot and log in one.  Places are bytes."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def slot(self) -> int | None:
        return 0

    def create_slot(self) -> int:
        return 0

    def messages(self, after: int, at: int = 0) -> Iterator[tuple[int, bytes]]:
        """From ``at`` on; before it only descriptions of relations are read, as a server sends them again."""
        with open(self.path, "rb") as f:
            while len(head := f.read(FRAME.size)) == FRAME.size:
                _, size = FRAME.unpack(head)
                begin = f.tell()
                kind = f.read(1)
                if begin + size <= at and kind != b"R":
                    f.seek(begin + size)
                    continue
                body = kind + f.read(size - 1)
                if len(body) < size:
                    return  # still being written
                yield begin + size, body

    def acknowledge(self, lsn: int) -> None:
        """A file forgets nothing."""


def transport_of(options: dict) -> Transport:
    """The class that ``transport`` names as ``module:Class``, made from the options."""
    module, _, name = options.get("transport", f"{__name__}:FileTransport").partition(":")
    return getattr(importlib.import_module(module), name)(dict(options))


def frame(lsn: int, message: bytes) -> bytes:
    return FRAME.pack(lsn, len(message)) + message


def rows_of(source: str, t: Transaction) -> Iterator[tuple]:
    at = datetime.fromtimestamp(t.commit_ms / 1000, UTC)
    for i, (table, op, before, after, unchanged) in enumerate(t.rows):
        yield (source, t.end_lsn, i, t.xid, at, table, op, before, after, unchanged, 0)


def keep(source: str, lsn: int, at: datetime | None, position: dict | None = None) -> tuple:
    return (source, lsn, 2**31, None, at, None, KEEP, None, [json.dumps(position)] if position else None, None, 0)


class ChangeReader(SimpleDataSourceStreamReader):
    """``decode_ms`` sums up the time that reading and decoding took."""

    def __init__(self, options: dict):
        self.options = options
        self.transport = transport_of(options)
        self.source = options.get("source", "pg")
        self.max_rows, self.max_ms = int(options.get("maxRows", "8192")), float(options.get("maxMillis", "inf"))
        self.captured = capture_filter(options.get("include", ""), options.get("exclude", ""))
        self.audit = tuple(x.strip() for x in options.get("auditTables", "dbz_ddl_log").split(","))
        self.start = int(options.get("startLsn", "0"))
        self.checked, self.decode_ms = False, 0.0

    def initialOffset(self) -> dict:
        return {"lsn": self.start, "at": 0}

    def check_slot(self, start: dict) -> None:
        """Before the first read: a saved offset needs its slot; without either, a slot is made."""
        if self.checked:
            return
        confirmed = self.transport.slot()
        resumed = start != self.initialOffset()
        if confirmed is None and resumed:
            raise LostSlot(f"offset {start['lsn']} was saved, but the slot is gone")
        if confirmed is None:
            self.transport.create_slot()
        elif resumed and confirmed > start["lsn"]:
            raise LostSlot(f"offset {start['lsn']} was saved, but the slot has been confirmed up to {confirmed}")
        self.checked = True

    def transactions(self, after: dict) -> Iterator[tuple[Transaction, int]]:
        """Transactions that end behind an offset, each with the place behind it."""
        self.check_slot(after)
        decoder = Decoder(self.captured, self.audit)
        for at, message in self.transport.messages(after["lsn"], after.get("at", 0)):
            done = decoder.feed(message)
            if done is not None and done.end_lsn > after["lsn"]:
                yield done, at

    def marked(self, last: Transaction | None) -> list[tuple]:
        return [keep(self.source, last.end_lsn, datetime.fromtimestamp(last.commit_ms / 1000, UTC))] if last and not last.rows else []

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found, end, last, began = [], start, None, time.monotonic()
        for last, at in self.transactions(start):
            found += rows_of(self.source, last)
            end = {"lsn": last.end_lsn, "at": at}
            if len(found) >= self.max_rows or (time.monotonic() - began) * 1000 >= self.max_ms or any(op == "DDL" for _, op, *_ in last.rows):
                break
        self.decode_ms += (time.monotonic() - began) * 1000
        return iter(found + self.marked(last)), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        last = None
        for t, _ in self.transactions(start):
            if t.end_lsn > end["lsn"]:
                break
            last = t
            yield from rows_of(self.source, t)
        yield from self.marked(last)

    def commit(self, end: dict) -> None:
        """Called when the batch is in the lake: only now may the source forget it."""
        self.transport.acknowledge(end["lsn"])


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pg_cdc"

    def schema(self):
        return ENVELOPE

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return ChangeReader(self.options)


class EventFile:
    """MySQL log events as JSON lines, in the form that ``binlog.Decoder`` takes; bytes as {"hex": ...}, decimals as {"dec": ...}."""

    def __init__(self, path: str):
        self.path = path

    def events(self, at: int = 0) -> Iterator[tuple[int, dict]]:
        """(byte behind it, event) from a byte on; before it only table maps and rotations, which later rows need."""
        with open(self.path, "rb") as f:
            end = 0
            for line in f:
                end += len(line)
                if not line.endswith(b"\n"):
                    return  # still being written
                if end > at or b'"table_map"' in line or b'"rotate"' in line:
                    yield end, json.loads(line, object_hook=_value)


def _value(found: dict):
    if set(found) == {"hex"}:
        return bytes.fromhex(found["hex"])
    return Decimal(found["dec"]) if set(found) == {"dec"} else found


def place(position: dict) -> int:
    """A position of the log as one growing number: the file's number, then the byte in it."""
    number = re.search(r"(\d+)$", position.get("file") or "0")
    return (int(number[1]) if number else 0) << 40 | int(position.get("pos", 0))


class EventReader(SimpleDataSourceStreamReader):
    """Transactions and DDL statements of a MySQL log; a DDL statement, like the caps of rows and time, ends a micro-batch.

    Offsets hold file, position, the set of GTIDs if the log has one, and the byte of the event file.  Each batch ends with a ``KEEP`` row with
    its position, so filtered transactions and rotations move the lake's offset too.
    """

    def __init__(self, options: dict):
        self.log = EventFile(options["path"])
        self.source = options.get("source", "mysql")
        self.max_rows, self.max_ms = int(options.get("maxRows", "8192")), float(options.get("maxMillis", "inf"))
        self.captured = capture_filter(options.get("include", ""), options.get("exclude", ""))
        self.start = json.loads(options.get("startPosition", "{}"))

    def initialOffset(self) -> dict:
        return {"file": self.start.get("file", ""), "pos": self.start.get("pos", 0), "at": 0}

    def batches(self, after: dict) -> Iterator[tuple[dict, list[tuple], datetime]]:
        """(offset, rows, commit time) of what lies behind an offset."""
        decoder, begin = MySqlDecoder(self.captured, {"file": self.start.get("file", "")}), after.get("at", 0)
        for byte, event in self.log.events(begin):
            done = decoder.feed(event)
            if done is None or byte <= begin:
                continue
            if done.position is None:
                if done.rows or done.ddl:
                    raise ValueError("changes before the log's file is known: start with a position or a rotation")
                continue
            if place(done.position) <= place(after):
                continue
            at, lsn = datetime.fromtimestamp(done.commit_ms / 1000, UTC), place(done.position)
            offset = {"file": done.position["file"], "pos": done.position.get("pos", 0), "at": byte} | ({"gtid": done.position["gtid"]} if "gtid" in done.position else {})
            if done.ddl:
                yield offset, [(self.source, lsn, 0, lsn, at, "ddl", "DDL", None, list(done.ddl), None, 0)], at
            else:
                yield offset, [(self.source, lsn, i, lsn, at, t, op, b, a, None, 0) for i, (t, op, b, a, _) in enumerate(done.rows)], at

    def marked(self, end: dict, at: datetime | None) -> list[tuple]:
        return [keep(self.source, place(end), at, {k: v for k, v in end.items() if k != "at"})] if at else []

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found, end, at, began = [], start, None, time.monotonic()
        for end, rows, at in self.batches(start):
            found += rows
            if len(found) >= self.max_rows or (time.monotonic() - began) * 1000 >= self.max_ms or any(r[6] == "DDL" for r in rows):
                break
        return iter(found + self.marked(end, at)), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = None
        for offset, rows, when in self.batches(start):
            if place(offset) > place(end):
                break
            at = when
            yield from rows
        yield from self.marked(end, at)

    def commit(self, end: dict) -> None:
        """A log server keeps its files by age; nothing is acknowledged."""


class EventSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mysql_cdc"

    def schema(self):
        return ENVELOPE

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return EventReader(self.options)
