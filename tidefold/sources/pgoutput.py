"""Decoder of PostgreSQL's logical replication protocol (pgoutput, version 1).

Messages go in one by one; whole transactions come out at their commit.  Types are described by the
caller's lookup, since the protocol names columns but not their declared types.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass, field

EPOCH_2000_MS = 946_684_800_000


@dataclass
class Relation:
    oid: int
    name: str
    columns: list[str]
    keys: list[str]
    version: int = 0


@dataclass
class Transaction:
    """Rows of one source transaction, in order: (table, op, before, after, unchanged)."""

    xid: int = 0
    begin_lsn: int = 0
    end_lsn: int = 0
    commit_ms: int = 0
    rows: list[tuple] = field(default_factory=list)
    skipped: int = 0


class Bytes:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, layout: str):
        values = struct.unpack_from(">" + layout, self.data, self.at)
        self.at += struct.calcsize(">" + layout)
        return values[0] if len(values) == 1 else values

    def byte(self) -> str:
        return chr(self.take("B"))

    def text(self) -> str:
        end = self.data.index(b"\0", self.at)
        found = self.data[self.at : end].decode("utf-8")
        self.at = end + 1
        return found

    def chunk(self, n: int) -> bytes:
        found = self.data[self.at : self.at + n]
        if len(found) != n:
            raise ValueError("message ends early")
        self.at += n
        return found


class Decoder:
    """State: known relations and the open transaction.  ``captured(table)`` filters rows; audit tables pass as DDL."""

    def __init__(self, captured: Callable[[str], bool] = lambda _: True, audit_tables: tuple[str, ...] = ("dbz_ddl_log",)):
        self.relations: dict[int, Relation] = {}
        self.captured, self.audit_tables = captured, audit_tables
        self.open: Transaction | None = None

    def feed(self, message: bytes) -> Transaction | None:
        """Take a message; the transaction, if the message commits one."""
        b = Bytes(message)
        kind = b.byte()
        handler = {"R": self._relation, "B": self._begin, "I": self._insert, "U": self._update, "D": self._delete, "T": self._truncate, "C": self._commit}.get(kind)
        return handler(b) if handler else None  # type, origin and logical messages carry no rows

    def _relation(self, b: Bytes) -> None:
        oid = b.take("I")
        schema, table, _, n = b.text(), b.text(), b.byte(), b.take("H")
        columns, keys = [], []
        for _ in range(n):
            flags, name, _, _ = b.take("B"), b.text(), b.take("I"), b.take("i")
            columns.append(name)
            if flags & 1:
                keys.append(name)
        old = self.relations.get(oid)
        self.relations[oid] = Relation(oid, f"{schema}.{table}", columns, keys, old.version + 1 if old else 0)

    def _begin(self, b: Bytes) -> None:
        lsn, micros, xid = b.take("QqI")
        self.open = Transaction(xid=xid, begin_lsn=lsn, commit_ms=EPOCH_2000_MS + micros // 1000)

    def _tuple(self, b: Bytes) -> tuple[list[str | None], list[bool]]:
        values: list[str | None] = []
        unchanged: list[bool] = []
        for _ in range(b.take("H")):
            how = b.byte()
            values.append(b.chunk(b.take("I")).decode("utf-8") if how == "t" else None)
            unchanged.append(how == "u")
            if how not in "tun":
                raise ValueError(f"unknown tuple field {how!r}")
        return values, unchanged

    def _row(self, oid: int, op: str, before, after, unchanged) -> None:
        rel = self.relations.get(oid)
        if rel is None:
            raise ValueError(f"row of relation {oid} before its description")
        if self.open is None:
            raise ValueError("row outside a transaction")
        if rel.name.split(".", 1)[1] in self.audit_tables:
            if op == "I":
                self.open.rows.append((rel.name, "DDL", None, after, None))
        elif self.captured(rel.name):
            self.open.rows.append((rel.name, op, before, after, unchanged))
        else:
            self.open.skipped += 1

    def _insert(self, b: Bytes) -> None:
        oid, _ = b.take("I"), b.byte()
        values, unchanged = self._tuple(b)
        self._row(oid, "I", None, values, unchanged)

    def _update(self, b: Bytes) -> None:
        oid, part = b.take("I"), b.byte()
        before = None
        if part in "KO":
            before, _ = self._tuple(b)
            b.byte()
        values, unchanged = self._tuple(b)
        self._row(oid, "U", before, values, unchanged)

    def _delete(self, b: Bytes) -> None:
        oid, _ = b.take("I"), b.byte()
        before, _ = self._tuple(b)
        self._row(oid, "D", before, None, None)

    def _truncate(self, b: Bytes) -> None:
        n, _ = b.take("I"), b.take("B")
        for _ in range(n):
            oid = b.take("I")
            if oid in self.relations:
                self._row(oid, "T", None, None, None)

    def _commit(self, b: Bytes) -> Transaction:
        _, _, end, _ = b.take("BQQq")
        done, self.open = self.open or Transaction(), None
        done.end_lsn = end
        return done
