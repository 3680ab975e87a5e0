"""MySQL row log: from typed events (as a log client delivers them) to whole transactions of text rows.

Events are mappings with a ``type``; see the handlers.  A row's values arrive as Python values, its
columns by a table map that needs full metadata.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from decimal import Decimal

from ..functions.types import effective_code
from ..plans.ddl_text import is_table_ddl

INVALID_TEMPORAL = -(2**63)
WIDTHS = {1: 8, 2: 16, 9: 24, 3: 32, 8: 64}
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def check_source(status: dict[str, str]) -> None:
    """Raise unless the server writes what the mirror needs: rows, full images, full metadata, no compression."""
    wanted = {"log_bin": ("ON", "1"), "binlog_format": ("ROW",), "binlog_row_image": ("FULL",), "binlog_row_metadata": ("FULL",), "binlog_transaction_compression": ("OFF", "0")}
    for name, allowed in wanted.items():
        if name in status and str(status[name]).upper() not in allowed:
            raise ValueError(f"{name} is {status[name]}; {allowed[0]} is needed")


@dataclass(frozen=True)
class Column:
    name: str
    code: int
    metadata: int = 0
    unsigned: bool = False
    labels: tuple[str, ...] = ()
    binary: bool = False
    declared: str = ""


@dataclass(frozen=True)
class TableMap:
    name: str
    columns: tuple[Column, ...]
    keys: tuple[str, ...]


@dataclass
class Batch:
    """Rows of a committed transaction or a DDL statement, and the position behind it."""

    rows: list[tuple] = field(default_factory=list)
    ddl: tuple[str, str | None] | None = None
    position: dict | None = None
    commit_ms: int = 0
    skipped: int = 0


def table_map(event: dict) -> TableMap:
    """Columns of a table map event: names are required, signs and labels come in column order of their kinds."""
    names = event.get("names")
    if not names:
        raise ValueError(f"{event['schema']}.{event['table']}: full row metadata is needed")
    labels = {247: iter(event.get("enum_labels", ())), 248: iter(event.get("set_labels", ()))}
    columns = []
    for i, (name, code) in enumerate(zip(names, event["codes"], strict=True)):
        meta = event.get("metadata", [0] * len(names))[i]
        real = effective_code(code, meta)
        own = tuple(next(labels[real], ())) if real in labels else ()
        columns.append(Column(name, real, meta, bool(event.get("unsigned", [False] * len(names))[i]), own, bool(event.get("binary", [False] * len(names))[i]), event.get("declared", {}).get(name, "")))
    keys = tuple(names[i] for i in event.get("primary_key", ()))
    return TableMap(f"{event['schema']}.{event['table']}", tuple(columns), keys)


def expand(values: list, present: list[bool]) -> list:
    """A packed row with nulls where the bitmap has no column."""
    packed = iter(values)
    return [next(packed) if p else None for p in present]


def text_of(value, column: Column) -> str | None:
    """A value as the text that the casts expect."""
    if value is None or (value == INVALID_TEMPORAL and column.code in (7, 10, 11, 12, 17, 18, 19)):
        return None
    if column.code == 245:
        return json_text(value) if isinstance(value, (bytes, bytearray)) else str(value)
    if column.code == 247 and isinstance(value, int):
        return column.labels[value - 1] if 0 < value <= len(column.labels) else str(value)
    if column.code == 248 and isinstance(value, int):
        if not column.labels:
            return str(value % 2**64)
        return ",".join(name for i, name in enumerate(column.labels) if value >> i & 1)
    if column.code == 16:
        bits = (column.metadata >> 8) * 8 + (column.metadata & 255)
        number = int.from_bytes(value, "big") if isinstance(value, (bytes, bytearray)) else int(value)
        return ("true" if number & 1 else "false") if bits == 1 else number.to_bytes((bits + 7) // 8, "big").hex().upper()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex().upper() if column.binary or column.code in (242, 255) else bytes(value).decode("utf-8", "replace")
    if isinstance(value, Decimal):
        return format(value, "f")
    if column.code in (7, 10, 11, 12, 17, 18, 19) and isinstance(value, int):
        return temporal_text(value, column.code)
    if isinstance(value, int) and column.code in WIDTHS:
        return str(value % (1 << WIDTHS[column.code]) if column.unsigned else value)
    return str(value)


def temporal_text(micros: int, code: int) -> str:
    if code in (11, 19):
        size = abs(micros)
        seconds, fraction = divmod(size, 1_000_000)
        return f"{'-' if micros < 0 else ''}{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}.{fraction:06d}"
    moment = EPOCH + timedelta(microseconds=micros)
    if code == 10:
        return moment.date().isoformat()
    shown = moment.strftime("%Y-%m-%dT%H:%M:%S.%f")
    return shown + "Z" if code in (7, 17) else shown.replace("T", " ")


def json_text(data: bytes) -> str:
    """MySQL's binary JSON as text."""
    return json.dumps(_json(data[0], data, 1), ensure_ascii=False, separators=(", ", ": ")) if data else "null"


def _json(kind: int, data: bytes, at: int):
    if kind in (0, 1, 2, 3):
        return _container(kind, data, at)
    if kind == 4:
        return {0: None, 1: True, 2: False}[data[at]]
    numbers = {5: "<h", 6: "<H", 7: "<i", 8: "<I", 9: "<q", 10: "<Q", 11: "<d"}
    if kind in numbers:
        return struct.unpack_from(numbers[kind], data, at)[0]
    if kind == 12:
        size, at = _length(data, at)
        return data[at : at + size].decode("utf-8")
    if kind == 15:
        size, start = _length(data, at + 1)
        raw = data[start : start + size]
        if data[at] == 246:
            return _decimal(raw)
        return raw.hex().upper()
    raise ValueError(f"unknown JSON type {kind}")


def _decimal(raw: bytes):
    """Opaque decimal: precision, scale, then groups of nine digits with the sign in the first bit."""
    precision, scale = raw[0], raw[1]
    sizes = [0, 1, 1, 2, 2, 3, 3, 4, 4, 4]
    whole, body = precision - scale, bytearray(raw[2:])
    negative = not body[0] & 0x80
    body[0] ^= 0x80
    if negative:
        body = bytearray(b ^ 0xFF for b in body)
    groups = [whole % 9] * (whole % 9 > 0) + [9] * (whole // 9), [9] * (scale // 9) + [scale % 9] * (scale % 9 > 0)
    digits, at = ["", ""], 0
    for side in (0, 1):
        for g in groups[side]:
            digits[side] += str(int.from_bytes(body[at : at + sizes[g]], "big")).zfill(g)
            at += sizes[g]
    return float(f"{'-' if negative else ''}{digits[0] or 0}.{digits[1] or 0}")


def _length(data: bytes, at: int) -> tuple[int, int]:
    size = shift = 0
    while True:
        b = data[at]
        at += 1
        size |= (b & 127) << shift
        shift += 7
        if not b & 128:
            return size, at


def _container(kind: int, data: bytes, start: int):
    wide = kind in (1, 3)
    width, mark = (4, "<I") if wide else (2, "<H")
    count = struct.unpack_from(mark, data, start)[0]
    at = start + 2 * width
    names = []
    if kind in (0, 1):
        for _ in range(count):
            offset, size = struct.unpack_from(mark, data, at)[0], struct.unpack_from("<H", data, at + width)[0]
            names.append(data[start + offset : start + offset + size].decode("utf-8"))
            at += width + 2
    values = []
    for _ in range(count):
        one = data[at]
        inline = one in (4, 5, 6) or (wide and one in (7, 8))
        where = at + 1 if inline else start + struct.unpack_from(mark, data, at + 1)[0]
        values.append(_json(one, data, where))
        at += 1 + width
    return dict(zip(names, values, strict=True)) if kind in (0, 1) else values


class Decoder:
    """State: table maps, the open transaction, and the position behind the last event."""

    def __init__(self, captured: Callable[[str], bool] = lambda _: True, position: dict | None = None):
        self.captured = captured
        self.maps: dict[int, TableMap] = {}
        self.pending: list[tuple] = []
        self.inside = False
        self.skipped = 0
        self.position = dict(position or {})

    def feed(self, event: dict) -> Batch | None:
        """Take an event; what it completes, if anything."""
        kind = event["type"]
        if kind == "rotate":
            if self.pending:
                raise ValueError("the log was rotated inside a transaction")
            self.maps.clear()
            self.position |= {"file": event["file"], "pos": event.get("pos", 4)}
            return Batch(position=dict(self.position))
        if event.get("next_pos"):
            self.position["pos"] = event["next_pos"]
        if event.get("gtid_set"):
            self.position["gtid"] = event["gtid_set"]
        handler = getattr(self, f"_{kind}", None)
        return handler(event) if handler else None

    def _table_map(self, event: dict) -> None:
        self.maps[event["table_id"]] = table_map(event)

    def _write(self, event: dict) -> None:
        for row in event["rows"]:
            self._add(event, "I", None, row)

    def _delete(self, event: dict) -> None:
        for row in event["rows"]:
            self._add(event, "D", row, None)

    def _update(self, event: dict) -> None:
        for before, after in event["rows"]:
            self._add(event, "U", before, after)

    def _add(self, event: dict, op: str, before, after) -> None:
        known = self.maps.get(event["table_id"])
        if known is None:
            return
        if not self.captured(known.name):
            self.skipped += 1
            return
        present = event.get("present")
        text = lambda row: None if row is None else [text_of(v, c) for v, c in zip(expand(row, present) if present else row, known.columns, strict=True)]
        self.pending.append((known.name, op, text(before), text(after), None))

    def _xid(self, event: dict) -> Batch:
        done = Batch(self.pending, None, dict(self.position) if self.position.get("file") else None, event.get("ms", 0), self.skipped)
        self.pending, self.inside, self.skipped = [], False, 0
        return done

    def _query(self, event: dict) -> Batch | None:
        sql = event["sql"].strip().rstrip(";")
        word = sql.split(None, 1)[0].upper() if sql else ""
        if word == "BEGIN":
            if self.pending:
                raise ValueError("a transaction begins inside another")
            self.inside = True
            return None
        if word == "COMMIT":
            return self._xid(event)
        if word == "ROLLBACK" and " TO " not in sql.upper():
            self.pending, self.inside = [], False
            return None
        if is_table_ddl(sql):
            if self.pending:
                raise ValueError("DDL inside a transaction with rows")
            return Batch(ddl=(sql, event.get("schema")), position=dict(self.position) if self.position.get("file") else None, commit_ms=event.get("ms", 0))
        return None
