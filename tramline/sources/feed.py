"""Binary feed snapshots: a reader of the protocol's wire format, and a writer for tests.

The tables list the tags that the analytics read (fixed values of the public feed protocol). Other fields are skipped;
absent ones stay NULL, as a protocol default isn't a report; a missing required one is an error.
"""

from __future__ import annotations

import struct as packing
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.schemas import ENTITY


class Field(NamedTuple):
    name: str
    kind: str | dict
    required: bool = False
    repeated: bool = False


STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
RELATIONSHIP = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED", 8: "NEW"}
TRIP = {1: Field("trip_id", "string"), 5: Field("route_id", "string"), 4: Field("schedule_relationship", RELATIONSHIP)}
VEHICLE_NAME = {1: Field("id", "string"), 2: Field("label", "string")}
POSITION = {1: Field("latitude", "float", True), 2: Field("longitude", "float", True), 3: Field("bearing", "float"), 5: Field("speed", "float")}
VEHICLE = {
    1: Field("trip", {"message": TRIP}),
    8: Field("vehicle", {"message": VEHICLE_NAME}),
    2: Field("position", {"message": POSITION}),
    3: Field("current_stop_sequence", "uint"),
    7: Field("stop_id", "string"),
    4: Field("current_status", STATUS),
    5: Field("timestamp", "uint_text"),
}
STOP_RELATIONSHIP = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}
STOP_EVENT = {1: Field("delay", "int"), 2: Field("time", "int_text"), 3: Field("uncertainty", "int")}
STOP_UPDATE = {
    1: Field("stop_sequence", "uint"),
    4: Field("stop_id", "string"),
    2: Field("arrival", {"message": STOP_EVENT}),
    3: Field("departure", {"message": STOP_EVENT}),
    5: Field("schedule_relationship", STOP_RELATIONSHIP),
}
TRIP_UPDATE = {
    1: Field("trip", {"message": TRIP}, True),
    3: Field("vehicle", {"message": VEHICLE_NAME}),
    2: Field("stop_time_update", {"message": STOP_UPDATE}, repeated=True),
    4: Field("timestamp", "uint_text"),
    5: Field("delay", "int"),
}
HEADER = {1: Field("gtfs_realtime_version", "string", True), 3: Field("timestamp", "uint_text")}
ENTITY_TAGS = {1: Field("id", "string", True), 3: Field("trip_update", {"message": TRIP_UPDATE}), 4: Field("vehicle", {"message": VEHICLE})}
FEED = {1: Field("header", {"message": HEADER}, True), 2: Field("entity", {"message": ENTITY_TAGS}, repeated=True)}
VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5
FLOAT = packing.Struct("<f").unpack_from


class FeedError(ValueError):
    """A snapshot that isn't a feed message."""


#: Whole numbers of the wire format: their bits, and whether they are signed.
WHOLE = {"uint": (32, False), "uint_text": (64, False), "int": (32, True), "int_text": (64, True)}


def varint(data: bytes, at: int, end: int) -> tuple[int, int]:
    """The number at a place, and the place after it. Nearly all have one byte, which callers look at themselves."""
    value = shift = 0
    while True:
        if at >= end or shift > 63:
            raise FeedError("truncated or oversized varint")
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value & (1 << 64) - 1, at


def whole(value: int, kind: str) -> int | str:
    if value < 1 << 31:  # the same in any kind
        return str(value) if kind.endswith("_text") else value
    bits, signed = WHOLE[kind]
    value &= (1 << bits) - 1
    if signed and value >> bits - 1:
        value -= 1 << bits
    return str(value) if kind.endswith("_text") else value


def wire_of(field: Field) -> int:
    if isinstance(field.kind, dict):
        return BYTES if "message" in field.kind else VARINT
    return {"float": FIXED32, "string": BYTES}.get(field.kind, VARINT)


class Layout(NamedTuple):
    """A message's fields by key (tag and wire type), so that one look tells what to do with a value."""

    by_key: dict[int, tuple[str, str, object]]
    tags: dict[int, str]
    required: tuple[str, ...]
    repeated: tuple[str, ...]


def laid_out(fields: dict[int, Field]) -> Layout:
    by_key = {}
    for tag, f in fields.items():
        if not isinstance(f.kind, dict):
            what, more = ("whole", f.kind) if f.kind in WHOLE else (f.kind, None)
        elif "message" in f.kind:
            what, more = "messages" if f.repeated else "message", laid_out(f.kind["message"])
        else:
            what, more = "enum", f.kind
        by_key[tag << 3 | wire_of(f)] = (what, f.name, more)
    of = fields.values()
    return Layout(by_key, {tag: f.name for tag, f in fields.items()}, tuple(f.name for f in of if f.required), tuple(f.name for f in of if f.repeated))


def stepped_over(data: bytes, key: int, at: int, end: int, layout: Layout) -> int:
    """The place after a value that isn't in the layout; a field of another wire type than its own is an error."""
    tag, wire = key >> 3, key & 7
    if tag == 0:
        raise FeedError("tag 0")
    if tag in layout.tags:
        raise FeedError(f"{layout.tags[tag]}: wire type {wire}")
    if wire == VARINT:
        return varint(data, at, end)[1]
    if wire == BYTES:
        size, at = varint(data, at, end)
        return at + size
    if wire in (FIXED64, FIXED32):
        return at + (8 if wire == FIXED64 else 4)
    raise FeedError(f"wire type {wire}")


def message(data: bytes, layout: Layout, at: int, end: int) -> dict:
    """The fields of the message in data[at:end]. Nothing is copied but strings; what isn't in the layout is stepped over."""
    out: dict = {name: [] for name in layout.repeated}
    by_key = layout.by_key
    while at < end:
        key = data[at]
        if key < 0x80:
            at += 1
        else:
            key, at = varint(data, at, end)
        entry = by_key.get(key)
        if entry is None:
            at = stepped_over(data, key, at, end, layout)
            if at > end:
                raise FeedError("truncated field")
            continue
        what, name, more = entry
        if what == "float":
            after = at + 4
            if after > end:
                raise FeedError("truncated field")
            out[name] = FLOAT(data, at)[0]
            at = after
            continue
        if at < end and data[at] < 0x80:  # a size or a number of one byte, as nearly all are
            value, at = data[at], at + 1
        else:
            value, at = varint(data, at, end)
        if what == "whole":
            out[name] = whole(value, more)
            continue
        if what == "enum":
            if value in more:  # an unknown value counts as absent
                out[name] = more[value]
            continue
        after = at + value
        if after > end:
            raise FeedError("truncated field")
        if what == "string":
            try:
                out[name] = data[at:after].decode()
            except UnicodeDecodeError as e:
                raise FeedError(f"{name}: not UTF-8") from e
        elif what == "message":
            out[name] = message(data, more, at, after)
        else:
            out[name].append(message(data, more, at, after))
        at = after
    for name in layout.required:
        if name not in out:
            raise FeedError(f"missing {name}")
    return out


FEED_LAYOUT = laid_out(FEED)


def decode_feed(data: bytes) -> list[dict]:
    """The entities of a snapshot; FeedError for garbage and for no bytes."""
    data = bytes(data)
    return message(data, FEED_LAYOUT, 0, len(data))["entity"]


def encode(value: dict, fields: dict[int, Field] = FEED) -> bytes:
    """The wire form of a message in the shape that `message` gives."""

    def number(n: int) -> bytes:
        out = bytearray()
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes([*out, n])

    def framed(tag: int, body: bytes) -> bytes:
        return number(tag << 3 | BYTES) + number(len(body)) + body

    out = b""
    for tag, field in fields.items():
        found = value.get(field.name)
        for x in found if field.repeated else [] if found is None else [found]:
            if field.kind == "float":
                out += number(tag << 3 | FIXED32) + packing.pack("<f", x)
            elif field.kind == "string":
                out += framed(tag, x.encode())
            elif isinstance(field.kind, str):
                out += number(tag << 3 | VARINT) + number(int(x) & (1 << 64) - 1)
            elif "message" in field.kind:
                out += framed(tag, encode(x, field.kind["message"]))
            else:
                out += number(tag << 3 | VARINT) + number({v: k for k, v in field.kind.items()}[x])
    return out


def entities(snapshots: DataFrame, column: str = "content") -> DataFrame:
    """One row for each entity of each snapshot (binary column); a snapshot without entities gives none."""

    def decode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"entities": [decode_feed(x if x is not None else b"") for x in batch[column]]})

    found = snapshots.select(column).mapInPandas(decode, T.StructType([T.StructField("entities", T.ArrayType(ENTITY))]))
    return found.select(F.explode("entities").alias("entity")).select("entity.*")


def snapshot_files(spark, path: str) -> DataFrame:
    """Landed snapshot files, as (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").load(path)
