"""Encoded grid files: messages of edition 1, on a regular lat x lon grid with simple packing.

``grid_messages`` reads files with Spark's ``binaryFile`` source and gives one row per message;
``grid_rows`` turns messages into one row per grid point. A message is sections 1 (product), 2 (grid), 3
(optional bit map) and 4 (packed values) between the marks ``GRIB`` and ``7777``; whole numbers are
big-endian, negative ones have their highest bit set. A value is (R + X * 2^E) / 10^D with the packed
whole number X; a point that the bit map leaves out is null.

A message that cannot be read is kept as a row with a ``reason`` and no values; the bytes behind a
broken length are not searched further. Bytes between messages are skipped; files of no bytes are not listed by the source. A file is one row of Spark and must
fit in a task (at most 2 GB); messages of a file are decoded one after another, and the points of one message are
its two lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = (
    "path string, message int, parameter int, level_type int, level int, base_time timestamp, valid_time timestamp, "
    "step_hours double, latitude array<double>, longitude array<double>, value array<double>, reason string"
)
# Marks of a message, hours of the units of time by code, bits of the flag octets.
START, END = b"GRIB", b"7777"
UNIT_HOURS = {0: 1 / 60, 1: 1.0, 2: 24.0, 10: 3.0, 11: 6.0, 12: 12.0}
HAS_GRID, HAS_BITMAP = 0x80, 0x40
MINUS_I, PLUS_J, J_FIRST = 0x80, 0x40, 0x20
REGULAR_GRID = 0


class Unreadable(ValueError):
    """Why a message could not be decoded."""


def whole(body: bytes, first: int, size: int) -> int:
    """An unsigned number whose octets begin at ``first`` (counted from 1, as the format does)."""
    if first + size - 1 > len(body):
        raise Unreadable("section too short")
    return int.from_bytes(body[first - 1 : first - 1 + size], "big")


def signed(body: bytes, first: int, size: int) -> int:
    raw, top = whole(body, first, size), 1 << (8 * size - 1)
    return top - raw if raw & top else raw


def reference(body: bytes, first: int) -> float:
    """A base-16 float: sign, exponent above 64, 24 bits of fraction."""
    raw = whole(body, first, 4)
    size = (raw & 0xFFFFFF) * 2.0 ** (4 * ((raw >> 24 & 0x7F) - 64) - 24)
    return -size if raw >> 31 else size


def unpacked(body: bytes, bits: int, count: int) -> np.ndarray:
    """``count`` unsigned numbers of ``bits`` bits each, packed without gaps."""
    if bits == 0:
        return np.zeros(count)
    if len(body) * 8 < bits * count:
        raise Unreadable("fewer packed values than points")
    flat = np.unpackbits(np.frombuffer(body, np.uint8), count=bits * count).reshape(count, bits)
    return flat @ (2.0 ** np.arange(bits - 1, -1, -1))


def axes(grid: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(latitudes, longitudes, scanning mode) of a regular grid in degrees, in scanning order."""
    if whole(grid, 6, 1) != REGULAR_GRID:
        raise Unreadable("grid is not regular")
    columns, rows = whole(grid, 7, 2), whole(grid, 9, 2)
    if 0xFFFF in (columns, rows):
        raise Unreadable("grid is thinned")
    north, west = signed(grid, 11, 3) / 1000, signed(grid, 14, 3) / 1000
    south, east = signed(grid, 18, 3) / 1000, signed(grid, 21, 3) / 1000
    mode = whole(grid, 28, 1)
    # a grid that crosses the date line goes on above 180 (below -180 westward)
    if not mode & MINUS_I and east < west:
        east += 360
    if mode & MINUS_I and east > west:
        east -= 360
    return np.linspace(north, south, rows), np.linspace(west, east, columns), mode


def decoded(body: bytes) -> dict:
    """The fields of one whole message."""
    if body[7] != 1:
        raise Unreadable(f"edition {body[7]}")
    at = 8

    def section(least: int) -> bytes:
        nonlocal at
        size = int.from_bytes(body[at : at + 3], "big")
        if size < least or at + size > len(body) - len(END):
            raise Unreadable("section too short or beyond the message")
        at += size
        return body[at - size : at]

    product = section(28)
    flags = whole(product, 8, 1)
    if not flags & HAS_GRID:
        raise Unreadable("no grid in the message")
    latitude, longitude, mode = axes(section(28))
    points = len(latitude) * len(longitude)
    present = np.ones(points, bool)
    if flags & HAS_BITMAP:
        bitmap = section(6)
        if whole(bitmap, 5, 2):
            raise Unreadable("bit map of a catalogue")
        if (len(bitmap) - 6) * 8 < points:
            raise Unreadable("fewer bits in the bit map than points")
        present = np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=6), count=points).astype(bool)
    data = section(11)
    if data[3] & 0xF0:
        raise Unreadable("packing is not simple")
    two, ten = signed(data, 5, 2), signed(product, 27, 2)
    value = np.full(points, np.nan)
    packed = unpacked(data[11:], whole(data, 11, 1), int(present.sum()))
    value[present] = (reference(data, 7) + packed * 2.0**two) / 10.0**ten
    shape = (len(longitude), len(latitude)) if mode & J_FIRST else (len(latitude), len(longitude))
    field = value.reshape(shape)
    field = field.T if mode & J_FIRST else field

    unit, kind = whole(product, 18, 1), whole(product, 21, 1)
    if unit not in UNIT_HOURS:
        raise Unreadable(f"unit of time {unit}")
    # kind 10 has its period in two octets; ranges, means and sums hold at the end of theirs
    period = whole(product, 19, 2) if kind == 10 else whole(product, 20, 1) if kind in (2, 3, 4, 5) else whole(product, 19, 1)
    hours = 0.0 if kind == 1 else period * UNIT_HOURS[unit]
    century, year = whole(product, 25, 1), whole(product, 13, 1)
    try:
        month, day, hour, minute = (whole(product, octet, 1) for octet in (14, 15, 16, 17))
        base = pd.Timestamp(year=(century - 1) * 100 + year, month=month, day=day, hour=hour, minute=minute)
    except ValueError as e:
        raise Unreadable("no such time") from e
    wrapped = np.where(longitude > 180, longitude - 360, np.where(longitude < -180, longitude + 360, longitude))
    return {
        "parameter": whole(product, 9, 1),
        "level_type": whole(product, 10, 1),
        "level": whole(product, 11, 2),
        "base_time": base,
        "valid_time": base + pd.Timedelta(hours=hours),
        "step_hours": hours,
        "latitude": np.repeat(latitude, len(longitude)),
        "longitude": np.tile(wrapped, len(latitude)),
        "value": [None if np.isnan(x) else float(x) for x in field.ravel()],
        "reason": None,
    }


def messages(body: bytes) -> Iterator[dict]:
    """Every message of a file in its order; a broken one has a reason."""
    at = body.find(START)
    if at < 0:
        yield {"reason": "no message in the file"}
    while at >= 0:
        size = int.from_bytes(body[at + 4 : at + 7], "big")
        if at + 8 > len(body) or size < 8 + len(END) or at + size > len(body):
            yield {"reason": "message is cut off"}
            return
        one = body[at : at + size]
        if one[-len(END) :] != END:
            yield {"reason": "message has no end mark"}
            return
        try:
            yield decoded(one)
        except Unreadable as e:
            yield {"reason": str(e)}
        at = body.find(START, at + size)


def decode_messages(files: DataFrame) -> DataFrame:
    """Messages of files that were read as (path, content)."""
    names = [field.split()[0] for field in MESSAGE_SCHEMA.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                for n, fields in enumerate(messages(bytes(content or b""))):
                    row = pd.DataFrame([{**dict.fromkeys(names), **fields, "path": path, "message": n}], columns=names)
                    for c in ("base_time", "valid_time"):
                        row[c] = pd.to_datetime(row[c])
                    yield row

    return files.select("path", "content").mapInPandas(run, MESSAGE_SCHEMA)


def grid_messages(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row for each message of the files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return decode_messages(files.load(folder))


def grid_rows(decoded_messages: DataFrame, name: str = "value", parameter: int | None = None) -> DataFrame:
    """(path, message, level, valid_time, step_hours, lat, lon, ``name``) per point with a value.

    ``parameter`` keeps the messages of one parameter; messages with a reason have no points.
    """
    kept = decoded_messages.where(F.col("reason").isNull())
    if parameter is not None:
        kept = kept.where(F.col("parameter") == parameter)
    point = F.explode(F.arrays_zip("latitude", "longitude", "value"))
    cells = kept.select("path", "message", "level", "valid_time", "step_hours", point.alias("_point"))
    return cells.select(
        "path", "message", "level", "valid_time", "step_hours",
        F.col("_point.latitude").alias("lat"), F.col("_point.longitude").alias("lon"), F.col("_point.value").alias(name),
    ).where(F.col(name).isNotNull())
