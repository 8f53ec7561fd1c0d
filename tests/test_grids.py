"""Encoded grid files: written here by the format's rules, read back, and broken in several ways."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from pluvia.sources.grids import grid_messages, grid_rows, messages, reference, unpacked


def number(value, size):
    return (abs(int(value)) | (1 << (8 * size - 1) if value < 0 else 0)).to_bytes(size, "big")


def base16(value):
    if value == 0:
        return bytes(4)
    sign, size, power = bool(value < 0), abs(float(value)), 64
    while size >= 1:
        size, power = size / 16, power + 1
    while size < 1 / 16:
        size, power = size * 16, power - 1
    return ((sign << 31) | (power << 24) | int(size * 2**24)).to_bytes(4, "big")


def message(field, lat, lon, bits=16, two=0, ten=2, step=6, kind=0, level=850, mode=0, parameter=130, end=b"7777"):
    """One encoded message; a nan of the field is left out by a bit map."""
    rows, columns = field.shape
    scanned = (field.T if mode & 0x20 else field).ravel()
    present = ~np.isnan(scanned)
    low = float(np.nanmin(scanned)) * 10.0**ten if present.any() else 0.0
    stored = reference(base16(np.floor(low)), 1)
    whole = np.rint((scanned[present] * 10.0**ten - stored) / 2.0**two).astype(np.int64)
    packed = np.packbits(((whole[:, None] >> np.arange(bits - 1, -1, -1)) & 1).astype(np.uint8).ravel()).tobytes() if bits else b""
    product = bytearray(28)
    product[0:3] = (28).to_bytes(3, "big")
    product[7], product[8], product[9] = 0x80 | (0 if present.all() else 0x40), parameter, 100
    product[10:12] = level.to_bytes(2, "big")
    product[12:17] = bytes([24, 2, 29, 18, 30])
    product[17], product[18], product[20], product[24] = 1, step, kind, 21
    product[26:28] = number(ten, 2)
    grid = bytearray(32)
    grid[0:3] = (32).to_bytes(3, "big")
    grid[6:8], grid[8:10] = columns.to_bytes(2, "big"), rows.to_bytes(2, "big")
    for at, degrees in ((10, lat[0]), (13, lon[0]), (17, lat[-1]), (20, lon[-1])):
        grid[at : at + 3] = number(round(degrees * 1000), 3)
    grid[27] = mode
    body = bytes(product) + bytes(grid)
    if not present.all():
        held = np.packbits(present.astype(np.uint8)).tobytes()
        body += (6 + len(held)).to_bytes(3, "big") + bytes(3) + held
    body += (11 + len(packed)).to_bytes(3, "big") + bytes(1) + number(two, 2) + base16(np.floor(low)) + bytes([bits]) + packed
    return b"GRIB" + (8 + len(body) + 4).to_bytes(3, "big") + b"\1" + body + end


LAT, LON = np.array([2.5, 0.0, -2.5]), np.array([33.75, 36.25, 38.75, 41.25])


def test_numbers():
    for value in (0.0, 1.0, -118.625, 27315.0, 2.0**-20):
        assert reference(base16(value), 1) == value
    turn = np.random.default_rng(1)
    for bits in (1, 7, 12, 24):
        whole = turn.integers(0, 1 << bits, 41)
        flat = ((whole[:, None] >> np.arange(bits - 1, -1, -1)) & 1).astype(np.uint8).ravel()
        assert unpacked(np.packbits(flat).tobytes(), bits, 41).tolist() == whole.tolist()


@pytest.mark.parametrize("mode", [0, 0x20])
def test_round_trip(spark, tmp_path, mode):
    field = np.round(np.random.default_rng(2).uniform(-20, 45, (3, 4)), 2) + 273.15
    holes = field.copy()
    holes[1, 2] = holes[2, 0] = np.nan
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.grib").write_bytes(message(field, LAT, LON, mode=mode) + b"\0\0" + message(holes, LAT, LON, mode=mode, step=9, level=500))
    (tmp_path / "y.grib").write_bytes(message(field, LAT, LON, mode=mode, parameter=11))
    (tmp_path / "notes.txt").write_text("GRIB is no message here")
    got = grid_messages(spark, str(tmp_path), "*.grib").cache()
    assert got.count() == 3 and got.where("reason is not null").count() == 0
    points = grid_rows(got, "temperature_k", parameter=130).collect()
    assert len(points) == 12 + 10
    for r in points:
        want = (field if r["level"] == 850 else holes)[LAT.tolist().index(r["lat"]), LON.tolist().index(r["lon"])]
        assert abs(r["temperature_k"] - want) < 0.0051
        assert r["valid_time"] == dt.datetime(2024, 2, 29, 18, 30) + dt.timedelta(hours=r["step_hours"])
        assert r["step_hours"] == (6 if r["level"] == 850 else 9)


def test_constant_field_and_date_line(spark, tmp_path):
    lon = np.array([175.0, 180.0, -175.0])
    (tmp_path / "c.grib").write_bytes(message(np.full((3, 3), 7.0), LAT, lon, bits=0, ten=0))
    got = grid_rows(grid_messages(spark, str(tmp_path))).collect()
    assert {r["value"] for r in got} == {7.0} and sorted({r["lon"] for r in got}) == [-175.0, 175.0, 180.0]


def test_broken_files_have_a_reason(spark, tmp_path):
    good = message(np.ones((3, 4)), LAT, LON)
    odd = bytearray(good)
    odd[8 + 28 + 5] = 50
    short = bytearray(good)
    short[8 + 28 + 32 + 10] = 24
    broken = {
        "cut": good + good[:-9],
        "noise": b"no grid at all",
        "end": message(np.ones((3, 4)), LAT, LON, end=b"0000"),
        "kind": bytes(odd) + good,
        "values": bytes(short),
        "edition": good[:7] + b"\2" + good[8:],
        "lengths": good[:8] + b"\xff\xff\xff" + good[11:],
    }
    for name, body in broken.items():
        (tmp_path / f"{name}.grib").write_bytes(body)
    got = grid_messages(spark, str(tmp_path)).cache()
    reasons = {r["path"].rsplit("/")[-1][:-5]: r["reason"] for r in got.where("reason is not null").collect()}
    assert reasons == {
        "cut": "message is cut off", "noise": "no message in the file",
        "end": "message has no end mark", "kind": "grid is not regular", "values": "fewer packed values than points",
        "edition": "edition 2", "lengths": "section too short or beyond the message",
    }
    assert list(messages(b"")) == [{"reason": "no message in the file"}]
    whole = {r["path"].rsplit("/")[-1][:-5]: r["message"] for r in got.where("reason is null").collect()}
    assert whole == {"cut": 0, "kind": 1}
    assert grid_rows(got).count() == 2 * 12
