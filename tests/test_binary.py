"""Readers of binary formats against files written by hand, and round trips."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroad.sources import binary as B
from tallyroad.sources import readers


def number(n: int) -> bytes:
    out = b""
    while n >= 128:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def zigzag(values) -> bytes:
    steps = np.diff(np.array(values, np.int64), prepend=0)
    return b"".join(number(int((s << 1) ^ (s >> 63)) & (1 << 64) - 1) for s in steps)


def field(n: int, value) -> bytes:
    return number(n << 3) + number(value) if isinstance(value, int) else number(n << 3 | 2) + number(len(value)) + value


def blob(kind: bytes, payload: bytes, packed: bool = True) -> bytes:
    body = field(2, len(payload)) + field(3, zlib.compress(payload)) if packed else field(1, payload)
    header = field(1, kind) + field(3, len(body))
    return struct.pack(">I", len(header)) + header + body


def extract() -> bytes:
    strings = [b"", b"highway", b"path", b"name", "Chemin né".encode(), b"type", b"route", b"bicycle", b"forward"]
    table = field(1, b"".join(field(1, s) for s in strings))
    packed = lambda *v: b"".join(map(number, v))
    dense = field(1, zigzag([7, 5, 2**40])) + field(8, zigzag([488_000_000, -10, 0])) + field(9, zigzag([23_000_000, -1_800_000_000, 5])) + field(10, packed(1, 2, 3, 4, 0, 0, 0))
    one = field(1, (9 << 1)) + field(8, 100 << 1) + field(9, (50 << 1) - 1)
    way = field(1, 70) + field(2, packed(1, 3)) + field(3, packed(2, 4)) + field(8, zigzag([7, 2**40, 5]))
    relation = field(1, 80) + field(2, packed(5, 6)) + field(3, packed(6, 7)) + field(8, packed(8, 0)) + field(9, zigzag([70, 9])) + field(10, packed(1, 0))
    nodes = table + field(2, field(2, dense)) + field(2, field(1, one)) + field(17, 100) + field(19, 1000)
    rest = table + field(2, field(3, way)) + field(2, field(4, relation))
    return blob(b"OSMHeader", b"anything") + blob(b"OSMData", nodes) + blob(b"OSMData", rest, packed=False)


def test_packed_extract(spark, tmp_path):
    (tmp_path / "a.osm.pbf").write_bytes(extract())
    found = B.osm_pbf(spark, str(tmp_path / "a.osm.pbf"))
    nodes = {r["node"]: (r["lat"], r["lon"], r["tags"]) for r in found["nodes"].collect()}
    assert nodes[7] == (pytest.approx(48.800001), pytest.approx(2.3), {"highway": "path", "name": "Chemin né"})
    assert nodes[5] == (pytest.approx(0.0), pytest.approx(-180.0), {}) and nodes[2**40][2] == {}
    assert nodes[9][0] == pytest.approx((100 * 100 + 1000) / 1e9) and nodes[9][1] == pytest.approx(-50 * 100 / 1e9)
    ways = found["ways"].collect()
    assert [(r["way"], r["refs"], r["tags"]) for r in ways] == [(70, [7, 2**40, 5], {"highway": "path", "name": "Chemin né"})]
    relation = found["relations"].first()
    assert relation["tags"] == {"type": "route", "route": "bicycle"} and [tuple(m) for m in relation["member"]] == [("way", 70, "forward"), ("node", 9, "")]
    assert [tuple(r) for r in readers.route_members(found["relations"]).collect()] == [(70, None)]
    lines = readers.lines_from_nodes(found["ways"], found["nodes"]).first()
    assert len(lines["points"]) == 3 and lines["points"][0]["lat"] == pytest.approx(48.800001)


def test_varints():
    values = [0, 1, 127, 128, 300, 2**35, 2**63 + 5]
    assert B.varints(b"".join(map(number, values))).tolist() == values and len(B.varints(b"")) == 0
    assert B.signed(np.array([0, 1, 2, 3, 2**64 - 1], np.uint64)).tolist() == [0, -1, 1, -2, -(2**63)]


def test_geopackage_round_trip(spark, tmp_path):
    rows = [(1, "Loire", 2.5, readers.to_wkb_line([(0.0, 1.0), (2.0, 3.0)])), (2, None, None, None), (3, 'a "quoted" name', -1.0, readers.to_wkb_line([(5.0, 5.0), (6.0, 6.0), (7.0, 5.0)]))]
    B.write_geopackage(spark.createDataFrame(rows, "code long, name string, width double, geometry binary"), str(tmp_path / "w.gpkg"), "water lines")
    got = B.geopackage(spark, str(tmp_path / "w.gpkg"), "water lines", {"code": "long", "name": "string", "width": "double"}).orderBy("code").collect()
    assert [(r["code"], r["name"], r["width"]) for r in got] == [r[:3] for r in rows]
    assert [[(p["x"], p["y"]) for p in line] for line in got[2]["parts"]] == [[(5.0, 5.0), (6.0, 6.0), (7.0, 5.0)]] and got[1]["parts"] is None
    with pytest.raises(Exception, match="no layer other"):
        B.geopackage(spark, str(tmp_path / "w.gpkg"), "other", {"code": "long"}).collect()


def test_geopackage_envelope():
    wkb = readers.to_wkb_line([(1.0, 2.0)])
    for kind, size in enumerate((0, 32, 48, 48, 64)):
        assert B._plain_wkb(b"GP\x00" + bytes([1 | kind << 1]) + struct.pack("<i", 4326) + b"\0" * size + wkb) == wkb


def test_packed_records():
    value = {"a": [1, -1, -33, 128, 2**40, 2**63 + 1, 1.5, None, True, False], "b" * 40: {"x": b"\x00\xff" * 200, "long": "é" * 40_000}, "many": list(range(70_000)), "map": {str(i): i for i in range(20)}}
    assert B.unpack(B.pack(value)) == value
    assert B.unpack(b"\xca\x3f\xc0\x00\x00") == 1.5 and B.unpack(b"\xcd\x01\x00") == 256 and B.unpack(b"\xd1\xff\x00") == -256


def test_packed_series_round_trip(spark, tmp_path):
    rows = [(1, 2020, [0.0, None, 655.34]), (1, 2021, []), (2, 2020, [12.34])]
    df = spark.createDataFrame(rows, "site long, year int, values array<double>")
    B.write_packed_series(df, str(tmp_path / "s.msgpack"))
    assert sorted(map(tuple, B.packed_series(spark, str(tmp_path / "s.msgpack")).collect())) == rows
    for bad in ([655.35], [-1.0]):
        with pytest.raises(ValueError, match="16 bits"):
            B.write_packed_series(spark.createDataFrame([(1, 2020, bad)], df.schema), str(tmp_path / "bad"))


def tile(values: np.ndarray, x: float, y: float, cell: float, nodata: str, packed: bool, order: str = "<") -> bytes:
    """A one-band raster file in strips of two rows."""
    values = values.astype(values.dtype.newbyteorder(order))
    strips = [values[k : k + 2].tobytes() for k in range(0, len(values), 2)]
    strips = [zlib.compress(s) for s in strips] if packed else strips
    text, many = nodata.encode() + b"\0", len(strips)
    kind = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    offsets = [8 + sum(map(len, strips[:k])) for k in range(many)]
    body = b"".join(strips)
    extra_at = 8 + len(body)
    arrays = {273: (4, struct.pack(f"{order}{many}I", *offsets), many), 279: (4, struct.pack(f"{order}{many}I", *map(len, strips)), many), 33550: (12, struct.pack(f"{order}3d", cell, cell, 0), 3), 33922: (12, struct.pack(f"{order}6d", 0, 0, 0, x, y, 0), 6), 42113: (2, text, len(text))}
    shorts = {256: values.shape[1], 257: values.shape[0], 258: values.dtype.itemsize * 8, 259: 8 if packed else 1, 277: 1, 278: 2, 339: kind}
    entries, extra = [], b""
    for tag in sorted({**arrays, **shorts}):
        if tag in shorts:
            entries.append(struct.pack(f"{order}HHIHH", tag, 3, 1, shorts[tag], 0))
            continue
        form, raw, n = arrays[tag]
        if len(raw) <= 4:
            entries.append(struct.pack(f"{order}HHI", tag, form, n) + raw.ljust(4, b"\0"))
        else:
            entries.append(struct.pack(f"{order}HHII", tag, form, n, extra_at + len(extra)))
            extra += raw
    ifd = struct.pack(f"{order}H", len(entries)) + b"".join(entries) + b"\0" * 4
    return {"<": b"II", ">": b"MM"}[order] + struct.pack(f"{order}HI", 42, extra_at + len(extra)) + body + extra + ifd


def test_raster_mosaic(spark, tmp_path):
    """Tiles of several kinds make one table of cells, in which points are looked up; no-data is null."""
    a = np.arange(12, dtype="i2").reshape(3, 4)
    a[0, 0] = -9999
    b = np.arange(12, dtype="f4").reshape(3, 4) + 100.5
    (tmp_path / "a.tif").write_bytes(tile(a, 0.0, 30.0, 10.0, "-9999", False))
    (tmp_path / "b.tif").write_bytes(tile(b, 40.0, 30.0, 10.0, "nan", True, ">"))
    cells = B.raster_cells(spark, str(tmp_path / "*.tif"))
    got = {(r["x"], r["y"]): r["value"] for r in cells.collect()}
    assert len(got) == 24 and got[5.0, 25.0] is None and got[15.0, 25.0] == 1.0 and got[35.0, 5.0] == 11.0
    assert got[45.0, 25.0] == 100.5 and got[75.0, 5.0] == 111.5
    from tallyroad.operators import spatial

    grid = cells.select(F.floor(F.col("x") / 10).cast("int").alias("i"), F.floor(F.col("y") / 10).cast("int").alias("j"), "value")
    points = spark.createDataFrame([(1, 12.0, 27.0), (2, 48.0, 21.0), (3, 500.0, 0.0)], "id long, x double, y double")
    assert {r["id"]: r["value"] for r in spatial.sample_cells(points, grid, 10.0).collect()} == {1: 1.0, 2: 100.5, 3: None}
    with pytest.raises(ValueError, match="compression"):
        B.read_tile(tile(a, 0, 0, 1, "0", False).replace(struct.pack("<HHIHH", 259, 3, 1, 1, 0), struct.pack("<HHIHH", 259, 3, 1, 5, 0)))
