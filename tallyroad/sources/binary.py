"""Binary formats without a Spark source: packed map extracts, geometry packages, packed nested records and raster tiles.

Files are read as one row each by Spark's binary source, so any store it reaches will do, and taken apart by Arrow
functions on the executors; a file may hold two gigabytes at most, larger data lies in several files.
"""

from __future__ import annotations

import sqlite3
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyroad.sources.readers import wkb_points

LINE_TYPE = "array<array<struct<x:double,y:double>>>"
_PARTS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def write_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one file from the driver to any store that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        for low in range(0, len(content), 1 << 22):
            out.write(bytearray(content[low : low + (1 << 22)]))
    finally:
        out.close()


# ---- packed map extracts: length-prefixed blobs of protocol-buffer messages


def varints(raw: bytes) -> np.ndarray:
    """All variable-length integers of a packed field."""
    b = np.frombuffer(raw, np.uint8)
    last = np.flatnonzero(b < 128)
    if not len(last):
        return np.zeros(0, np.uint64)
    first = np.append(0, last[:-1] + 1)
    place = np.arange(last[-1] + 1) - np.repeat(first, last - first + 1)
    return np.add.reduceat((b[: last[-1] + 1] & 127).astype(np.uint64) << (7 * place).astype(np.uint64), first)


def signed(values: np.ndarray) -> np.ndarray:
    """Zigzag numbers: the lowest bit is the sign."""
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields in order."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = raw[at]
            value, shift, at = value | (b & 127) << shift, shift + 7, at + 1
            if b < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files -> the payload of each data blob, still compressed."""
    for batch in batches:
        for content in batch.column(0).to_pylist():
            at = 0
            while at + 4 <= len(content):
                (size,) = struct.unpack_from(">I", content, at)
                header = dict(fields(content[at + 4 : at + 4 + size]))
                at += 4 + size
                if header[1] == b"OSMData":
                    yield pa.RecordBatch.from_pydict({"blob": pa.array([content[at : at + header[3]]], pa.binary())})
                at += header[3]


def _block(blob: bytes) -> tuple[list[str], list[bytes], int, int, int]:
    """Strings, groups, granularity and offsets of a blob's block."""
    parts = dict(fields(blob))
    raw = parts[1] if 1 in parts else zlib.decompress(parts[3])
    strings: list[str] = []
    groups: list[bytes] = []
    step, lat0, lon0 = 100, 0, 0
    for n, v in fields(raw):
        if n == 1:
            strings = [s.decode("utf-8", "replace") for k, s in fields(v) if k == 1]
        elif n == 2:
            groups.append(v)
        elif n == 17:
            step = v
        elif n in (19, 20):
            value = v - (1 << 64) if v >> 63 else v
            lat0, lon0 = (value, lon0) if n == 19 else (lat0, value)
    return strings, groups, step, lat0, lon0


def _tags(strings: list[str], keys: bytes, values: bytes) -> list[tuple[str, str]]:
    return [(strings[k], strings[v]) for k, v in zip(varints(keys).tolist(), varints(values).tolist(), strict=True)]


_TAGS = pa.map_(pa.string(), pa.string())


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            strings, groups, step, lat0, lon0 = _block(blob)
            ids, lats, lons, tags = [], [], [], []
            for group in groups:
                for n, message in fields(group):
                    if n == 1:
                        one = dict(fields(message))
                        sign = lambda v: int(signed(np.array([v], np.uint64))[0])
                        ids.append(sign(one[1]))
                        lats.append(sign(one[8]))
                        lons.append(sign(one[9]))
                        tags.append(_tags(strings, one.get(2, b""), one.get(3, b"")))
                    elif n == 2:
                        dense = dict(fields(message))
                        own = np.cumsum(signed(varints(dense[1])))
                        ids += own.tolist()
                        lats += np.cumsum(signed(varints(dense[8]))).tolist()
                        lons += np.cumsum(signed(varints(dense[9]))).tolist()
                        pairs, node = varints(dense.get(10, b"")).tolist(), []
                        found: list[list[tuple[str, str]]] = []
                        at = 0
                        while at < len(pairs):  # key and value, 0 ends a node
                            if pairs[at] == 0:
                                found.append(node)
                                node, at = [], at + 1
                            else:
                                node.append((strings[pairs[at]], strings[pairs[at + 1]]))
                                at += 2
                        tags += found + [[]] * (len(own) - len(found))
            lat, lon = ((np.array(v, np.int64) * step + offset) / 1e9 for v, offset in ((lats, lat0), (lons, lon0)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lat, pa.float64()), pa.array(lon, pa.float64()), pa.array(tags, _TAGS)], names=["node", "lat", "lon", "tags"])


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            strings, groups, *_ = _block(blob)
            rows = [dict(fields(message)) for group in groups for n, message in fields(group) if n == 3]
            refs = [np.cumsum(signed(varints(r.get(8, b"")))).tolist() for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int64()), pa.array(refs, pa.list_(pa.int64())), pa.array([_tags(strings, r.get(2, b""), r.get(3, b"")) for r in rows], _TAGS)], names=["way", "refs", "tags"])


_MEMBERS = pa.list_(pa.struct([("_type", pa.string()), ("_ref", pa.int64()), ("_role", pa.string())]))


def _relations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = ("node", "way", "relation")
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            strings, groups, *_ = _block(blob)
            rows = [dict(fields(message)) for group in groups for n, message in fields(group) if n == 4]
            members = [[{"_type": kinds[t], "_ref": m, "_role": strings[r]} for r, m, t in zip(varints(x.get(8, b"")).tolist(), np.cumsum(signed(varints(x.get(9, b"")))).tolist(), varints(x.get(10, b"")).tolist(), strict=True)] for x in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int64()), pa.array(members, _MEMBERS), pa.array([_tags(strings, r.get(2, b""), r.get(3, b"")) for r in rows], _TAGS)], names=["relation", "member", "tags"])


def osm_pbf(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Nodes, ways and relations of packed map extracts, with the columns of the XML reader. Blobs are dealt out before they are unpacked."""
    blobs = _files(spark, path).mapInArrow(_blobs, "blob binary").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return {
        "nodes": blobs.mapInArrow(_nodes, "node long, lat double, lon double, tags map<string,string>"),
        "ways": blobs.mapInArrow(_ways, "way long, refs array<long>, tags map<string,string>"),
        "relations": blobs.mapInArrow(_relations, "relation long, member array<struct<_type:string,_ref:long,_role:string>>, tags map<string,string>"),
    }


# ---- geometry packages: a database file with binary geometry


def geopackage(spark: SparkSession, path: str, layer: str, columns: dict[str, str]) -> DataFrame:
    """Columns of a layer (name -> SQL type) and ``parts``, its lines or rings as arrays of (x, y). The file is opened in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                db = sqlite3.connect(":memory:")
                db.deserialize(content)
                quoted = lambda n: '"' + n.replace('"', '""') + '"'
                found = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
                if found is None:
                    raise ValueError(f"no layer {layer}")
                cursor = db.execute(f"SELECT {', '.join([quoted(found[0]), *map(quoted, columns)])} FROM {quoted(layer)}")
                while rows := cursor.fetchmany(4096):
                    parts = [None if r[0] is None else [[{"x": p[0], "y": p[1]} for p in line] for line in wkb_points(_plain_wkb(r[0]))] for r in rows]
                    yield pa.RecordBatch.from_arrays([*[pa.array([r[k + 1] for r in rows], _ARROW[t]) for k, t in enumerate(columns.values())], pa.array(parts, _PARTS)], names=[*columns, "parts"])
                db.close()

    return _files(spark, path).mapInArrow(run, ", ".join([*[f"`{c}` {t}" for c, t in columns.items()], f"parts {LINE_TYPE}"]))


_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
_SQL = {"string": "TEXT", "bigint": "INTEGER", "double": "REAL"}


def _plain_wkb(raw: bytes) -> bytes:
    """Geometry behind a package's header, whose envelope has a kind in bits 1 to 3 of the flags."""
    return raw[8 + (0, 32, 48, 48, 64)[raw[3] >> 1 & 7] :]


def write_geopackage(df: DataFrame, path: str, layer: str, srs: int = 4326, limit: int = 1_000_000) -> None:
    """Write columns and ``geometry`` (binary, well-known) as one layer on the driver; refuses more rows than one such file should hold."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows for one package")
    names = [c for c in df.columns if c != "geometry"]
    kinds = dict(df.dtypes)
    db = sqlite3.connect(":memory:")
    db.executescript(
        """PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"""
    )
    quoted = lambda n: '"' + n.replace('"', '""') + '"'
    db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srs}", srs, srs))
    db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, srs))
    db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, srs))
    db.execute(f"CREATE TABLE {quoted(layer)} (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB, {', '.join(f'{quoted(n)} {_SQL[kinds[n]]}' for n in names)})")
    head = b"GP\x00\x01" + struct.pack("<i", srs)
    db.executemany(f"INSERT INTO {quoted(layer)} (geom, {', '.join(map(quoted, names))}) VALUES ({', '.join('?' * (len(names) + 1))})", [(None if r["geometry"] is None else head + bytes(r["geometry"]), *[r[n] for n in names]) for r in rows])
    db.commit()
    write_file(df.sparkSession, path, db.serialize())
    db.close()


# ---- packed nested records


def unpack(raw: bytes):
    """Value of one packed message: none, booleans, numbers, text, bytes, lists and maps."""

    def take(at: int, form: str):
        return struct.unpack_from(form, raw, at)[0], at + struct.calcsize(form)

    def one(at: int):
        k = raw[at]
        at += 1
        if k < 0x80:
            return k, at
        if k >= 0xE0:
            return k - 256, at
        if k < 0x90:
            return pairs(at, k & 15)
        if k < 0xA0:
            return items(at, k & 15)
        if k < 0xC0:
            return raw[at : at + (k & 31)].decode("utf-8"), at + (k & 31)
        if k in (0xC0, 0xC2, 0xC3):
            return {0xC0: None, 0xC2: False, 0xC3: True}[k], at
        if k in _NUMBERS:
            return take(at, _NUMBERS[k])
        size, at = take(at, {0xC4: ">B", 0xC5: ">H", 0xC6: ">I", 0xD9: ">B", 0xDA: ">H", 0xDB: ">I", 0xDC: ">H", 0xDD: ">I", 0xDE: ">H", 0xDF: ">I"}[k])
        if k <= 0xC6:
            return raw[at : at + size], at + size
        if k <= 0xDB:
            return raw[at : at + size].decode("utf-8"), at + size
        return items(at, size) if k <= 0xDD else pairs(at, size)

    def items(at: int, n: int):
        out = []
        for _ in range(n):
            value, at = one(at)
            out.append(value)
        return out, at

    def pairs(at: int, n: int):
        out = {}
        for _ in range(n):
            key, at = one(at)
            out[key], at = one(at)
        return out, at

    return one(0)[0]


#: Fixed values of the format: codes of numbers and how they are stored.
_NUMBERS = {0xCA: ">f", 0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q", 0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q"}


def pack(value) -> bytes:
    """Packed message of nested Python values."""

    def sized(n: int, short: tuple[int, int] | None, codes: tuple[int | None, int, int]) -> bytes:
        if short and n <= short[1]:
            return bytes([short[0] | n])
        if codes[0] is not None and n < 1 << 8:
            return struct.pack(">BB", codes[0], n)
        return struct.pack(">BH", codes[1], n) if n < 1 << 16 else struct.pack(">BI", codes[2], n)

    if value is None or isinstance(value, bool):
        return bytes([{None: 0xC0, False: 0xC2, True: 0xC3}[value]])
    if isinstance(value, int):
        if -32 <= value < 128:
            return struct.pack("b", value)
        return struct.pack(">Bq", 0xD3, value) if value < 1 << 63 else struct.pack(">BQ", 0xCF, value)
    if isinstance(value, float):
        return struct.pack(">Bd", 0xCB, value)
    if isinstance(value, str):
        raw = value.encode()
        return sized(len(raw), (0xA0, 31), (0xD9, 0xDA, 0xDB)) + raw
    if isinstance(value, (bytes, bytearray)):
        return sized(len(value), None, (0xC4, 0xC5, 0xC6)) + bytes(value)
    if isinstance(value, dict):
        return sized(len(value), (0x80, 15), (None, 0xDE, 0xDF)) + b"".join(pack(k) + pack(v) for k, v in value.items())
    return sized(len(value), (0x90, 15), (None, 0xDC, 0xDD)) + b"".join(map(pack, value))


def packed_series(spark: SparkSession, path: str) -> DataFrame:
    """(site, year, values): packed files of {site: {year: little-endian 16-bit codes}}; a code of 65535 is missing, others are hundredths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                for site, years in unpack(content).items():
                    codes = [np.frombuffer(v, "<u2") for v in years.values()]
                    values = [[None if c == 65535 else c / 100 for c in x.tolist()] for x in codes]
                    yield pa.RecordBatch.from_arrays([pa.array([int(site)] * len(years), pa.int64()), pa.array([int(y) for y in years], pa.int32()), pa.array(values, pa.list_(pa.float64()))], names=["site", "year", "values"])

    return _files(spark, path).mapInArrow(run, "site long, year int, values array<double>")


def write_packed_series(series: DataFrame, path: str, limit: int = 100_000) -> None:
    """Write (site, year, values) as one packed file on the driver, as its readers expect; refuses more site-years than such a file should hold.

    Values that 16 bits can't hold in hundredths are an error.
    """
    rows = series.select("site", "year", "values").orderBy("site", "year").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} site-years for one file")
    held: dict[str, dict[str, bytes]] = {}
    for r in rows:
        codes = np.array([65535 if v is None else round(v * 100) for v in r["values"]], np.int64)
        if any(v is not None and not 0 <= c < 65535 for c, v in zip(codes.tolist(), r["values"], strict=True)):
            raise ValueError(f"site {r['site']} has values that 16 bits can't hold")
        held.setdefault(str(r["site"]), {})[str(r["year"])] = codes.astype("<u2").tobytes()
    write_file(series.sparkSession, path, pack(held))


# ---- raster tiles


def raster_cells(spark: SparkSession, path: str) -> DataFrame:
    """(i, j, x, y, value) of every cell of one-band raster tiles: column, row, centre and value, no-data cells null.

    Tiles are stored in strips, plain or deflated, as integers or floats; several files make a mosaic by their positions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                values, (x0, y0), (dx, dy), nodata = read_tile(content)
                rows, width = max(1, 65536 // max(1, values.shape[1])), values.shape[1]
                for low in range(0, values.shape[0], rows):
                    part = values[low : low + rows].astype(float)
                    j, i = (a.ravel() for a in np.mgrid[low : low + len(part), 0:width])
                    v = part.ravel()
                    missing = ~np.isfinite(v) | (v == nodata if nodata is not None else False)
                    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(x0 + (i + 0.5) * dx), pa.array(y0 - (j + 0.5) * dy), pa.array(v, mask=missing)], names=["i", "j", "x", "y", "value"])

    return _files(spark, path).mapInArrow(run, "i int, j int, x double, y double, value double")


#: Fixed values of the format: sizes and array types of its numbers.
_TAG_TYPES = {1: "u1", 2: "S1", 3: "u2", 4: "u4", 5: "u8", 6: "i1", 8: "i2", 9: "i4", 11: "f4", 12: "f8"}
_SAMPLES = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


def read_tile(raw: bytes) -> tuple[np.ndarray, tuple[float, float], tuple[float, float], float | None]:
    """Values, corner, cell size and no-data value of a one-band raster file."""
    order = {b"II": "<", b"MM": ">"}[raw[:2]]
    (at,) = struct.unpack_from(order + "I", raw, 4)
    (count,) = struct.unpack_from(order + "H", raw, at)
    tags = {}
    for k in range(count):
        tag, kind, n, value = struct.unpack_from(order + "HHII", raw, at + 2 + 12 * k)
        form = np.dtype(order + _TAG_TYPES[kind]) if kind != 2 else np.dtype("S1")
        start = at + 2 + 12 * k + 8 if form.itemsize * n <= 4 else value
        tags[tag] = np.frombuffer(raw, form, n, start)
    width, height = int(tags[256][0]), int(tags[257][0])
    if int(tags.get(277, [1])[0]) != 1 or 322 in tags or int(tags.get(317, [1])[0]) != 1:
        raise ValueError("only one band in plain strips is read")
    packing = int(tags.get(259, [1])[0])
    if packing not in (1, 8, 32946):
        raise ValueError(f"compression {packing} is not read")
    form = np.dtype(order + _SAMPLES[int(tags.get(339, [1])[0]), int(tags[258][0])])
    strips = [raw[o : o + n] for o, n in zip(tags[273].tolist(), tags[279].tolist(), strict=True)]
    data = b"".join(strips if packing == 1 else map(zlib.decompress, strips))
    scale, tie = tags[33550], tags[33922]
    nodata = float(tags[42113].tobytes().rstrip(b"\0")) if 42113 in tags else None
    return np.frombuffer(data, form, width * height).reshape(height, width), (float(tie[3] - tie[0] * scale[0]), float(tie[4] + tie[1] * scale[1])), (float(scale[0]), float(scale[1])), nodata
