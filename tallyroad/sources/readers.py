"""Sources with declared schemas; Arrow readers where Spark has no format of its own."""

from __future__ import annotations

import json
import re
import struct
import urllib.request
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Parquet with a declared schema and only the columns asked for."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def csv(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Comma- or semicolon-separated text with a header; codes stay text because the schema says so, a byte-order mark is dropped."""
    df = spark.read.option("header", True).option("sep", separator).option("encoding", "UTF-8").schema(schema).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features with their properties as a map and geometry as JSON text, one row each."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    return spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode("features").alias("f")).select("f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def json_file(path: str) -> dict:
    """A small side file: configuration, vocabulary or run record."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _sheet_rows(content: bytes, sheet: str | int) -> Iterator[list[str | None]]:
    """Rows of one sheet of a workbook as text cells, read with the standard library alone."""
    import io

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)] if "xl/sharedStrings.xml" in z.namelist() else []
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet")]
        number = (names.index(sheet) if isinstance(sheet, str) else sheet) + 1
        with z.open(f"xl/worksheets/sheet{number}.xml") as f:
            for _, row in ElementTree.iterparse(f):
                if not row.tag.endswith("}row"):
                    continue
                out: list[str | None] = []
                for c in row.findall("m:c", _NS):
                    letters = "".join(x for x in c.get("r", "") if x.isalpha())
                    at = 0
                    for x in letters:
                        at = at * 26 + ord(x) - 64
                    out += [None] * (at - 1 - len(out)) if at else []
                    v, inline = c.find("m:v", _NS), c.find("m:is/m:t", _NS)
                    text = inline.text if inline is not None else v.text if v is not None else None
                    out.append(strings[int(text)] if c.get("t") == "s" and text is not None else text)
                row.clear()
                yield out


def excel(spark: SparkSession, path: str, columns: list[str], sheet: str | int = 0, header: int = 0) -> DataFrame:
    """Named columns of one sheet as text: header offset, missing cells null. One file is read by one task."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = _sheet_rows(content, sheet)
                for _ in range(header):
                    next(rows, None)
                names = next(rows, [])
                at = [names.index(c) for c in columns]
                block: list[list[str | None]] = []
                for row in rows:
                    block.append([row[i] if i < len(row) else None for i in at])
                    if len(block) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*block, strict=True)], names=columns)
                        block = []
                if block:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*block, strict=True)], names=columns)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ", ".join(f"`{c}` string" for c in columns))


def counter_workbook(spark: SparkSession, path: str, year: int) -> DataFrame:
    """Very wide hourly sheet (three header rows: site, flow, name; first column the hour) as long rows, hour by position."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = _sheet_rows(content, 0)
                sites, flows, names = (next(rows, [])[1:] for _ in range(3))
                for hour, row in enumerate(rows):
                    cells = row[1 : len(sites) + 1] + [None] * (len(sites) - len(row) + 1)
                    yield pa.RecordBatch.from_pydict({
                        "site": pa.array([int(float(s)) for s in sites], pa.int64()), "flow": pa.array([int(float(s)) for s in flows], pa.int64()), "flow_name": pa.array(names + [None] * (len(sites) - len(names)), pa.string()),
                        "hour_idx": pa.array([hour] * len(sites), pa.int32()), "value": pa.array([float(x) if x not in (None, "") else None for x in cells[: len(sites)]], pa.float64()),
                    })

    df = spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "site long, flow long, flow_name string, hour_idx int, value double")
    return df.withColumn("year", F.lit(year))


# ---- geometry and map extracts


def wkb_points(raw: bytes) -> list[list[tuple[float, float]]]:
    """Rings or lines of a well-known-binary geometry (line, polygon and their collections)."""
    out: list[list[tuple[float, float]]] = []

    def one(at: int) -> int:
        order = "<" if raw[at] == 1 else ">"
        kind = struct.unpack_from(order + "I", raw, at + 1)[0] % 1000
        at += 5
        if kind == 1:
            out.append([struct.unpack_from(order + "2d", raw, at)])
            return at + 16
        if kind == 2:
            n = struct.unpack_from(order + "I", raw, at)[0]
            out.append([struct.unpack_from(order + "2d", raw, at + 4 + 16 * i) for i in range(n)])
            return at + 4 + 16 * n
        n = struct.unpack_from(order + "I", raw, at)[0]
        at += 4
        for _ in range(n):
            if kind == 3:
                k = struct.unpack_from(order + "I", raw, at)[0]
                out.append([struct.unpack_from(order + "2d", raw, at + 4 + 16 * i) for i in range(k)])
                at += 4 + 16 * k
            else:
                at = one(at)
        return at

    one(0)
    return out


def to_wkb_line(points: list[tuple[float, float]]) -> bytes:
    return struct.pack("<BII", 1, 2, len(points)) + b"".join(struct.pack("<2d", x, y) for x, y in points)


def decode_wkb(df: DataFrame, column: str = "geometry") -> DataFrame:
    """Binary geometry column to ``parts``: an array of arrays of (x, y)."""
    schema = T.StructType([*df.schema.fields, T.StructField("parts", T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))))])

    def run(batches):
        kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
        for batch in batches:
            raw = batch.column(batch.schema.names.index(column)).to_pylist()
            parts = [None if r is None else [[{"x": x, "y": y} for x, y in p] for p in wkb_points(r)] for r in raw]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, kind)], names=[*batch.schema.names, "parts"])

    return df.mapInArrow(run, schema)


def lines_from_nodes(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(way, points) in order from ways' node references and nodes' positions; missing nodes are skipped, lines under two points dropped.

    ``ways``: way, refs; ``nodes``: node, lon, lat. The positions join on the node, so only referenced nodes are read.
    """
    refs = ways.select("way", F.posexplode("refs").alias("pos", "node"))
    placed = refs.join(nodes, "node").groupBy("way").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))), lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("points"))
    return placed.where(F.size("points") >= 2)


def osm_xml(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Nodes, ways and relations of a plain XML map extract (Spark's XML source, one scan a kind)."""
    tag = "tag array<struct<_k:string,_v:string>>"
    tags = lambda: F.map_from_entries(F.transform(F.coalesce("tag", F.expr("cast(array() as array<struct<_k:string,_v:string>>)")), lambda t: F.struct(t["_k"], t["_v"]))).alias("tags")
    read = lambda row, schema: spark.read.format("xml").option("rowTag", row).schema(schema).load(path)
    return {
        "nodes": read("node", f"_id long, _lat double, _lon double, {tag}").select(F.col("_id").alias("node"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), tags()),
        "ways": read("way", f"_id long, nd array<struct<_ref:long>>, {tag}").select(F.col("_id").alias("way"), F.col("nd._ref").alias("refs"), tags()),
        "relations": read("relation", f"_id long, member array<struct<_type:string,_ref:long,_role:string>>, {tag}").select(F.col("_id").alias("relation"), "member", tags()),
    }


def route_members(relations: DataFrame) -> DataFrame:
    """(way, network) members of cycle-route relations."""
    return relations.where("tags['type'] = 'route' and tags['route'] = 'bicycle'").select(F.explode("member").alias("m"), F.element_at("tags", F.lit("network")).alias("network")).where("m._type = 'way'").select(F.col("m._ref").alias("way"), "network")


def export(spark: SparkSession, path: str) -> DataFrame:
    """Network export by suffix: Parquet with binary geometry or GeoJSON; rows without a line are dropped."""
    if path.endswith(".parquet"):
        return decode_wkb(parquet(spark, path)).where(F.size("parts") > 0)
    if path.endswith((".geojson", ".json")):
        return geojson(spark, path).where(F.col("kind").isin("LineString", "MultiLineString") & F.col("coordinates").isNotNull())
    raise ValueError(f"unknown export format: {path}")


def lengths_with_fallback(fresh: DataFrame | None, reference: DataFrame, fresh_years: tuple[int, ...], always_reference: str = "PARTIAL") -> DataFrame:
    """Fresh rows for the years that have them, reference rows for all others and always for one scenario."""
    if fresh is None or not fresh_years:
        return reference
    old = reference.where(~F.col("year").isin(*fresh_years) | (F.col("scenario") == always_reference))
    return old.unionByName(fresh.where(F.col("year").isin(*fresh_years) & (F.col("scenario") != always_reference)))


def download(url: str, target: str, attempts: int = 6) -> Path:
    """Resumable download on the driver: continues a .part file by byte ranges and renames it when whole."""
    path, part = Path(target), Path(f"{target}.part")
    if path.exists():
        return path
    for attempt in range(attempts):
        have = part.stat().st_size if part.exists() else 0
        try:
            request = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})  # noqa: S310
            with urllib.request.urlopen(request, timeout=60) as r, part.open("ab" if r.status == 206 else "wb") as out:  # noqa: S310
                while block := r.read(1 << 20):
                    out.write(block)
            part.rename(path)
            return path
        except OSError:
            if attempt + 1 == attempts:
                raise
    raise AssertionError


def dated_snapshot(template: str, date: str, folder: str) -> Path:
    """Path of the extract of a day (YYMMDD) whose address is ``template`` with the date in place of {date}; fetched, resumably, unless it is there."""
    if not re.fullmatch(r"\d{6}", date):
        raise ValueError(f"a snapshot's date has six digits, YYMMDD: {date}")
    url = template.format(date=date)
    Path(folder).mkdir(parents=True, exist_ok=True)
    return download(url, str(Path(folder, url.rsplit("/", 1)[-1])))
