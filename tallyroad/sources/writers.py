"""Sinks: tables, side files, workbooks, maps, and steps that are skipped when their output exists."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet(df: DataFrame, path: str, codec: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def csv(df: DataFrame, path: str) -> None:
    """Report tables as one file; only for results that are small by their nature."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def json_file(record: dict, path: str) -> None:
    Path(path).write_text(json.dumps(record, ensure_ascii=False, indent=2), encoding="utf-8")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def step(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Build and write a table unless its output is there; always read it back. A write without its success mark is done again."""
    if force or not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        parquet(build(), path)
    return spark.read.parquet(path)


def _column(i: int) -> str:
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


class Workbook:
    """Minimal spreadsheet writer: titles, notes, key figures and tables on named sheets."""

    def __init__(self):
        self.sheets: dict[str, list[list]] = {}

    def title(self, sheet: str, text: str) -> None:
        self.sheets.setdefault(sheet, []).append([text])

    note = title

    def figure(self, sheet: str, name: str, value: float) -> None:
        self.sheets.setdefault(sheet, []).append([name, value])

    def table(self, sheet: str, df: DataFrame, limit: int = 100_000) -> None:
        """Rows of a report table; refuses more than a sheet should hold."""
        rows = df.limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {limit} rows for sheet {sheet}")
        self.sheets.setdefault(sheet, []).append(df.columns)
        self.sheets[sheet] += [list(r) for r in rows] + [[]]

    def bytes(self) -> bytes:
        buffer = io.BytesIO()
        names = list(self.sheets)
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(names)))
            z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
            z.writestr("_rels/.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            z.writestr("xl/workbook.xml", '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{escape(n[:31])}" sheetId="{i + 1}" r:id="r{i + 1}"/>' for i, n in enumerate(names)) + "</sheets></workbook>")
            z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names))) + "</Relationships>")
            for i, n in enumerate(names):
                z.writestr(f"xl/worksheets/sheet{i + 1}.xml", '<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + "".join(self._row(r, row) for r, row in enumerate(self.sheets[n], 1)) + "</sheetData></worksheet>")
        return buffer.getvalue()

    @staticmethod
    def _row(number: int, row: list) -> str:
        cells = []
        for i, v in enumerate(row):
            at = f"{_column(i)}{number}"
            if isinstance(v, bool) or isinstance(v, str):
                cells.append(f'<c r="{at}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
            elif v is not None:
                cells.append(f'<c r="{at}"><v>{v}</v></c>')
        return f'<row r="{number}">{"".join(cells)}</row>'

    def save(self, path: str) -> None:
        Path(path).write_bytes(self.bytes())


def geojson_text(df: DataFrame, ring: str, properties: list[str]) -> DataFrame:
    """One GeoJSON feature a row, as text."""
    coordinates = F.array(F.transform(F.concat(ring, F.slice(ring, 1, 1)), lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"))
    return df.select(F.to_json(feature).alias("feature"))


def map_html(features: DataFrame, path: str, title: str, limit: int = 50_000) -> None:
    """Self-contained page with the features drawn as SVG; refuses more than a page should hold."""
    rows = [json.loads(r["feature"]) for r in features.limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError(f"more than {limit} features")
    points = [p for f in rows for ring in f["geometry"]["coordinates"] for p in ring] or [[0, 0]]
    x0, x1, y0, y1 = min(p[0] for p in points), max(p[0] for p in points), min(p[1] for p in points), max(p[1] for p in points)
    shapes = "".join('<path d="' + "".join("M" + "L".join(f"{p[0] - x0:.1f},{y1 - p[1]:.1f}" for p in ring) + "Z" for ring in f["geometry"]["coordinates"]) + f'"><title>{escape(json.dumps(f["properties"]))}</title></path>' for f in rows)
    Path(path).write_text(f'<!doctype html><meta charset="utf-8"><title>{escape(title)}</title><svg viewBox="0 0 {x1 - x0 or 1} {y1 - y0 or 1}" fill="none" stroke="black" vector-effect="non-scaling-stroke">{shapes}</svg>', encoding="utf-8")


def bars_svg(rows: list[tuple[str, float]], title: str) -> str:
    """Bar chart of a few labelled values."""
    top = max([v for _, v in rows] or [1]) or 1
    bars = "".join(f'<rect x="{i * 60 + 20}" y="{220 - 200 * v / top:.1f}" width="40" height="{200 * v / top:.1f}"/><text x="{i * 60 + 40}" y="236" text-anchor="middle" font-size="11">{escape(k)}</text>' for i, (k, v) in enumerate(rows))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{len(rows) * 60 + 40}" height="250"><title>{escape(title)}</title>{bars}</svg>'
