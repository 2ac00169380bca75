"""Reports, run records and the order of steps."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroad.operators import spatial, tags
from tallyroad.sources import writers
from tallyroad.sources.writers import Workbook

NEEDED = ("pyspark", "pyarrow", "pandas", "numpy")


def missing_modules(names: tuple[str, ...] = NEEDED) -> list[str]:
    """Modules that this interpreter lacks, to be told before a run."""
    return [n for n in names if importlib.util.find_spec(n) is None]


def run_steps(spark: SparkSession, folder: str, steps: list[tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]], force: bool = False) -> dict[str, DataFrame]:
    """Steps in order, each from the tables before it; written, skipped when done, and stopped by the first error."""
    done: dict[str, DataFrame] = {}
    for name, build in steps:
        done[name] = writers.step(spark, f"{folder}/{name}", lambda b=build: b(done), force)
    return done


def workbook(sheets: dict[str, tuple[str, DataFrame]], figures: dict[str, float], notes: list[str]) -> Workbook:
    """Workbook of report tables: a cover with key figures and notes, then a titled sheet for each table."""
    book = Workbook()
    book.title("Summary", "Key figures")
    for name, value in figures.items():
        book.figure("Summary", name, value)
    for note in notes:
        book.note("Summary", note)
    for sheet, (title, df) in sheets.items():
        book.title(sheet, title)
        book.table(sheet, df)
    return book


def quality_text(scores: dict[str, dict[str, float]]) -> str:
    """One line a model: its name and figures."""
    return "\n".join(f"{name}: " + ", ".join(f"{k} {v:.4f}" for k, v in figures.items()) for name, figures in sorted(scores.items()))


def snapshot(ways: DataFrame, segments: DataFrame, polygons: DataFrame, size: float, threshold: float = 0.5, candidate: float = 0.02) -> tuple[DataFrame, dict]:
    """One network snapshot: scored ways filtered, cut by zone and summed, with its run record.

    ``ways``: way, p, direction, type, km; ``segments``: line, ax, ay, bx, by; ``polygons``: polygon, ring.
    """
    kept = ways.where(F.col("p") >= threshold)
    parts = spatial.clip_lengths(segments.join(kept.select(F.col("way").alias("line")), "line", "left_semi"), polygons, size)
    pieces = parts.join(kept, parts["line"] == kept["way"]).select("way", F.col("polygon").alias("zone"), F.lit("d").alias("side"), (F.col("length_m") / 1000.0).alias("km"), "direction", "type")
    counts = ways.agg(F.count_if(F.col("p") >= candidate).alias("n_candidates"), F.count_if(F.col("p") >= threshold).alias("n_kept")).first()
    stats = tags.run_statistics(pieces).first()
    record = {"n_candidates": counts["n_candidates"], "n_kept": counts["n_kept"], "n_pieces": stats["n_kept"], "km": stats["km"] or 0.0, "n_zones": stats["n_zones"]}
    return tags.effective_lengths(pieces), record
