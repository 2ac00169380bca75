"""Tables that a plan uses more than once, written to the cluster's shared folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``; in local mode a temporary one is set where none is named, on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="tallyroad-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Path in the shared folder that is deleted at the end."""
    path = f"{shared_dir(spark)}/{name}"
    if not _written:
        atexit.register(release)
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: its facts are scanned once, and a lost executor costs no table."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> None:
    """Delete the tables written so far (all, or those of ``spark``)."""
    for owner, path in list(_written):
        if spark is not None and owner is not spark:
            continue
        _written.remove((owner, path))
        try:
            if owner.sparkContext._jsc is None:
                continue
            hadoop = owner._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(owner._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session has ended: its folder goes with it  # noqa: BLE001, S112
            continue
