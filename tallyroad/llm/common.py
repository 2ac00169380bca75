"""Shared helpers: scratch tables in the cluster's shared folder and text preparation.

Edge cases every operator relies on: a null text counts as empty, a null ``doc_id`` is
kept as a null, and only the named columns are read, so extra columns of any name are
never in the way.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and the control characters 09 to 0D.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Regular expression class of the same characters, for Java and for DuckDB.
WORD = "[^\\x20\\x09-\\x0D]+"

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


def materialize(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, in folders of the values of ``by``, and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    if not _written:
        atexit.register(release)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["scratch"] = path
    return out


def _delete(owner: SparkSession, path: str) -> None:
    try:
        if owner.sparkContext._jsc is None:
            return
        hadoop = owner._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(owner._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session has ended: its folder goes with it  # noqa: BLE001, S110
        pass


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        path = df.__dict__.pop("scratch", None)
        for owner, known in [x for x in _written if x[1] == path]:
            _written.remove((owner, known))
            _delete(owner, known)


def release(spark: SparkSession | None = None) -> None:
    """Delete the scratch tables written so far (all, or those of ``spark``)."""
    for owner, path in list(_written):
        if spark is None or owner is spark:
            _written.remove((owner, path))
            _delete(owner, path)


def text_of(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other letter stays."""
    return F.translate(text, UPPER, LOWER)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids`` (a column doc_id; null matches null), whatever other columns are called."""
    name = "kept_id"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    wanted = ids.select(F.col("doc_id").cast("long").alias(name)).distinct()
    return docs.join(wanted, docs["doc_id"].cast("long").eqNullSafe(F.col(name)), "left_semi")


def carry(names: list[str] | tuple[str, ...]) -> Column:
    """Further columns as one struct named ``carried``, so that their names meet no others."""
    return (F.struct(*names) if names else F.lit(None).cast("string")).alias("carried")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
