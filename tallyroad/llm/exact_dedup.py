"""Exact deduplication by two-pass Bloom filtering.

Pass one sends eight-byte hashes (deduplicated inside each batch) to segments of the hash
space; a segment streams them through a first filter and enters those already present
into a second filter of repeated hashes. Pass two tests every row against the second
filter: only rows that may repeat are shuffled and compared by SHA-256, all others pass
straight through. False positives of the filter only shuffle a row needlessly. Where the
filters are larger than what may be broadcast, the hash space is worked off in rounds: the
hashes are written in a folder for each round, and a round builds, broadcasts and releases
its own filters and reads its own folder only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroad.llm import common

BITS_PER_KEY, HASHES = 12, 4
#: Hashes a segment holds on average, so that a segment's filters stay small.
SEGMENT_KEYS = 1 << 20
#: Bytes of filters broadcast at once; the segments of more are worked off in further rounds.
BROADCAST_BYTES = 64 << 20


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """(n, HASHES) bit positions by double hashing of 64-bit keys."""
    with np.errstate(over="ignore"):
        a = keys * np.uint64(0x9E3779B97F4A7C15)
        a ^= a >> np.uint64(32)
        b = (keys * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
        steps = np.arange(HASHES, dtype=np.uint64)
        return ((a[:, None] + b[:, None] * steps) >> np.uint64(11)) % np.uint64(bits)


def _contains(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((words[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _insert(words: np.ndarray, slots: np.ndarray) -> None:
    flat = slots.ravel()
    np.bitwise_or.at(words, flat >> np.uint64(3), np.left_shift(np.uint8(1), (flat & np.uint64(7)).astype(np.uint8)))


def _keys(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _pack(segments: int):
    """Batch of hashes -> one row per segment: distinct hashes, and those that repeat inside the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = np.unique(_keys(batch.column(0)), return_counts=True)
            at = keys % np.uint64(segments)
            order = np.argsort(at, kind="stable")
            keys, counts, at = keys[order], counts[order], at[order]
            found, starts = np.unique(at, return_index=True)
            ends = [*starts[1:], len(at)]
            yield pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array(found.astype(np.int64)),
                    "keys": pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                    "twice": pa.array([keys[a:b][counts[a:b] > 1].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                }
            )

    return run


def _filters(bits: int):
    """Rows of a partition -> the filter of repeated hashes of each of its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        again: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, keys, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment not in seen:
                    seen[segment], again[segment] = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
                slots = _slots(np.frombuffer(keys, np.uint64), bits)
                present = _contains(seen[segment], slots)
                _insert(again[segment], slots[present])
                _insert(seen[segment], slots[~present])
                if twice:
                    _insert(again[segment], _slots(np.frombuffer(twice, np.uint64), bits))
        for segment, words in again.items():
            if words.any():
                yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int64()), "bits": pa.array([words.tobytes()], pa.binary())})

    return run


def _test(filters, segments: int, bits: int):
    """Add ``maybe``: whether the row's hash is in its segment's filter of repeated hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: np.frombuffer(v, np.uint8) for k, v in filters.value.items()}
        for batch in batches:
            keys = _keys(batch.column("key"))
            at = (keys % np.uint64(segments)).astype(np.int64)
            maybe = np.zeros(len(keys), bool)
            for segment in np.unique(at):
                if segment in held:
                    rows = np.flatnonzero(at == segment)
                    maybe[rows] = _contains(held[segment], _slots(keys[rows], bits))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], names=[*batch.schema.names, "maybe"])

    return run


def _layout(n_rows: int) -> tuple[int, int, int]:
    """Segments of the hash space, bits of a segment's filter, and segments of a round."""
    segments = max(1, -(-n_rows // SEGMENT_KEYS))
    bits = SEGMENT_KEYS * BITS_PER_KEY if segments > 1 else max(1024, -(-n_rows * BITS_PER_KEY // 8) * 8)
    return segments, bits, max(1, BROADCAST_BYTES // (bits // 8))


def mark_possible_repeats(rows: DataFrame) -> DataFrame:
    """Add boolean ``maybe`` to ``rows`` by their long column ``key``: false means that the key occurs once for certain.

    The rows must be re-readable at low cost (a written table). With filters of more than BROADCAST_BYTES the rows
    are written once more, by round.
    """
    spark = rows.sparkSession
    segments, bits, at_once = _layout(rows.count())
    schema = T.StructType([*rows.schema.fields, T.StructField("maybe", T.BooleanType())])

    def one(part: DataFrame, last: bool) -> DataFrame:
        packed = part.select("key").mapInArrow(_pack(segments), "segment long, keys binary, twice binary")
        tasks = min(segments, at_once, common.shuffle_partitions(spark) * 8)
        built = packed.repartition(tasks, "segment").mapInArrow(_filters(bits), "segment long, bits binary").collect()  # at most BROADCAST_BYTES
        held = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in built})
        out = part.mapInArrow(_test(held, segments, bits), schema)
        if last:
            return out
        out = common.materialize(out, "tested")
        held.destroy()
        return out

    rounds = -(-segments // at_once)
    if rounds == 1:
        return one(rows, True)
    # the unsigned remainder, as numpy takes it
    segment = F.expr(f"pmod(cast(key as decimal(20,0)) + if(key < 0, 18446744073709551616BD, 0BD), {segments})")
    dealt = common.materialize(rows.withColumn("bloom_round", F.floor(segment / at_once).cast("int")), "rounds", ("bloom_round",))
    return reduce(DataFrame.unionAll, [one(dealt.where(F.col("bloom_round") == k).drop("bloom_round"), False) for k in range(rounds)])


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Group documents whose texts are equal once white space is deleted.

    ``docs`` needs ``doc_id`` and ``text``. Of equal texts the row with the most code points in its
    original text stays, then the one with the smallest doc_id. Returns, for every row, doc_id,
    keep_id, group_size, kept, text_sha256 and n_chars. Null and empty texts are equal; a null
    doc_id stays only where all ids of the group are null; rows that repeat a doc_id with the same
    text count in group_size and share its decision; an empty table gives an empty table.
    """
    text = common.text_of()
    digests = common.materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.translate(text, common.SPACE, ""), 256)).alias("sha"), F.char_length(text).cast("long").alias("n_chars")).withColumn("key", F.xxhash64("sha")),
        "digests",
    )
    tested = mark_possible_repeats(digests)
    alone = tested.where(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "n_chars")
    repeated = tested.where("maybe").select("doc_id", "sha", "n_chars")
    groups = common.materialize(
        # ~id falls as id rises and never overflows; a null is the smallest and so the last choice
        repeated.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("flipped"))).alias("best")),
        "groups",
    )
    decided = (
        repeated.join(groups, "sha")
        .withColumn("keep_id", F.bitwise_not("best.flipped"))
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("best.n_chars"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "n_chars")
    )
    return alone.unionAll(decided)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return common.keep_ids(docs, exact_dedup(docs).where("kept"))


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(common.read(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, ''))::BIGINT AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256)::BIGINT AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256, n_chars
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
"""
