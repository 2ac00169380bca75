"""Line deduplication by range-partitioned line hashes; DataFrame functions only.

Each line's key is hashed to 128 bits. The hashes are range-partitioned with a secondary
sort by document and position, so that a key of any frequency spreads over several
partitions, and each partition streams through its rows and passes on the first occurrence
of a key in a document. Those are counted per key with map-side combination, and the
decision comes back to the documents as a run-length compressed bitmap of the lines that
stay, not as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.llm import common

MIN_CHARS, MIN_DOCS = 20, 3
#: Length of a run that lasts to the end of its text.
OPEN = 1 << 30


def line_key(line: Column) -> Column:
    return common.ascii_lower(F.btrim(line, F.lit(common.SPACE)))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def _runs(dropped: Column) -> Column:
    """Kept runs as (start, length) structs, from sorted dropped positions; the last one is open."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(F.element_at(dropped, -1) + 1 + OPEN))
    gaps = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    return F.filter(gaps, lambda r: r["length"] > 0)


def first_occurrences(occurrences: DataFrame, partitions: int) -> DataFrame:
    """Rows (h1, h2, doc_id, mark, pos) that are the first of their key and document, streamed from sorted ranges of hashes."""
    ordered = occurrences.repartitionByRange(partitions, "h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "mark", "pos")
    # the ranges keep a key's rows of one document together and in order: the window needs no further shuffle or sort
    return ordered.withColumn("nth", F.row_number().over(Window.partitionBy("h1", "h2", "doc_id").orderBy("mark", "pos"))).where("nth = 1").drop("nth")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, mark, n_dropped, keep_runs) of the texts that lose lines: their kept lines as a run-length bitmap, the last run open.

    ``docs`` has doc_id (not null), mark (a hash of the text, which tells rows of one doc_id apart) and text.
    """
    key = line_key(F.col("line"))
    occurrences = common.materialize(
        docs.select("doc_id", "mark", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .withColumn("key", key)
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "mark", "pos"),
        "lines",
    )
    firsts = first_occurrences(occurrences, common.shuffle_partitions(docs.sparkSession))
    repeated = common.materialize(
        firsts.groupBy("h1", "h2").agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("keep_id")).where(F.col("n_docs") >= min_docs).select("h1", "h2", "keep_id"),
        "line-keys",
    )
    dropped = occurrences.join(repeated, ["h1", "h2"]).where(F.col("doc_id") != F.col("keep_id"))
    positions = dropped.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    return positions.select("doc_id", "mark", F.size("dropped").cast("long").alias("n_dropped"), _runs(F.col("dropped")).alias("keep_runs"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, other: tuple[str, ...] = ()) -> DataFrame:
    """Drop lines that many documents share, except in the largest doc_id that holds them.

    ``docs`` needs ``doc_id`` and ``text``; columns named in ``other`` come along in a struct ``carried``. A line's key is
    the line stripped of white space at both ends with A-Z lower-cased. Keys of at least ``min_chars``
    code points that at least ``min_docs`` documents hold lose all lines elsewhere than in the largest
    doc_id. Returns doc_id, n_lines, n_dropped, ``keep_runs`` (run-length bitmap of kept lines: start,
    length), ``text`` (kept lines, joined by newlines) and carried. A null or empty text is one
    empty line; rows that repeat a doc_id are one document to the count, and each loses the lines of its
    own text; rows with a null doc_id take no part and keep all their lines; an empty table gives an empty table.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"), common.carry(other)).withColumn("mark", F.xxhash64("text"))
    bitmaps = keep_bitmaps(base.select("doc_id", "mark", "text").where(F.col("doc_id").isNotNull()), min_chars, min_docs)
    joined = base.join(bitmaps, ["doc_id", "mark"], "left")
    lines = lines_of(F.col("text"))
    # the open run ends with the text
    closed = F.filter(F.transform("keep_runs", lambda r: F.struct(r["start"].alias("start"), F.least(r["length"], F.col("n_lines").cast("int") - r["start"]).alias("length"))), lambda r: r["length"] > 0)
    # bound as a lambda variable, the split text is made once and not once a run
    kept = F.transform(F.array(lines), lambda whole: F.flatten(F.transform("keep_runs", lambda r: F.slice(whole, r["start"] + 1, r["length"]))))[0]
    return (
        joined.withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("text", F.when(F.col("keep_runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
        .withColumn("keep_runs", F.coalesce(closed, F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").cast("int").alias("length")))))
        .select("doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep_runs", "text", "carried")
    )


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = line_dedup(common.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))),
k AS (
  SELECT key, max(doc_id) AS keep_id FROM l WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.*, k.keep_id IS NOT NULL AND l.doc_id <> k.keep_id AS gone FROM l LEFT JOIN k USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
