"""Document fingerprints by one-permutation MinHash; DataFrame functions only.

Every shingle hash falls into one bin by its top bits and each bin keeps its minimum.
Empty bins are filled by optimal densification: bin j takes the first filled bin of its
own sequence of hashed bins (after a few probes, the filled bin b of the least hash of
(j, b)), which is the same choice in every document; what it
stores is hashed with j once more, so that short texts do not agree in all bins by one
chance. The low BIN_BITS bits of each bin are packed as one hexadecimal digit. Two fingerprints that agree
in a share m of bins have the similarity (m - c) / (1 - c), where c = 2 ** -BIN_BITS is
the chance that different minima agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroad.llm import common

SHINGLE, BINS, BIN_BITS = 5, 256, 4
#: Hashed bins that an empty bin tries before all filled bins are ranked.
PROBES = 6
_SHIFT = 64 - 8  # the top eight bits choose one of 256 bins
_REST = (1 << _SHIFT) - 1
_DIGITS = "0123456789abcdef"


def shingle_hashes(text: Column, width: int) -> Column:
    """Hashes of all ``width``-word shingles of a text, repeated ones included; a text with fewer words is one shingle."""
    words = F.filter(F.split(common.ascii_lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(
        F.array(hashed),
        lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
        .when(F.size(h) < width, F.array(F.xxhash64(h)))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[h[i + k] for k in range(width)]))),
    )[0]


def fingerprint(hashes: Column) -> Column:
    """Packed fingerprint of a set of shingle hashes; null for an empty set."""
    # the largest value of each bin stands for an empty bin, so that exactly one entry a bin is first
    empties = F.transform(F.sequence(F.lit(-(BINS // 2)), F.lit(BINS // 2 - 1)), lambda b: F.shiftleft(b.cast("bigint"), _SHIFT).bitwiseOR(F.lit(_REST)))
    bin_of = lambda h: F.shiftright(h, _SHIFT)  # noqa: E731  from -BINS/2, in the order of the hashes
    minima = F.transform(
        F.array(F.sort_array(F.concat(hashes, empties))),
        lambda s: F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(s[F.greatest(i - 1, F.lit(0))]))),
    )[0]
    is_empty = lambda h: h.bitwiseAND(F.lit(_REST)) == _REST

    def donor(m: Column, filled: Column, h: Column) -> Column:
        """Value of the bin that fills the empty bin of ``h``: the first filled one of a few probes, else the one of least order."""
        probes = F.transform(F.array(*[F.lit(t) for t in range(PROBES)]), lambda t: m[F.pmod(F.xxhash64(bin_of(h), t), F.lit(BINS)).cast("int")])
        first = F.get(F.filter(probes, lambda x: ~is_empty(x)), F.lit(0))
        least = F.array_min(F.transform(filled, lambda x: F.struct(F.xxhash64(bin_of(h), bin_of(x)).alias("order"), x.alias("value"))))["value"]
        return F.coalesce(first, least)

    digits = F.transform(
        F.array(F.struct(minima.alias("m"), F.filter(minima, lambda x: ~is_empty(x)).alias("filled"))),
        lambda s: F.array_join(
            F.transform(s["m"], lambda h: F.substring(F.lit(_DIGITS), F.when(is_empty(h), F.xxhash64(bin_of(h), donor(s["m"], s["filled"], h))).otherwise(h).bitwiseAND(F.lit(15)).cast("int") + 1, F.lit(1))), ""
        ),
    )[0]
    return F.when(F.size(hashes) > 0, digits)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints; two empty ones are alike, an empty one is unlike any other."""
    chance = 2.0**-BIN_BITS
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda e: e))
    share = same.cast("double") / BINS
    return (
        F.when((F.length(a) == 0) & (F.length(b) == 0), 1.0)
        .when((F.length(a) == 0) | (F.length(b) == 0), 0.0)
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (share - chance) / (1 - chance))))
    )


def add_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", width: int = SHINGLE) -> DataFrame:
    """Add the fingerprint of a text column as column ``name``, which must be a new one; empty string where the text has no words (null and empty texts too)."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {name} already")
    free = "shingle_hashes"
    while free in {c.lower() for c in docs.columns}:
        free += "_"
    return docs.withColumn(free, shingle_hashes(common.text_of(text), width)).withColumn(name, F.coalesce(fingerprint(F.col(free)), F.lit(""))).drop(free)


def _bucket(value: Column, bounds: list[int]) -> Column:
    """Number of bounds above the value, found in two levels so that many bounds stay cheap."""
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    array = lambda x: F.array(*[F.lit(v).cast("bigint") for v in x])
    whole = F.size(F.filter(array([b[-1] for b in blocks]), lambda b: b >= value))
    inner = F.element_at(F.array(*[array(b) for b in blocks], array([])), whole + 1)
    return F.least(whole * step, F.lit(len(bounds))) + F.size(F.filter(inner, lambda b: b >= value))


def with_next(docs: DataFrame, order: tuple[str, ...], carried: tuple[str, ...], buckets: int | None = None) -> DataFrame:
    """Add ``next_<name>`` for each carried column: its value in the next row by descending doc_id, circularly.

    One shuffle of the rows: doc_ids are cut into buckets at sampled bounds, a few for each shuffle
    partition, and the rows with the first id of a bucket are also sent to the bucket before it.
    Ties of doc_id follow the columns ``order``, descending; null ids come last.
    """
    buckets = buckets or 4 * common.shuffle_partitions(docs.sparkSession)
    found = docs.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 100 * buckets).alias("p")).first()["p"] if buckets > 1 else None
    bounds = sorted(set(found or []), reverse=True)  # fewer than ``buckets`` numbers
    nulls = len(bounds) + 1
    bucket = F.when(F.col("doc_id").isNull(), nulls).otherwise(_bucket(F.col("doc_id"), bounds) if bounds else F.lit(0))
    heads = docs.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()  # a row a bucket
    head, before = [None] * (nulls + 1), [0] * (nulls + 1)
    for i, h in enumerate(heads):
        head[h["bucket"]], before[h["bucket"]] = h["head"], heads[i - 1]["bucket"]
    array = lambda x, kind: F.array(*[F.lit(v).cast(kind) for v in x])
    own = F.struct(F.col("bucket").alias("at"), F.lit(False).alias("copy"))
    copy = F.struct(array(before, "int")[F.col("bucket")].alias("at"), F.lit(True).alias("copy"))
    is_head = F.col("doc_id").eqNullSafe(array(head, "bigint")[F.col("bucket")])
    sent = docs.withColumn("bucket", bucket).withColumn("to", F.explode(F.when(is_head, F.array(own, copy)).otherwise(F.array(own))))
    window = Window.partitionBy("at").orderBy("copy", F.col("doc_id").desc_nulls_last(), *[F.col(c).desc() for c in order])
    placed = sent.select(*docs.columns, "to.at", "to.copy")
    return placed.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in carried]).where(~F.col("copy")).drop("at", "copy")


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Fingerprint every document and its edited text, and compare them.

    ``docs`` needs ``doc_id`` and ``text``. In the edited text the last floor(n_chars / 2) code points are
    replaced by the first as many, or all, of the next document in descending doc_id (after the last: the
    first). Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. Null and empty texts have an empty fingerprint and are alike only to each other; of rows
    with one doc_id the greater text comes first; null ids come last; an empty table gives an empty table.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    linked = with_next(add_fingerprint(base, width=width), ("text",), ("text", "fingerprint"))
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = linked.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))
    both = add_fingerprint(edited.select("doc_id", "n_chars", "fingerprint", "next_fingerprint", "edited"), "edited", "edited_fingerprint", width)
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next_fingerprint", F.lit(""))).alias("near_next"),
    )


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(common.read(spark, sf_dir, "documents"))
