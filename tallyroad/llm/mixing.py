"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only.

Documents are pre-aggregated to token counts of (source, language, topic) cells. The cells'
weights are raked: scaled in turn so that the sums by source, by language and by topic meet
their targets. A step sums the cells by one margin, with map-side combination, and joins the
sums back, so cells are never brought together; each round is written. A cell's raked share against its token share gives the sampling probability
of its documents, scaled so that the fullest cell is kept whole, and a document stays where
a uniform number made from its id lies below that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroad.llm import common

#: Most rounds, and the relative distance of every margin to its target at which they end before.
ROUNDS, TOLERANCE = 12, 1e-10
#: Rounds after which the distance is looked at.
ROUNDS_A_CHECK = 4
#: Exponent of the token share in the targets: 1 keeps the mixture, 0 gives every value the same weight.
EVENNESS = 0.85
#: Digits of probabilities, so that sums of different order agree.
DIGITS = 6
MARGINS = ("source", "lang", "topic")
#: Fixed values of the topic rule: signs of a text's form, in the order tried.
TABLE_SIGN, SYMBOL_SIGN, SHOUT_SIGN = " | ", "[%&$#*]{3}", "!!"


def topic_of(text: Column) -> Column:
    """Topic of a text by its form, where no topic column is given."""
    return (
        F.when(F.contains(text, F.lit(TABLE_SIGN)), "table")
        .when(text.rlike(SYMBOL_SIGN), "symbols")
        .when(F.contains(text, F.lit(SHOUT_SIGN)), "shout")
        .when(F.char_length(text) < 1500, "note")
        .when(F.char_length(text) < 6000, "article")
        .otherwise("report")
    )


def uniform(key: Column) -> Column:
    """Number in [0, 1) made from the text form of a key, the same in any engine."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("-"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """Cells with ``weight`` (raked from ``tokens``) and the largest relative distance of a margin to its target before the last round.

    ``targets[margin]`` has (margin, target), target shares that sum to 1; cells with a value that has none are left out.
    """
    for m, target in targets.items():
        cells = cells.join(target.select(m, F.col("target").alias(f"target_{m}")), m)
    names = cells.columns
    cells = common.materialize(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    drift = float("inf")
    for done in range(rounds):
        before = cells
        for m in targets:
            sums = cells.groupBy(m).agg(F.sum("weight").alias("sum"))
            factor = F.col(f"target_{m}") / F.col("sum")
            cells = cells.join(sums, m).withColumn(f"drift_{m}", F.abs(1 / factor - 1)).withColumn("weight", F.col("weight") * factor).drop("sum")
        cells = common.materialize(cells.select(*names, "weight", F.greatest(*[F.col(f"drift_{m}") for m in targets]).alias("drift")), "cells")
        common.discard(before)
        if (done + 1) % ROUNDS_A_CHECK == 0 or done + 1 == rounds:
            drift = float(cells.agg(F.max("drift")).first()[0] or 0.0)
            if drift <= tolerance:
                break
    return cells.drop("drift", *[f"target_{m}" for m in targets]), drift


def even_targets(cells: DataFrame, margin: str, evenness: float = EVENNESS) -> DataFrame:
    """Target shares of a margin: token shares to the power ``evenness``, normalised."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), evenness).alias("raised"))
    total = sums.agg(F.sum("raised").alias("total")).first()["total"]
    return sums.select(margin, (F.col("raised") / F.lit(total)).alias("target"))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, other: tuple[str, ...] = ()) -> DataFrame:
    """Sampling probability and decision of every document.

    ``docs`` needs doc_id, text, source and lang, and may have topic (else made by ``topic_of``). Tokens are
    runs free of white space. Returns doc_id, source, lang, topic, tokens, probability, selected and
    ``carried``, a struct of the columns named in ``other``. Null sources, languages and topics count as the value ''; documents without tokens
    belong to cells like any other and weigh nothing; a cell without tokens has probability 1; repeated
    rows share a decision; values that ``targets`` do not name get probability 0; an empty table gives an
    empty table.
    """
    text = common.text_of()
    topic = F.coalesce(F.col("topic").cast("string"), F.lit("")) if "topic" in docs.columns else topic_of(text)
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        topic.alias("topic"),
        # a token begins where a character that is no white space follows white space or the start
        F.size(F.filter(F.split(F.translate(text, common.SPACE, " " * len(common.SPACE)), " "), lambda w: w != "")).cast("long").alias("tokens"),
        common.carry(other),
    )
    cells = common.materialize(base.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")), "cells")
    some = cells.where("tokens > 0")
    wanted = targets or {m: even_targets(some, m) for m in MARGINS}
    raked, _ = rake(some, wanted, rounds)
    ratio = common.materialize(raked.select(*MARGINS, (F.col("weight") / F.col("tokens")).alias("ratio")), "ratios")
    most = ratio.agg(F.max("ratio").alias("most")).first()["most"]
    # of known size, which Spark broadcasts while it is small and joins by key beyond
    rated = common.materialize(
        cells.join(ratio, list(MARGINS), "left")
        .select(*MARGINS, F.when(F.col("tokens") == 0, 1.0).otherwise(F.coalesce(F.round(F.col("ratio") / F.lit(most), DIGITS), F.lit(0.0))).alias("probability")),
        "probabilities",
    )
    return base.join(rated, list(MARGINS)).select("doc_id", *MARGINS, "tokens", "probability", (uniform(F.col("doc_id")) < F.col("probability")).alias("selected"), "carried")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(common.read(spark, sf_dir, "documents")).drop("carried")


def _sql() -> str:
    steps, last = [], "c0"
    for r in range(ROUNDS):
        for k, m in enumerate(MARGINS):
            name = f"c{r * 3 + k + 1}"
            steps.append(f"{name} AS MATERIALIZED (SELECT * REPLACE (weight * t_{m} / sum(weight) OVER (PARTITION BY {m}) AS weight) FROM {last})")
            last = name
    target = lambda m: f"t_{m} AS (SELECT {m}, r / sum(r) OVER () AS t_{m} FROM (SELECT {m}, pow(sum(tokens)::DOUBLE, {EVENNESS}) AS r FROM cells WHERE tokens > 0 GROUP BY {m}))"
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE WHEN contains(t, '{TABLE_SIGN}') THEN 'table'
              WHEN regexp_matches(t, '{SYMBOL_SIGN}') THEN 'symbols' WHEN contains(t, '{SHOUT_SIGN}') THEN 'shout'
              WHEN length(t) < 1500 THEN 'note' WHEN length(t) < 6000 THEN 'article' ELSE 'report' END AS topic,
         len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents)),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM base GROUP BY ALL),
{', '.join(target(m) for m in MARGINS)},
c0 AS MATERIALIZED (SELECT *, tokens::DOUBLE AS weight FROM cells JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic) WHERE tokens > 0),
{', '.join(steps)},
p AS (SELECT source, lang, topic, round(weight / tokens / max(weight / tokens) OVER (), {DIGITS}) AS probability FROM {last})
SELECT doc_id, source, lang, topic, tokens, CASE WHEN c.tokens_all = 0 THEN 1.0 ELSE coalesce(probability, 0.0) END AS probability,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-')), 1, 8))::BIGINT / 4294967296.0 < CASE WHEN c.tokens_all = 0 THEN 1.0 ELSE coalesce(probability, 0.0) END AS selected
FROM base JOIN (SELECT source, lang, topic, tokens AS tokens_all FROM cells) c USING (source, lang, topic) LEFT JOIN p USING (source, lang, topic)
"""


OP7_SQL = _sql()
