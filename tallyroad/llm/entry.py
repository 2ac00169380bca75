"""Queries of the corpus operators and their SQL, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyroad.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from tallyroad.llm.fingerprints import op4_fingerprints
from tallyroad.llm.jaccard_join import OP1_SQL, op1_jaccard_join
from tallyroad.llm.license_scan import op3_license_scan
from tallyroad.llm.line_dedup import OP10_SQL, op10_line_dedup
from tallyroad.llm.lm_scoring import op6_lm_scoring
from tallyroad.llm.mixing import OP7_SQL, op7_mixing
from tallyroad.llm.sentencepiece_codec import op5_sentencepiece
from tallyroad.llm.suffix_dedup import OP9_SQL, op9_suffix_dedup
from tallyroad.llm.toxicity import op2_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_jaccard_join": op1_jaccard_join,
        "op2_toxicity": op2_toxicity,
        "op3_license_scan": op3_license_scan,
        "op4_fingerprints": op4_fingerprints,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_mixing": op7_mixing,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_line_dedup": op10_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_jaccard_join": OP1_SQL, "op7_mixing": OP7_SQL, "op8_exact_dedup": OP8_SQL, "op9_suffix_dedup": OP9_SQL, "op10_line_dedup": OP10_SQL}
