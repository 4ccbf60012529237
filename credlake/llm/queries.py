"""Registered queries of this subpackage and, where SQL expresses them, their DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (ann, collocations, exact_dedup, html_extract, lexical_search, line_dedup, lm_score, packing, quality, sentencepiece_codec,
               simhash_dedup, suffix_dedup, toxicity)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_html_extract": html_extract.op2_html_extract,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_lm_score": lm_score.op4_lm_score,
        "op5_sentencepiece": sentencepiece_codec.op5_sentencepiece,
        "op6_ann": ann.op6_ann,
        "op7_packing": packing.op7_packing,
        "op8_quality": quality.op8_quality,
        "op9_simhash_dedup": simhash_dedup.op9_simhash_dedup,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_collocations": collocations.op11_collocations,
        "op12_lexical_search": lexical_search.op12_lexical_search,
        "op13_line_dedup": line_dedup.op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_lm_score": lm_score.ORACLE,
        "op10_exact_dedup": exact_dedup.ORACLE,
        "op11_collocations": collocations.ORACLE,
        "op12_lexical_search": lexical_search.ORACLE,
        "op13_line_dedup": line_dedup.ORACLE,
    }
