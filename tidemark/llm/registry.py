"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import collocations, contamination, fingerprints, infill, langid, lm, mixing, neighbours, secrets, sentencepiece, simhash, substrings, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": lm.op1_lm_scoring,
    "op2_sentencepiece": sentencepiece.op2_sentencepiece,
    "op3_language_id": langid.op3_language_id,
    "op4_fingerprints": fingerprints.op4_fingerprints,
    "op5_mixing": mixing.op5_mixing,
    "op6_simhash": simhash.op6_simhash,
    "op7_nearest_neighbours": neighbours.op7_nearest_neighbours,
    "op8_suffix_dedup": substrings.op8_suffix_dedup,
    "op9_secret_scans": secrets.op9_secret_scans,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_collocations": collocations.op11_collocations,
    "op12_decontamination": contamination.op12_decontamination,
    "op13_infill": infill.op13_infill,
}
ORACLE_SQL: dict[str, str] = {
    "op5_mixing": mixing.ORACLE,
    "op8_suffix_dedup": substrings.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_decontamination": contamination.ORACLE,
    "op13_infill": infill.ORACLE,
}
