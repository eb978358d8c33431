"""Registered queries of the operators, and the statements that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import alignment, decontaminate, fingerprints, language, mixing, near_dups, personal, repetition, sharding, spelling, token_files, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": token_files.op1_token_files,
    "op2_near_duplicates": near_dups.op2_near_duplicates,
    "op3_mixing": mixing.op3_mixing,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_sharding": sharding.op5_sharding,
    "op6_language": language.op6_language,
    "op7_personal": personal.op7_personal,
    "op8_warc": warc.op8_warc,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_repetition": repetition.op11_repetition,
    "op12_alignment": alignment.op12_alignment,
    "op13_spelling": spelling.op13_spelling,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {"op3_mixing": mixing.SQL, "op4_url_filter": url_filter.SQL, "op8_warc": warc.SQL, "op11_repetition": repetition.SQL}
