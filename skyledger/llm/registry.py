"""Test queries of this package: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from skyledger.llm.alignment import op13_token_alignment
from skyledger.llm.chat import OP5_SQL, op5_chat_formatting
from skyledger.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from skyledger.llm.langid import op1_language_id
from skyledger.llm.line_dedup import op8_line_dedup
from skyledger.llm.mixing import OP9_SQL, op9_mixing
from skyledger.llm.near_dedup import op4_minhash_near_dedup
from skyledger.llm.periodic_runs import op11_periodic_runs
from skyledger.llm.pii import op10_pii_pseudonyms
from skyledger.llm.quality import op3_quality_rules
from skyledger.llm.secrets import op12_secret_scans
from skyledger.llm.sentencepiece_scan import op6_sentencepiece
from skyledger.llm.token_file import op7_token_files

OPERATORS = (op1_language_id, op2_exact_dedup, op3_quality_rules, op4_minhash_near_dedup, op5_chat_formatting,
             op6_sentencepiece, op7_token_files, op8_line_dedup, op9_mixing, op10_pii_pseudonyms, op11_periodic_runs, op12_secret_scans, op13_token_alignment)
ORACLES = {"op2_exact_dedup": OP2_SQL, "op5_chat_formatting": OP5_SQL, "op9_mixing": OP9_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in ORACLES.items() if v}
