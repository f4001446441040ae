"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from varzea.llm.oracles import oracle_sql  # noqa: F401

_MODULES = {
    "op1_lm_elias_fano": "lm_scoring",
    "op2_html_bilstm": "html_extraction",
    "op3_quality_divergence": "quality_rules",
    "op4_mixing": "mixing",
    "op5_language_id": "language_id",
    "op6_suffix_dedup": "suffix_dedup",
    "op7_quality_attention": "quality_classifier",
    "op8_toxicity_fm": "toxicity",
    "op9_simhash_pivots": "simhash",
    "op10_decontamination": "decontamination",
    "op11_token_counts": "token_counts",
    "op12_source_divergence": "source_divergence",
    "op13_tokenizer_alignment": "tokenizer_alignment",
}


def _call(module: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    return getattr(import_module(f"varzea.llm.{module}"), name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _call(module, name) for name, module in _MODULES.items()}
