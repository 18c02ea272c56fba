"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from sluicegate.llm import (
    binary_output,
    chat,
    decontaminate,
    exact_dedup,
    group_join,
    lm_score,
    near_dedup,
    packing,
    pii,
    quality,
    repair,
    secrets,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_packing": packing.op4_packing,
    "op5_chat_formatting": chat.op5_chat_formatting,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_pii": pii.op7_pii,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_binary_output": binary_output.op10_binary_output,
    "op11_group_join": group_join.op11_group_join,
    "op12_conversation_repair": repair.op12_conversation_repair,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op3_lm_score": lm_score.OP3_SQL,
    "op5_chat_formatting": chat.OP5_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op9_decontaminate": decontaminate.OP9_SQL,
    "op11_group_join": group_join.OP11_SQL,
    "op12_conversation_repair": repair.OP12_SQL,
}
