"""The queries of this package by name, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm import (
    chat,
    decontamination,
    jaccard,
    line_dedup,
    manifest,
    mixing,
    negatives,
    pages,
    quality,
    simhash,
    substrings,
    topk,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_jaccard": jaccard.op3_jaccard,
    "op4_quality": quality.op4_quality,
    "op5_topk": topk.op5_topk,
    "op6_mixing": mixing.op6_mixing,
    "op7_html": pages.op7_html,
    "op8_chat": chat.op8_chat,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_substrings": substrings.op10_substrings,
    "op11_manifest": manifest.op11_manifest,
    "op12_simhash": simhash.op12_simhash,
    "op13_negatives": negatives.op13_negatives,
}
ORACLES: dict[str, str] = {
    **decontamination.ORACLES,
    **topk.ORACLES,
    **mixing.ORACLES,
    **chat.ORACLES,
    **line_dedup.ORACLES,
    **manifest.ORACLES,
    **negatives.ORACLES,
}
