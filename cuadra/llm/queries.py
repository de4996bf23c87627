"""The queries of this folder and their SQL, as the driver's entry file adds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import conversations, decontaminate, langid, minhash, mixing, packing, phrases, pii, suffix, tokens, toxicity, urls, vptree

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_urls": urls.op2_urls,
    "op3_mixing": mixing.op3_mixing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_suffix": suffix.op5_suffix,
    "op6_vptree": vptree.op6_vptree,
    "op7_minhash": minhash.op7_minhash,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_tokens": tokens.op9_tokens,
    "op10_langid": langid.op10_langid,
    "op11_phrases": phrases.op11_phrases,
    "op12_packing": packing.op12_packing,
    "op13_conversations": conversations.op13_conversations,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op1_pii": pii.oracle(),
    "op2_urls": urls.oracle(),
    "op8_decontaminate": decontaminate.oracle(),
    "op11_phrases": phrases.oracle(),
}
