"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airhour.llm import (
    bpe,
    chunk_fingerprints,
    decontamination,
    hard_negatives,
    language_id,
    mixing,
    nearest,
    prefix_trie,
    quality,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
)
from airhour.llm.common import table


def _over(operator: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(*[table(spark, sf_dir, name) for name in names])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": _over(token_files.op1, "documents"),
    "op2_toxicity": _over(toxicity.op2, "documents", "labels"),
    "op3_chunk_fingerprints": _over(chunk_fingerprints.op3, "documents"),
    "op4_quality": _over(quality.op4, "documents", "labels"),
    "op5_nearest": _over(nearest.op5, "embeddings"),
    "op6_suffix_dedup": _over(suffix_dedup.op6, "documents"),
    "op7_simhash": _over(simhash.op7, "documents"),
    "op8_mixing": _over(mixing.op8, "documents"),
    "op9_bpe": _over(bpe.op9, "documents"),
    "op10_language_id": _over(language_id.op10, "documents"),
    "op11_prefix_trie": _over(prefix_trie.op11, "conversations"),
    "op12_decontamination": _over(decontamination.op12, "documents", "benchmark"),
    "op13_hard_negatives": _over(hard_negatives.op13, "embeddings"),
}

ORACLES: dict[str, str] = {
    "op5_nearest": nearest.OP5_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_decontamination": decontamination.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
