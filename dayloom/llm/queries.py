"""The registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayloom.llm.bilinear import op2
from dayloom.llm.decontaminate import op9
from dayloom.llm.jaccard_join import ORACLE as JOIN_ORACLE
from dayloom.llm.jaccard_join import op10
from dayloom.llm.kneser_ney import op4
from dayloom.llm.language import op6
from dayloom.llm.packing import op7
from dayloom.llm.passages import op8
from dayloom.llm.quality_rules import op3
from dayloom.llm.runs import op12
from dayloom.llm.shards import op1
from dayloom.llm.toxicity import op5
from dayloom.llm.trie import ORACLE as TRIE_ORACLE
from dayloom.llm.trie import op11
from dayloom.llm.urls import op13
from dayloom.llm.urls import oracle as urls_oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_histogram_sort": op1,
    "op2_log_bilinear": op2,
    "op3_divergence_rules": op3,
    "op4_kneser_ney": op4,
    "op5_toxic_lexicon": op5,
    "op6_viterbi_language": op6,
    "op7_exact_complement_packing": op7,
    "op9_qgram_contamination": op9,
    "op8_chained_passages": op8,
    "op10_jaccard_join": op10,
    "op11_centroid_trie": op11,
    "op12_recompression_runs": op12,
    "op13_bloom_cascade_urls": op13,
}
ORACLES: dict[str, str] = {
    "op10_jaccard_join": JOIN_ORACLE,
    "op11_centroid_trie": TRIE_ORACLE,
    "op13_bloom_cascade_urls": urls_oracle(),
}
