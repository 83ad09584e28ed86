"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm.centroids import OP11_SQL, op11_centroid_clustering
from tickforge.llm.decontaminate import op6_decontaminate
from tickforge.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from tickforge.llm.html_text import op4_html_text
from tickforge.llm.line_dedup import op9_line_dedup
from tickforge.llm.ngram_join import op10_ngram_join
from tickforge.llm.pieces import op2_sentencepiece
from tickforge.llm.secrets import op3_secret_scan
from tickforge.llm.suffix_dedup import op8_suffix_dedup
from tickforge.llm.token_store import op1_token_store
from tickforge.llm.toxicity import op5_toxicity
from tickforge.llm.url_filter import OP13_SQL, op13_url_filter
from tickforge.llm.whitening import op12_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_store": op1_token_store,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_secret_scan": op3_secret_scan,
        "op4_html_text": op4_html_text,
        "op5_toxicity": op5_toxicity,
        "op6_decontaminate": op6_decontaminate,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_line_dedup": op9_line_dedup,
        "op10_ngram_join": op10_ngram_join,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_whitening": op12_whitening,
        "op13_url_filter": op13_url_filter,
    }


def oracle_sql() -> dict[str, str]:
    """What plain SQL can express; the others are tested against brute force."""
    return {"op7_exact_dedup": OP7_SQL, "op11_centroid_clustering": OP11_SQL, "op13_url_filter": OP13_SQL}
