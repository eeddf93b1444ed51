"""The named queries of this subpackage and the SQL that states the results it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.fingerprints import op9_document_fingerprints
from tillroll.llm.lm_scoring import op4_lm_scoring
from tillroll.llm.mixing import op1_mixing
from tillroll.llm.ngram_join import op2_ngram_jaccard_join
from tillroll.llm.packing import op6_best_fit_packing
from tillroll.llm.phrases import op13_phrase_collocations
from tillroll.llm.quality_rules import op8_quality_rules
from tillroll.llm.secret_scans import op5_secret_scans
from tillroll.llm.sharding import op10_sharding
from tillroll.llm.spelling import op12_spelling_variants
from tillroll.llm.statements import STATEMENTS
from tillroll.llm.token_counts import op3_token_counts
from tillroll.llm.top_k_search import op11_top_k_search
from tillroll.llm.url_filters import op7_url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_ngram_jaccard_join,
        op3_token_counts,
        op4_lm_scoring,
        op5_secret_scans,
        op6_best_fit_packing,
        op7_url_filters,
        op8_quality_rules,
        op9_document_fingerprints,
        op10_sharding,
        op11_top_k_search,
        op12_spelling_variants,
        op13_phrase_collocations,
    )
}

ORACLE: dict[str, str] = STATEMENTS
