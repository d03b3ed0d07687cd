"""Registered queries of this subpackage and, where SQL can state them, their oracles."""

from __future__ import annotations

from .centroids import op13_centroid_clustering
from .chat import op1_chat_formatting
from .decontaminate import op7_template_decontamination
from .jaccard import op8_ngram_jaccard_join
from .language import op3_compression_language_id
from .line_quality import op4_line_crf_quality
from .line_rules import op6_line_frequency_rules
from .mixing import op10_source_mix
from .phrases import op2_substring_dedup
from .resampling import op11_importance_resampling
from .substrings import op9_suffix_array_dedup
from .token_counts import op12_token_counts
from .url_rules import OP5_SQL, op5_url_rules

QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_substring_dedup, op3_compression_language_id, op4_line_crf_quality, op5_url_rules,
    op6_line_frequency_rules, op7_template_decontamination, op8_ngram_jaccard_join, op9_suffix_array_dedup,
    op10_source_mix, op11_importance_resampling, op12_token_counts, op13_centroid_clustering)}

ORACLE_SQL: dict[str, str] = {"op5_url_rules": OP5_SQL}
