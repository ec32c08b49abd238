"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .decontamination import op8_benchmark_decontamination
from .html import op9_html_extraction
from .jaccard import op1_ngram_jaccard_join
from .langid import op10_language_id
from .packing import op3_best_fit_packing
from .pii import op7_personal_data
from .quality import ORACLE as QUALITY_SQL
from .quality import op2_quality_rules
from .secrets import op5_secret_scans
from .sharding import op4_sharding
from .substring import op6_substring_dedup

QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_quality_rules,
        op3_best_fit_packing,
        op4_sharding,
        op5_secret_scans,
        op6_substring_dedup,
        op7_personal_data,
        op8_benchmark_decontamination,
        op9_html_extraction,
        op10_language_id,
    )
}

#: The others need hashes, tokenizers, automata or trained models that DuckDB lacks; tests hold them against brute force.
ORACLES = {"op2_quality_rules": QUALITY_SQL}
