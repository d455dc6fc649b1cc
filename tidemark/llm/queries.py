"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from .decontaminate import op6_decontamination
from .filter_audit import op11_filter_audit
from .katz import op8_katz
from .language_id import op3_language_id
from .mixing import op7_mixing
from .phrases import op13_phrases
from .quality_classifier import op9_quality
from .quality_rules import op1_quality_rules
from .secret_scan import op12_secret_scan
from .sharding import op4_sharding
from .simhash_dedup import op2_simhash
from .token_counts import op10_token_counts
from .toxicity import op5_toxicity

QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_simhash, op3_language_id, op4_sharding, op5_toxicity, op6_decontamination, op7_mixing,
    op8_katz, op9_quality, op10_token_counts, op11_filter_audit, op12_secret_scan,
    op13_phrases)}
