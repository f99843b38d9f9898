"""Registered queries of this subpackage."""

from __future__ import annotations

from . import lexical_search
from .bpe_tree import op8_bpe
from .decontam import op5_decontamination
from .html_template import op6_main_text
from .importance import op1_importance
from .langid import op3_language
from .lexical_search import op13_lexical_search
from .near_dup import op4_near_duplicates
from .quality_rules import op10_quality_rules
from .secret_scan import op9_secret_scan
from .substring_dedup import op2_substring_dedup
from .token_files import op7_token_files
from .toxicity import op11_toxicity
from .whitening import op12_whitening

QUERIES = {
    "op1_importance": op1_importance,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language": op3_language,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_decontamination": op5_decontamination,
    "op6_main_text": op6_main_text,
    "op7_token_files": op7_token_files,
    "op8_bpe": op8_bpe,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_toxicity": op11_toxicity,
    "op12_whitening": op12_whitening,
    "op13_lexical_search": op13_lexical_search,
}
SQL: dict[str, str] = {
    "op13_lexical_search": lexical_search.SQL,
}
