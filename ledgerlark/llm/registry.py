"""Queries of the training-data operators and their DuckDB equivalents."""

from __future__ import annotations

from .bpe import op4_bpe
from .classifier import op9_quality_classifier
from .decontaminate import OP3_SQL, op3_decontamination
from .language import op2_language_id
from .licenses import OP7_SQL, op7_license_scan
from .lm import op10_lm_score
from .near_duplicates import op6_near_duplicates
from .pii import OP8_SQL, op8_pii
from .quality import OP5_SQL, op5_quality_rules
from .urls import OP1_SQL, op1_url_filter

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_bpe": op4_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_license_scan": op7_license_scan,
    "op8_pii": op8_pii,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_lm_score": op10_lm_score,
}
ORACLE_SQL = {
    "op1_url_filter": OP1_SQL,
    "op3_decontamination": OP3_SQL,
    "op5_quality_rules": OP5_SQL,
    "op7_license_scan": OP7_SQL,
    "op8_pii": OP8_SQL,
}
