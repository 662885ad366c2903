"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from palimpsest.llm.bpe import op8_bpe
from palimpsest.llm import decontamination
from palimpsest.llm.language_id import op7_language_id
from palimpsest.llm.ngram_join import op2_ngram_join
from palimpsest.llm.pii import op3_pii
from palimpsest.llm.quality_classifier import op6_quality_classifier
from palimpsest.llm.quality_rules import op9_quality_rules
from palimpsest.llm.secret_scan import op1_secret_scan
from palimpsest.llm.sharding import op5_sharding
from palimpsest.llm.url_filter import op10_url_filter

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_ngram_join": op2_ngram_join,
    "op3_pii": op3_pii,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_language_id": op7_language_id,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
}

ORACLES: dict[str, str] = {
    "op4_decontamination": decontamination.ORACLE,
}
