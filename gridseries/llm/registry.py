"""Queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from gridseries.llm import chat_format, fill_middle, filter_audit, license_scan, url_filter
from gridseries.llm.byte_bpe import op11_byte_bpe
from gridseries.llm.chat_format import op8_chat_format
from gridseries.llm.fill_middle import op13_fill_middle
from gridseries.llm.filter_audit import op12_filter_audit
from gridseries.llm.lattice import op10_embedding_near_dedup
from gridseries.llm.license_scan import op2_license_scan
from gridseries.llm.mixing import op7_mixing
from gridseries.llm.neighbours import op6_nearest_neighbours
from gridseries.llm.packing import op3_best_fit_packing
from gridseries.llm.quality import op5_quality_classifier
from gridseries.llm.simhash import op4_simhash
from gridseries.llm.token_files import op9_token_files
from gridseries.llm.url_filter import op1_url_filter

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_license_scan": op2_license_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash": op4_simhash,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_mixing": op7_mixing,
    "op8_chat_format": op8_chat_format,
    "op9_token_files": op9_token_files,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_middle": op13_fill_middle,
}

ORACLES = {
    "op1_url_filter": url_filter.ORACLE,
    "op2_license_scan": license_scan.ORACLE,
    "op8_chat_format": chat_format.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
