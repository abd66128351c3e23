"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from sommelix.llm.decontaminate import OP3_SQL, op3_decontaminate
from sommelix.llm.fill_in_middle import OP13_SQL, op13_fill_in_middle
from sommelix.llm.filter_audit import OP11_SQL, op11_filter_audit
from sommelix.llm.host_rules import OP10_SQL, op10_host_rules
from sommelix.llm.jaccard_join import OP9_SQL, op9_jaccard_join
from sommelix.llm.language_id import op6_language_id
from sommelix.llm.line_dedup import OP8_SQL, op8_line_dedup
from sommelix.llm.mixing import op5_mixing
from sommelix.llm.quality_crf import op7_quality_crf
from sommelix.llm.secret_scan import op1_secret_scan
from sommelix.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from sommelix.llm.token_count import op2_token_count
from sommelix.llm.top_k import OP12_SQL, op12_top_k

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_count": op2_token_count,
    "op3_decontaminate": op3_decontaminate,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_mixing": op5_mixing,
    "op6_language_id": op6_language_id,
    "op7_quality_crf": op7_quality_crf,
    "op8_line_dedup": op8_line_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_host_rules": op10_host_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_top_k": op12_top_k,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES = {
    "op3_decontaminate": OP3_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op8_line_dedup": OP8_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op10_host_rules": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_top_k": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
