"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from orderwell.llm.byte_bpe import op6_byte_bpe
from orderwell.llm.decontaminate import OP5_SQL, op5_decontaminate
from orderwell.llm.exact_topk import OP4_SQL, op4_exact_topk
from orderwell.llm.html_text import op8_html_text
from orderwell.llm.license_scan import OP13_SQL, op13_licenses
from orderwell.llm.near_duplicates import op3_near_duplicates
from orderwell.llm.pii import op2_pii
from orderwell.llm.resampling import op12_resampling
from orderwell.llm.secrets import op9_secrets
from orderwell.llm.spelling import op11_spelling
from orderwell.llm.token_counts import op10_token_counts
from orderwell.llm.toxicity import op1_toxicity
from orderwell.llm.url_filter import OP7_SQL, op7_url_filter

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_exact_topk": op4_exact_topk,
    "op5_decontaminate": op5_decontaminate,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_url_filter": op7_url_filter,
    "op8_html_text": op8_html_text,
    "op9_secrets": op9_secrets,
    "op10_token_counts": op10_token_counts,
    "op11_spelling": op11_spelling,
    "op12_resampling": op12_resampling,
    "op13_licenses": op13_licenses,
}

SQL = {"op4_exact_topk": OP4_SQL, "op5_decontaminate": OP5_SQL, "op7_url_filter": OP7_SQL, "op13_licenses": OP13_SQL}
