"""The operators as queries, and the SQL that some of them must equal."""

from __future__ import annotations

from lanelux.llm.chat import OP13_SQL, op13_chat_formatting
from lanelux.llm.langid import op10_language_id
from lanelux.llm.lexical import OP11_SQL, op11_lexical_search
from lanelux.llm.mixing import OP5_SQL, op5_mixing
from lanelux.llm.packing import op4_packing
from lanelux.llm.passages import op9_repeated_passages
from lanelux.llm.quality import OP8_SQL, op8_quality_rules
from lanelux.llm.secrets import OP6_SQL, op6_secret_scans
from lanelux.llm.simhash import op2_simhash
from lanelux.llm.spelling import op12_spelling_variants
from lanelux.llm.token_files import op3_token_files
from lanelux.llm.topk import OP1_SQL, op1_topk
from lanelux.llm.urls import op7_url_filters

QUERIES = {
    f.__name__: f
    for f in (
        op1_topk,
        op2_simhash,
        op3_token_files,
        op4_packing,
        op5_mixing,
        op6_secret_scans,
        op7_url_filters,
        op8_quality_rules,
        op9_repeated_passages,
        op10_language_id,
        op11_lexical_search,
        op12_spelling_variants,
        op13_chat_formatting,
    )
}

ORACLE: dict[str, str] = {
    "op1_topk": OP1_SQL,
    "op5_mixing": OP5_SQL,
    "op6_secret_scans": OP6_SQL,
    "op8_quality_rules": OP8_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_chat_formatting": OP13_SQL,
}
