"""The registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from tallybridge.llm.decontamination import op6_decontamination
from tallybridge.llm.inner_products import OP11_SQL, op11_top_products
from tallybridge.llm.language_id import op1_language_id
from tallybridge.llm.lattice_lm import op8_lattice_lm
from tallybridge.llm.lexical_search import OP12_SQL, op12_lexical_search
from tallybridge.llm.merkle import OP9_SQL, op9_merkle_edits, op9_merkle_fingerprint
from tallybridge.llm.packing import op7_packing
from tallybridge.llm.secret_scan import op2_secret_scan
from tallybridge.llm.simhash_dedup import op4_simhash_dedup
from tallybridge.llm.token_alignment import op13_token_alignment
from tallybridge.llm.token_store import op3_token_store
from tallybridge.llm.tool_calls import OP10_SQL, op10_tool_calls
from tallybridge.llm.url_reputation import OP5_SQL, op5_url_reputation

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_token_store": op3_token_store,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_url_reputation": op5_url_reputation,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_lattice_lm": op8_lattice_lm,
    "op9_merkle_fingerprint": op9_merkle_fingerprint,
    "op9_merkle_edits": op9_merkle_edits,
    "op10_tool_calls": op10_tool_calls,
    "op11_top_products": op11_top_products,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op5_url_reputation": OP5_SQL,
    "op9_merkle_fingerprint": OP9_SQL,
    "op10_tool_calls": OP10_SQL,
    "op11_top_products": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}
