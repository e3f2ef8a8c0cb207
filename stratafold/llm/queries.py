"""The queries of this folder, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from stratafold.llm.conversation import OP13_SQL, op13_conversation_repair
from stratafold.llm.fim import OP12_SQL, op12_fill_in_middle
from stratafold.llm.katz import op7_katz_backoff
from stratafold.llm.language import op10_language_id
from stratafold.llm.minhash import op3_minhash
from stratafold.llm.mixing import op9_mixing
from stratafold.llm.packing import op8_retrieval_packing
from stratafold.llm.quality import op4_line_quality
from stratafold.llm.simhash import op1_simhash
from stratafold.llm.tokencount import op11_token_counts
from stratafold.llm.topk import OP5_SQL, op5_top_products
from stratafold.llm.warc import OP2_SQL, op2_warc
from stratafold.llm.wavelet import op6_wavelet_tokens

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_minhash": op3_minhash,
    "op4_line_quality": op4_line_quality,
    "op5_top_products": op5_top_products,
    "op6_wavelet_tokens": op6_wavelet_tokens,
    "op7_katz_backoff": op7_katz_backoff,
    "op8_retrieval_packing": op8_retrieval_packing,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_token_counts": op11_token_counts,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op2_warc": OP2_SQL, "op5_top_products": OP5_SQL, "op12_fill_in_middle": OP12_SQL,
    "op13_conversation_repair": OP13_SQL}
