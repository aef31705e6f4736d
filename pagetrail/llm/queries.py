"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pagetrail.llm.bpe import op2_byte_bpe
from pagetrail.llm.chat import OP1_SQL, op1_chat_formatting
from pagetrail.llm.decontaminate import OP8_SQL, op8_decontaminate
from pagetrail.llm.embedding_dedup import OP7_SQL, op7_embedding_dedup
from pagetrail.llm.exact_dedup import OP11_SQL, op11_exact_dedup
from pagetrail.llm.fill_in_middle import OP13_SQL, op13_fill_in_middle
from pagetrail.llm.filter_audit import OP12_SQL, op12_filter_audit
from pagetrail.llm.language_id import op6_language_id
from pagetrail.llm.minhash_dedup import OP4_SQL, op4_minhash_dedup
from pagetrail.llm.quality import op10_quality
from pagetrail.llm.secrets import op3_secret_scan
from pagetrail.llm.url_filter import OP9_SQL, op9_url_filter
from pagetrail.llm.warc import OP5_SQL, op5_warc

QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secret_scan": op3_secret_scan,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_url_filter": op9_url_filter,
    "op10_quality": op10_quality,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL = {
    "op1_chat_formatting": OP1_SQL,
    "op4_minhash_dedup": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op7_embedding_dedup": OP7_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_url_filter": OP9_SQL,
    "op11_exact_dedup": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
