"""The registered queries of this subpackage and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from foliant.llm import bpe, chat, decontaminate, exact_dedup, packing, quality, secrets, simhash, toxicity, warc

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_quality": quality.op3_quality,
    "op4_simhash": simhash.op4_simhash,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_packing": packing.op6_packing,
    "op7_warc": warc.op7_warc,
    "op8_chat": chat.op8_chat,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_secrets": secrets.op10_secrets,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op7_warc": warc.OP7_SQL,
    "op8_chat": chat.OP8_SQL,
    "op10_secrets": secrets.OP10_SQL,
}
