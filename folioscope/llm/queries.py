"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

from folioscope.llm import (
    chat_format,
    decontaminate,
    language_id,
    line_dedup,
    near_dup,
    pieces,
    quality_rules,
    secrets,
    toxicity,
    warc,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_near_dup": near_dup.op2_near_dup,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_chat_format": chat_format.op4_chat_format,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_warc": warc.op6_warc,
    "op7_pieces": pieces.op7_pieces,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_language_id": language_id.op9_language_id,
    "op10_toxicity": toxicity.op10_toxicity,
}

#: Operators that SQL can't express (learned models, estimates, dropout) are tested by brute force instead.
SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op2_near_dup": near_dup.OP2_SQL,
    "op4_chat_format": chat_format.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op8_secret_scan": secrets.OP8_SQL,
}
