"""The registered query of every operator of this subpackage, and its SQL where SQL can express it."""

from __future__ import annotations

from . import (chat, conversation_repair, decontaminate, embedding_dedup, html_text, line_dedup, mixing, simhash,
               spelling, tokens, toxicity, url_filter, warc)

QUERIES = {
    "op1_tokens": tokens.query,
    "op2_mixing": mixing.query,
    "op3_warc": warc.query,
    "op4_toxicity": toxicity.query,
    "op5_line_dedup": line_dedup.query,
    "op6_chat": chat.query,
    "op7_simhash": simhash.query,
    "op8_decontaminate": decontaminate.query,
    "op9_embedding_dedup": embedding_dedup.query,
    "op10_html_text": html_text.query,
    "op11_spelling": spelling.query,
    "op12_conversation_repair": conversation_repair.query,
    "op13_url_filter": url_filter.query,
}

ORACLE_SQL = {
    "op2_mixing": mixing.SQL,
    "op3_warc": warc.SQL,
    "op5_line_dedup": line_dedup.SQL,
    "op6_chat": chat.SQL,
    "op9_embedding_dedup": embedding_dedup.SQL,
    "op11_spelling": spelling.SQL,
    "op12_conversation_repair": conversation_repair.SQL,
    "op13_url_filter": url_filter.SQL,
}
