"""The subpackage's queries and their SQL, for the driver's entry module."""

import corpus_pipeline

from . import (
    op1_embedding_dedup,
    op2_chat_format,
    op3_mix_sources,
    op4_bpe,
    op5_quality,
    op6_warc,
    op7_ngram_join,
    op8_repeats,
    op9_html_text,
    op10_exact_dedup,
    op11_private_data,
    op12_spelling,
    op13_source_audit,
)

MODULES = {
    module.__name__.rpartition(".")[2]: module
    for module in (
        op1_embedding_dedup, op2_chat_format, op3_mix_sources, op4_bpe, op5_quality,
        op6_warc, op7_ngram_join, op8_repeats, op9_html_text, op10_exact_dedup,
        op11_private_data, op12_spelling, op13_source_audit,
    )
}


def queries() -> dict:
    return {name: getattr(module, name) for name, module in MODULES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {name: module.SQL for name, module in MODULES.items() if hasattr(module, "SQL")}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
