"""The registered queries of the subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from authorlink.llm import compression, divergence, iblt, langid, licenses, mixing, packing, pii, simhash, suffixes, toolcalls, topk, warc

_QUERIES = {
    "op1_best_fit_packing": (packing.op1_best_fit_packing, None),
    "op2_language_id": (langid.op2_language_id, None),
    "op3_source_mixing": (mixing.op3_source_mixing, mixing.OP3_SQL),
    "op4_tool_call_linking": (toolcalls.op4_tool_call_linking, toolcalls.OP4_SQL),
    "op5_suffix_dedup": (suffixes.op5_suffix_dedup, None),
    "op6_simhash_components": (simhash.op6_simhash_components, None),
    "op7_license_notices": (licenses.op7_license_notices, None),
    "op8_document_fingerprints": (iblt.op8_document_fingerprints, None),
    "op9_exact_topk": (topk.op9_exact_topk, topk.OP9_SQL),
    "op10_pii_spans": (pii.op10_pii_spans, None),
    "op11_source_divergence": (divergence.op11_source_divergence, divergence.OP11_SQL),
    "op12_vector_codes": (compression.op12_vector_codes, compression.OP12_SQL),
    "op13_warc_revisits": (warc.op13_warc_revisits, warc.OP13_SQL),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
