"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from ..session import load
from . import budget, encoding, language, leaks, quality, residue, scans, sentences, tokens


def queries():
    return {
        "p1_found": lambda s, d: language.found(load(s, d, "metadata")),
        "p1_languages": lambda s, d: language.languages(load(s, d, "metadata")).dropDuplicates(["chunk_id"]),
        "p2_found": lambda s, d: residue.found(load(s, d, "metadata")),
        "p2_windows": lambda s, d: residue.residue_windows(load(s, d, "metadata")),
        "p3_found": lambda s, d: scans.found(load(s, d, "metadata")),
        "p3_repaired": lambda s, d: scans.repaired(load(s, d, "metadata")),
        "p4_found": lambda s, d: encoding.found(load(s, d, "metadata")),
        "p4_repairs": lambda s, d: encoding.repairs(load(s, d, "metadata")).distinct(),
        "p5_found": lambda s, d: quality.found(load(s, d, "metadata")),
        "p5_statistics": lambda s, d: quality.text_statistics(load(s, d, "metadata")),
        "p6_found": lambda s, d: tokens.unusable_counts(load(s, d, "metadata")),
        "p6_estimates": lambda s, d: tokens.token_estimates(load(s, d, "metadata")),
        "p6_totals": lambda s, d: budget.totals(load(s, d, "metadata")),
        "p7_ids": lambda s, d: tokens.encode_corpus(load(s, d, "documents")),
        "p8_found": lambda s, d: leaks.found(load(s, d, "documents"), load(s, d, "evaluacion")),
        "p8_documents": lambda s, d: leaks.leaked_documents(load(s, d, "documents"), load(s, d, "evaluacion")),
        "p9_found": lambda s, d: sentences.sentence_units(load(s, d, "documents")),
        "p7_decoded": lambda s, d: tokens.decode_corpus(tokens.encode_corpus(load(s, d, "documents"))),
    }


def oracle_sql():
    return {
        "p6_found": """
            select distinct chunk_id from metadata
            where length(regexp_replace(coalesce(texto, ''), '\\s', '', 'g')) > 0
              and (num_tokens is null or num_tokens <= 0
                   or length(texto) < 1.5 * num_tokens or length(texto) > 12 * num_tokens)""",
        "p7_decoded": "select doc_id, coalesce(text, '') as text from documents",
    }
