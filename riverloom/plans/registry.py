"""All queries over the engine's own operators, and their SQL."""

from __future__ import annotations

from . import corpora, files, graphs, mapped, retrievals, texts, vectors

_ALL = texts.QUERIES | corpora.QUERIES | vectors.QUERIES | graphs.QUERIES | retrievals.QUERIES | mapped.QUERIES | files.QUERIES


def queries():
    return {k: f for k, (f, _) in _ALL.items()}


def oracle_sql():
    return {k: q for k, (_, q) in _ALL.items() if q}
