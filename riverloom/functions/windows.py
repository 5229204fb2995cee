"""Sentence windows by Arrow batches: what functions.text says in nested expressions, in one pass over each text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ABBREVIATIONS, RETRIEVAL
from ..session import ship
from .text import SENTENCE_BREAK, SENTENCE_END, SENTENCE_START

_BREAK = re.compile(SENTENCE_BREAK.replace("(?U)", "", 1))
_ABBREVIATION = re.compile(ABBREVIATIONS, re.I)
_START, _END = re.compile(SENTENCE_START), re.compile(SENTENCE_END)


def sentences(text: str) -> list[str]:
    """T3."""
    out: list[str] = []
    glue = False
    for piece in map(str.strip, _BREAK.split(text.strip())):
        if piece:
            if glue:
                out[-1] += " " + piece
            else:
                out.append(piece)
            glue = bool(_ABBREVIATION.search(piece))
    return out or [text.strip()]


def trimmed(text: str, kept_share: float = RETRIEVAL.kept_share) -> str:
    """T5."""
    text = text.strip()
    s = sentences(text)
    lo, hi = int(not _START.match(s[0])), len(s)
    if not _END.search(s[-1]) and hi - lo > 1:
        hi -= 1
    if len(s) < 2 or lo >= hi:
        return text
    cut = " ".join(s[lo:hi]).strip()
    return cut if len(cut.split()) >= kept_share * len(text.split()) else text


def windows(text: str, most: int = RETRIEVAL.max_words) -> list[str]:
    """T6 as a fold over sentences with their word counts."""
    text = text.strip()
    if len(text.split()) <= most:
        return [text]
    out: list[str] = []
    open_: list[tuple[str, int]] = []

    def close() -> None:
        out.append(" ".join(s for s, _ in open_))

    for s in sentences(text):
        n = len(s.split())
        if open_ and sum(k for _, k in open_) + n > most:
            close()
            last = open_[-1]
            open_ = [last] if len(open_) > 1 else []
            if open_ and last[1] + n > most:
                close()
                open_ = []
        if not open_ and n > most:
            out.append(" ".join(s.split()[:most]))
        else:
            open_.append((s, n))
    if open_:
        close()
    return out


def refined_windows(rows: DataFrame, text: str = "texto", most: int = RETRIEVAL.max_words) -> DataFrame:
    """Adds ``ventanas`` (windows of the trimmed text) and ``igual`` (one window, the text unchanged); null texts drop out."""
    ship(rows.sparkSession)
    keep = [c for c in rows.columns if c != text]
    source = rows.select(*keep, text).where(F.col(text).isNotNull())
    schema = ", ".join(f"`{c}` {t}" for c, t in source.select(*keep).dtypes) + ", ventanas array<string>, igual boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, same = [], []
            for t in b.column(len(keep)).to_pylist():
                clean = trimmed(t)
                w = windows(clean, most)
                found.append(w)
                same.append(len(w) == 1 and clean == t.strip())
            columns = [b.column(i) for i in range(len(keep))] + [pa.array(found, pa.list_(pa.string())), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ventanas", "igual"])

    return source.mapInArrow(run, schema)
