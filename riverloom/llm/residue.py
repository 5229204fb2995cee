"""Problem 2: template residue, filler, error pages and script notices instead of content."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import residue_text
from .common import map_columns, sum_arrays
from .ngrams import END, Batch, chunks, ratios

CLASSES = ("aviso", "relleno", "hueco")
ORDERS = ((3, 16), (5, 18))
#: Mean log ratio that a window needs; the coverage is the share of its characters in favour of residue.
WINDOW_LLR, COVERAGE, LEAST_CHARS = 0.5, 0.5, 13
#: Mean log ratio of a slot's SLOT_CHARS characters, where an exact check of notations follows.
SLOT_CHARS, SLOT_LLR = 4, 0.5
#: Turns of the fit; mean log ratio from which a window of the table is learnt from, and from which its text leaves the prose.
TURNS, LEARN_LLR, DOUBT_LLR = 4, 0.5, 0.1
#: Texts for which the module's own texts have their weight: counts over a larger table are scaled down to it, so that the weights don't change with its size.
WEIGHED = 3000
_SLOT = re.compile(
    r"(?<![«“\"'‘])(?:\{\{\s*[\w.]+\s*\}\}|[$#]\{\s*[\w.]+\s*\}|<%=?\s*[\w.]+\s*%>|\{[^\W\d][\w.]*\}|%[^\W\d]\w+%|\$[^\W\d]\w+\$|@@\s*\w+\s*@@"
    r"|\[\[\s*\w+\s*\]\]|\[[^\W\d]\w*\](?!\()|<[^\W\d]\w*>|&lt;[^\W\d]\w*&gt;|(?<!\w)__[^\W_][\w]*?__(?!\w)|\{%\s*\w+\s*%\}|%\([^\W\d]\w*\)s|::[^\W\d]\w*::|~[^\W\d]\w*_\w*~)(?![»”\"'’])"
)
_RENDERED = re.compile(r"(?<![\w/«“\"])(?:nan|NaN|NAN|null|NULL|None|NONE|undefined|UNDEFINED|#N/A|#REF!|N/D|\?\?\?|\[object Object\])(?![\w/»”\"])")
#: What every notation of ``_SLOT`` and ``_RENDERED`` holds: a mark or one of these words.
_MARK = re.compile(r"[{$<%@\[&_:~#?]")
_MARK_WORDS = ("nan", "NaN", "NAN", "N/D", "null", "Null", "NULL", "None", "NONE", "undefined", "UNDEFINED")


class Windows:
    """Windows of a batch: ``text`` index, ``begin`` and ``end`` within it, ``kind``, ``ratio``, ``cover``, ``peak`` of slots, ``residue``."""

    def __init__(self, **columns: np.ndarray):
        self.__dict__.update(columns)


def _counts(texts: list[str]) -> np.ndarray:
    """Counts of the hashed n-grams of both orders, one after the other."""
    out = np.zeros(sum(1 << bits for _, bits in ORDERS), dtype=np.int64)
    for _, some in chunks(texts, 1 << 20):
        b = Batch(some)
        out += np.concatenate([b.counts(o, bits) for o, bits in ORDERS])
    return out


class ResidueModel:
    """Log ratios of three residue models (notices, filler, slots) against natural prose, and the windows over them.

    The first fit takes the module's own texts against all texts of the table. Each further turn learns the
    residue that the table holds: windows that are beyond doubt join their class, and texts with a doubtful
    one leave the prose. ``tally`` counts over the whole table, given the model of the turn before; without
    it the table is the list ``prose``.
    """

    def __init__(self, prose: list[str] | None = None, tally: Callable[[ResidueModel | None], np.ndarray] | None = None):
        tally = tally or (lambda model: tallied(prose, model))
        n, whole = np.split(tally(None)[0], [1])
        share, told = min(1.0, WEIGHED / max(1, n[0])), max(2, min(WEIGHED, n[0]) // 75) * _counts(residue_text.TOLD)
        own, doubted, learnt = [_counts(c) for c in residue_text.training()], 0 * whole, [0 * whole] * len(CLASSES)
        for turn in range(TURNS):
            q = share * (whole - doubted) + told
            self.tables = self._tables([c + 2 * share * x for c, x in zip(own, learnt)], q)
            if turn < TURNS - 1:
                doubted, *learnt = tally(self)[:, 1:]

    @staticmethod
    def _tables(classes: list[np.ndarray], prose: np.ndarray) -> list[np.ndarray]:
        """Per order the log ratios of an n-gram in all classes side by side, as items of 16 bytes."""
        out, a = [], 0
        for _, bits in ORDERS:
            b = a + (1 << bits)
            t = np.zeros((1 << bits, 4), dtype=np.float32)
            for k, c in enumerate(classes):
                t[:, k] = ratios(c[a:b], prose[a:b])
            out.append(t.view(np.complex128).ravel())
            a = b
        return out

    def windows(self, texts: list[str]) -> Windows:
        """Sentences, lines and fields of the texts with the best class of each and whether they are residue."""
        parts = [(i, self._windows(some)) for i, some in chunks(texts or [""])]
        for i, w in parts:
            w.text += i
        return Windows(**{c: np.concatenate([vars(w)[c] for _, w in parts]) for c in vars(parts[0][1])})

    def _windows(self, texts: list[str]) -> Windows:
        b = Batch(texts)
        codes, n = b.codes, len(b.codes)
        h, g = (b.hashes(o, bits) for o, bits in ORDERS)
        # a window ends at a line break, or at a closing mark before white space
        zero = codes == 0
        space = (codes == 32) | (codes == 10) | (codes == 9) | zero | (codes == 13)
        nxt = np.append(space[1:], True)
        # nor does the full stop of a single letter end one
        letter = np.concatenate([[False, False], space[:-2]])
        stop = ((codes == 46) & ~letter | (codes == 33) | (codes == 63) | (codes == 0x2026) | (codes == 59)) & nxt
        ends = np.flatnonzero(stop | (codes == 10) | zero & np.append(codes[1:] != 0, True)) + 1
        begins = np.concatenate([[0], ends[:-1]])
        size = ends - begins
        llr = self.tables[0].take(h).view(np.float32) + self.tables[1].take(g).view(np.float32)
        llr = llr.reshape(-1, 4)
        llr[zero] = 0
        means = np.stack([np.add.reduceat(llr[:, k], begins) / (2 * size) for k in range(len(CLASSES))])
        kind = means.argmax(0).astype(np.int8)
        best = means.max(0)
        run = np.zeros(n, dtype=np.float32)
        slots = np.ascontiguousarray(llr[:, len(CLASSES) - 1])
        for j in range(SLOT_CHARS if n > SLOT_CHARS else 0):
            run[SLOT_CHARS:] += slots[SLOT_CHARS - j : n - j]
        peak = np.maximum.reduceat(run, begins) / (2 * SLOT_CHARS)
        text = np.searchsorted(b.starts, begins, side="right") - 1
        first = b.starts[text]
        sizes = np.diff(b.starts) - len(END)
        cover = np.zeros(len(ends))

        def covered(i: int) -> float:
            return np.count_nonzero(llr[begins[i] : ends[i], kind[i]] > 0) / size[i]

        # the coverage is looked at where the ratio or a slot speaks for residue
        for i in np.flatnonzero((best > min(WINDOW_LLR, LEARN_LLR)) & (size >= LEAST_CHARS)).tolist():
            cover[i] = covered(i)
        residue = (best > WINDOW_LLR) & (cover > COVERAGE) & (size >= LEAST_CHARS)
        found = Windows(text=text, begin=begins - first, end=np.minimum(ends - first, sizes[text]), kind=kind, ratio=best, cover=cover, peak=peak, residue=residue)
        # an exact check of what the slot windows found
        at = np.flatnonzero((peak > SLOT_LLR) & ~residue)
        for i, t, u, v in zip(at.tolist(), text[at].tolist(), np.maximum(0, found.begin[at] - 1).tolist(), (found.end[at] + 1).tolist()):
            piece = texts[t][u:v]
            if (_MARK.search(piece) or any(map(piece.__contains__, _MARK_WORDS))) and (_SLOT.search(piece) or _RENDERED.search(piece)):
                cover[i] = covered(i)
                residue[i], kind[i] = True, len(CLASSES) - 1
        return found

    def flags(self, texts: list[str]) -> list[bool]:
        """Whether each text holds residue."""
        out = np.zeros(len(texts), dtype=bool)
        if texts:
            w = self.windows(texts)
            out[w.text[w.residue]] = True
        return out.tolist()


def tallied(texts: list[str], model: ResidueModel | None) -> np.ndarray:
    """What a turn of the fit counts: without a model one row, of all texts; else of the texts with a doubtful window, then of the windows learnt for each class.

    Before the n-grams each row has how many texts or windows it counts. Tallies of parts of a table add up to that of the table.
    """
    if model is None:
        return np.stack([np.append(len(texts), _counts(texts))])
    w = model.windows(texts)
    long = w.end - w.begin >= LEAST_CHARS
    doubt = np.unique(w.text[w.residue | long & (w.ratio > DOUBT_LLR)]) if texts else []
    parts: list[list[str]] = [[texts[i] for i in doubt], *([] for _ in CLASSES)]
    for i in np.flatnonzero(long & (w.cover > COVERAGE) & (w.ratio > LEARN_LLR)):
        parts[1 + w.kind[i]].append(texts[w.text[i]][w.begin[i] : w.end[i]].strip())
    return np.stack([np.append(len(x), _counts(x)) for x in parts])


def fit_residue(fragments: DataFrame) -> ResidueModel:
    """Fit on the module's residue texts against all fragments as prose: each turn counts over the whole table."""
    texts = fragments.where(F.col("texto").isNotNull())
    context = fragments.sparkSession.sparkContext

    def tally(model: ResidueModel | None) -> np.ndarray:
        shared = context.broadcast(model)
        out = sum_arrays(texts, ["texto"], lambda d: tallied(d["texto"], shared.value), (1 if model is None else 1 + len(CLASSES), 1 + sum(1 << bits for _, bits in ORDERS)))
        shared.unpersist()
        return out

    return ResidueModel(tally=tally)


def residue_flags(fragments: DataFrame, model: ResidueModel) -> DataFrame:
    """(chunk_id, residuo) for every fragment; null and blank texts are false; repeats give one row."""
    shared = fragments.sparkSession.sparkContext.broadcast(model)

    def run(d: dict[str, list]) -> dict[str, list]:
        return {"chunk_id": d["chunk_id"], "residuo": shared.value.flags([t or "" for t in d["texto"]])}

    return map_columns(fragments, ["chunk_id", "texto"], "chunk_id string, residuo boolean", run)


def residue_windows(fragments: DataFrame) -> DataFrame:
    """Where the residue of each distinct fragment stands.

    -> (chunk_id, inicio, fin, clase, razon, cobertura): code point offsets of the window, aviso, relleno
    or hueco, the mean log ratio and the share of the window's characters in favour. Null and blank
    texts give no row.
    """
    shared = fragments.sparkSession.sparkContext.broadcast(fit_residue(fragments))

    def run(d: dict[str, list]) -> dict[str, list]:
        w = shared.value.windows([t or "" for t in d["texto"]])
        at = np.flatnonzero(w.residue).tolist()
        return {
            "chunk_id": [d["chunk_id"][w.text[i]] for i in at], "inicio": [int(w.begin[i]) for i in at], "fin": [int(w.end[i]) for i in at],
            "clase": [CLASSES[w.kind[i]] for i in at], "razon": [round(float(w.ratio[i]), 3) for i in at], "cobertura": [round(float(w.cover[i]), 3) for i in at],
        }

    return map_columns(fragments, ["chunk_id", "texto"], "chunk_id string, inicio int, fin int, clase string, razon double, cobertura double", run).distinct()


def found(fragments: DataFrame) -> DataFrame:
    """p2_found: fragments with at least one window of residue -> (chunk_id)."""
    return residue_flags(fragments, fit_residue(fragments)).where("residuo").select("chunk_id").distinct()


def keep(fragments: DataFrame, coverage: float = 0.0) -> DataFrame:
    """The corpus without fragments whose windows of residue cover more than ``coverage`` of the text; all columns stay.

    0, the default, leaves out every fragment with any residue. Null and blank texts stay.
    """
    w = residue_windows(fragments).groupBy("chunk_id").agg(F.sum(F.col("fin") - F.col("inicio")).alias("_n"))
    sizes = fragments.select("chunk_id", F.length("texto").alias("_len")).distinct()
    bad = w.join(sizes, "chunk_id").where(F.col("_n") > F.lit(coverage) * F.col("_len")).select("chunk_id")
    return fragments.join(bad, "chunk_id", "left_anti")
