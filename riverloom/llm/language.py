"""Problem 1: the language of each fragment and of each stretch of a mixed one, with a confidence."""

from __future__ import annotations

import functools
import itertools
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import quality, residue
from .common import cut, map_columns, spread
from .ngrams import chunks

LATIN = ("es", "en", "pt", "fr", "de")
# Frequent function words that start the fit; the rest is learnt from the table.
SEEDS = {
    "es": "el la los las de del que y en un una por con para se su al lo como más pero sus fue son está desde entre sin sobre según durante cuando también muy hasta este esta ya no es ha",
    "en": "the of and to in is was for on with at by from as that this are be has have which their its it an were or not but after during between about according near since been had who",
    "pt": "o a os as do da dos das de em no na nos nas um uma por com para se ao à que e não é foi são mais mas pelo pela também entre sem sobre segundo durante quando desde até este esta já sua seu",
    "fr": "le la les de des du et en un une dans pour par sur avec au aux que qui est a été son sa ses ce cette ne pas plus mais selon depuis entre sans pendant près leur il elle sont l d qu",
    "de": "der die das und den dem des ein eine einer in im von zu mit auf für ist nicht nach bei aus am an als auch es sich wird wurde seit zwischen ohne über durch um zum zur oder aber war sind",
}
# Names of the five languages; a region after - or _ is left out.
_NAMES = {
    "es": "es spa esp espanol castellano spanish espagnol spanisch espanhol castilian",
    "en": "en eng ingles english anglais englisch inglese",
    "pt": "pt por portugues portuguese portugais portugiesisch",
    "fr": "fr fra fre frances french francais franzosisch franzoesisch",
    "de": "de deu ger aleman german allemand deutsch alemao",
}
_BY_NAME = {w: k for k, v in _NAMES.items() for w in v.split()}
SCRIPTS = [
    ("ru", 0x0400, 0x0530), ("ar", 0x0600, 0x0780), ("hi", 0x0900, 0x0980), ("th", 0x0E00, 0x0E80), ("ja", 0x3040, 0x3100),
    ("zh", 0x3400, 0xA000), ("ko", 0xAC00, 0xD7B0), ("el", 0x0370, 0x0400), ("he", 0x0590, 0x0600),
]
OTHER = tuple(x[0] for x in SCRIPTS)
STATES = LATIN + OTHER
WORD = re.compile(r"[^\W\d_]+")
#: Cost of a change of language inside a sentence and between two, in nats.
SWITCH, SWITCH_SENTENCE = 9.0, 4.0
LEAST_WORDS, WHOLE, MARGIN = 4, 0.9, 4.0
CAP = 5.0
#: A text of which less than this share of the words was ever seen in its best language is in none of those that the model knows.
SEEN = 0.35
#: Rates in 10,000 under which a word or trigram says nothing of its language (log(1 + RARE) is 0.1); a rare word is scored by its trigrams, as an
#: unseen one. Rates don't change with the size of the table, from so many words and trigrams of a language on.
RARE, RARE_GRAM = 0.1, 0.02
LEAST_TOTAL, LEAST_GRAMS = 2000, 8000


#: Words, and what ends a piece.
TOKEN = re.compile(r"[^\W\d_]+|[.!?…](?=[\s\"»”’)\]])|[。！？]|\n\s*\n")


@lru_cache(4096)
def label(name: str | None) -> str | None:
    """One of the five codes for a label in any notation, else None."""
    if not name:
        return None
    s = "".join(c for c in unicodedata.normalize("NFD", name.strip().lower()) if unicodedata.category(c) != "Mn")
    return _BY_NAME.get(re.split(r"[-_ (]", s)[0]) if s else None


@lru_cache(1)
def _classes() -> np.ndarray:
    """By code point, as bits: characters of TOKEN's words, white space, letters, marks that may end a piece, what must follow them, marks that end one."""
    every = np.delete(np.arange(0x110000, dtype=np.uint32), slice(0xD800, 0xE000)).tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, dtype=np.uint8)
    for bit, some in enumerate((WORD.findall(every), re.findall(r"\s", every), filter(str.isalpha, every), ".!?…", "\"»”’)]", "。！？")):
        out[np.frombuffer("".join(some).encode("utf-32-le"), dtype=np.uint32)] |= 1 << bit
    return out


def coded(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words that TOKEN finds in all texts; of each word of the texts its place among them, its text, and whether it is the first of a piece: first in its text or after something that ends a piece."""
    parts = []
    in_text, firsts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=bool)]
    for i, some in chunks(texts):
        joined = "\n".join(some) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = _classes().take(codes)
        step = np.diff((kind & 1).view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if not len(starts):
            continue
        ending = (kind & 8 > 0) & np.append(kind[1:] & 18 > 0, False) | (kind & 32 > 0)
        # a blank line: a line break with nothing but white space before the next
        breaks = np.flatnonzero(codes == 10)
        ink = np.cumsum(kind & 2 == 0)[breaks]
        ending[breaks[:-1][ink[1:] == ink[:-1]]] = True
        letter = kind[starts] & 4 > 0
        ending[starts[~letter]] = True
        starts, ends = starts[letter], ends[letter]
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in some]), starts, side="right")
        ended = np.cumsum(ending)[starts]
        firsts.append((np.diff(text, prepend=-1) > 0) | (np.diff(ended, prepend=-1) > 0) & (np.arange(len(starts)) > 0))
        in_text.append(text + i)
        # words and what lies between them by turns, as code points of four bytes
        bounds = pa.array(4 * np.stack([starts, ends], axis=1).ravel(), pa.int64()).buffers()[1]
        every = pa.Array.from_buffers(pa.large_binary(), max(0, 2 * len(starts) - 1), [None, bounds, pa.py_buffer(codes)])
        parts.append(every.take(pa.array(np.arange(0, 2 * len(starts), 2))))
    words = pa.chunked_array(parts, pa.large_binary()).combine_chunks().dictionary_encode()
    return [w.decode("utf-32-le", "surrogatepass") for w in words.dictionary.to_pylist()], words.indices.to_numpy(), np.concatenate(in_text), np.concatenate(firsts)


def tokens(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``coded`` with every word itself."""
    words, at, text, first = coded(texts)
    return [words[i] for i in at.tolist()], text, first


_SEED_SETS = {k: set(v.split()) for k, v in SEEDS.items()}
#: Votes of a function word for its languages, in whole numbers.
VOTE = 60


class WordCounts:
    """Words of the pieces that function words label, counted by language; a text's other pieces go with its only language."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.votes: list[list[int]] = []
        self.table = np.zeros((0, len(LATIN)), dtype=np.int64)
        self.counts = np.zeros((0, len(LATIN)), dtype=np.int64)

    def _learn(self, tokens: list[str]) -> None:
        for w in itertools.filterfalse(self.ids.__contains__, tokens):
            v = w.lower()
            if v not in self.words:
                self.words[v] = len(self.votes)
                held = [v in _SEED_SETS[k] for k in LATIN]
                self.votes.append([x * VOTE // max(1, sum(held)) for x in held])
            self.ids[w] = self.words[v]
        self.table = np.concatenate([self.table, np.array(self.votes[len(self.table) :], dtype=np.int64).reshape(-1, len(LATIN))])

    def add(self, texts: list[str]) -> None:
        found, at, text, first = coded(texts)
        if not found:
            return
        try:
            ids = list(map(self.ids.__getitem__, found))
        except KeyError:
            self._learn(found)
            ids = list(map(self.ids.__getitem__, found))
        ids, begins = np.array(ids, dtype=np.int64)[at], np.flatnonzero(first)
        size, text = np.diff(np.append(begins, len(ids))), text[begins]
        votes = np.add.reduceat(self.table[ids], begins)
        order = np.sort(votes, axis=1)
        best = votes.argmax(1)
        # at least 0.15 votes a word, and over 1.5 times those of the next language
        sure = (size >= 4) & (100 * order[:, -1] >= 15 * VOTE * size) & (2 * order[:, -1] > 3 * order[:, -2])
        decided = np.zeros((len(texts), len(LATIN)), dtype=bool)
        decided[text[sure], best[sure]] = True
        only = decided.sum(1) == 1
        best = np.where(sure, best, decided.argmax(1)[text])
        counted = np.repeat(sure | (size >= 4) & only[text], size)
        at = ids[counted] * len(LATIN) + np.repeat(best, size)[counted]
        total = np.bincount(at, minlength=self.table.size).reshape(-1, len(LATIN))
        total[: len(self.counts)] += self.counts
        self.counts = total

    def rows(self) -> tuple[list[str], np.ndarray]:
        """The words with a count, and their counts by language."""
        some = np.flatnonzero(self.counts.any(1))
        words = list(self.words)
        return [words[i] for i in some], self.counts[some]


def _trigrams(word: str) -> list[str]:
    v = f" {word} "
    return [v[i : i + 3] for i in range(len(v) - 2)]


class LanguageModel:
    """Per-word scores of the Latin-script languages: rates over all fragments, character trigrams for words that are rare or unseen.

    Fitted on a list of texts, or by ``count_words`` on a table.
    """

    def __init__(self, texts: list[str] | None = None, counted: tuple[dict, list[int], dict, list[int]] | None = None):
        if counted is None:
            c = WordCounts()
            c.add(texts or [])
            words, n = c.rows()
            grams: dict[str, np.ndarray] = {}
            for w, x in zip(words, n):
                for g in _trigrams(w):
                    grams[g] = grams.get(g, 0) + x
            # also of no words
            counted = dict(zip(words, n.tolist())), n.sum(0).tolist(), {g: x.tolist() for g, x in grams.items()}, sum(grams.values(), np.zeros(len(LATIN), dtype=np.int64)).tolist()
        words, total, grams, gram_total = counted
        seeds = {w: [3 * (w in _SEED_SETS[k]) for k in LATIN] for w in set().union(*_SEED_SETS.values())}
        words = words | {w: [a + b for a, b in zip(x, words.get(w, [0] * len(LATIN)))] for w, x in seeds.items()}
        total = [n + 3 * len(_SEED_SETS[k]) for n, k in zip(total, LATIN)]
        self.rates = _rates(words, total, LEAST_TOTAL, RARE)
        self.grams = _rates(grams, gram_total, LEAST_GRAMS, RARE_GRAM)
        self.clear()

    def clear(self) -> None:
        """Forget the words seen, which changes no score."""
        self.memo: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, len(STATES)), dtype=np.float32)
        self.words: list[str] = []
        self.scores: dict[str, list[float]] = {}
        for g in sorted(set().union(*self.grams.values())):
            x = [math.log(self.grams[k].get(g, 0.0) + 2.0) for k in LATIN]
            self.scores[g] = [y - sum(x) / len(x) for y in x]

    def __getstate__(self):
        return {"rates": self.rates, "grams": self.grams}

    def __setstate__(self, s):
        self.__dict__.update(s)
        self.clear()

    def _latin(self, word: str) -> list[float]:
        w = word.lower()
        r = [math.log(self.rates[k].get(w, 0.0) + 1.0) for k in LATIN]
        if not any(w in self.rates[k] for k in LATIN):
            known = [self.scores[t] for t in _trigrams(w) if t in self.scores]
            r = [max(-1.0, min(1.0, 0.35 * sum(x))) for x in zip(*known)] if known else r
        mean = sum(r) / len(r)
        half = 0.5 if word[:1].isupper() and not word.isupper() else 1.0  # names say less
        return [max(-CAP, min(CAP, half * (x - mean))) for x in r]

    def word_row(self, word: str) -> np.ndarray:
        """Scores of one word; a script leaves only its own languages."""
        row = np.full(len(STATES), -12.0, dtype=np.float32)
        c = ord(word[0])
        if c < 0x370:
            row[: len(LATIN)] = self._latin(word)
            return row
        for k, a, b in SCRIPTS:
            if a <= c < b:
                row[STATES.index(k)] = 3.0
                if k == "zh":  # kanji may be Japanese
                    row[STATES.index("ja")] = 2.5
                return row
        row[:] = 0.0
        return row

    def ids(self, tokens: list[str]) -> list[int]:
        """Rows of the words in the score table."""
        try:
            return list(map(self.memo.__getitem__, tokens))
        except KeyError:
            for w in itertools.filterfalse(self.memo.__contains__, tokens):
                self.memo[w] = len(self.rows)
                self.rows.append(self.word_row(w))
                self.words.append(w.lower())
            return list(map(self.memo.__getitem__, tokens))

    def decode(self, words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Viterbi labels of the words of all texts; ``first`` marks the first word of a piece, ``sizes`` are words a text."""
        if len(self.rows) != len(self.table):
            self.table = np.stack(self.rows).astype(np.float32) if self.rows else self.table
        result = np.zeros(len(words), dtype=np.int8)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        order = np.argsort(sizes, kind="stable")
        for i in range(0, len(order), 512):
            group = order[i : i + 512]
            size = sizes[group]
            steps = int(size[-1])
            at_words = starts[group][None, :] + np.arange(steps)[:, None]
            live_all = np.arange(steps)[:, None] < size[None, :]
            at_words = np.where(live_all, at_words, starts[group][None, :])
            ids, begins = words[at_words], first[at_words]
            used = np.unique(ids)
            states = len(LATIN) if self.table[used, len(LATIN) :].max() <= 0 and (self.table[used, : len(LATIN)] > -12).all() else len(STATES)
            table = self.table[:, :states]
            score = table[ids[0]]
            came = np.zeros((steps, len(group)), dtype=np.int8)
            moved = np.zeros((steps, len(group), states), dtype=bool)
            for t in range(1, steps):
                live = t < size
                best = score.max(1)
                came[t] = score.argmax(1)
                jump = (best - np.where(begins[t], SWITCH_SENTENCE, SWITCH))[:, None]
                moved[t] = jump > score
                score = np.where(live[:, None], np.maximum(score, jump) + table[ids[t]], score)
                moved[t] &= live[:, None]
            state = score.argmax(1)
            path = np.zeros((steps, len(group)), dtype=np.int8)
            at = np.arange(len(group))
            for t in range(steps - 1, -1, -1):
                path[t] = state
                if t:
                    state = np.where(moved[t, at, state], came[t], state)
            result[at_words[live_all]] = path[live_all]
        return result


def _spans(text: str, path: np.ndarray, rows: np.ndarray) -> list[tuple[str, int, int, float]]:
    """Stretches of one language, word by word: (language, begin, end, confidence) in code points, from the first word to the last."""
    at = [m.span() for m in TOKEN.finditer(text) if m[0][0].isalpha()]
    cuts = np.flatnonzero(np.diff(path, prepend=-1))
    out = []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(path)]):
        total = rows[a:b].sum(0).astype(np.float64)
        own = total[path[a]]
        total[path[a]] = -np.inf
        out.append((STATES[path[a]], at[a][0], at[b - 1][1], _sure(own - total.max())))
    return out


def analyse(texts: list[str], model: LanguageModel, spans: bool = False) -> list[dict]:
    """Per text: ``main`` and ``confidence``, ``whole`` languages with a whole sentence, ``segments`` (language, first, last piece, confidence).

    With ``spans`` the segments are stretches of words, (language, begin, end, confidence) in code points, and
    a text in none of the known languages has the main language und.
    """
    if len(model.rows) > 300_000:
        model.clear()
    found, at, text_of, first = coded(texts)
    out: list[dict] = [{"main": None, "confidence": 0.0, "whole": [], "segments": []}] * len(texts)
    if not found:
        return out
    ids = np.array(model.ids(found), dtype=np.int64)[at]
    live, sizes = np.unique(text_of, return_counts=True)
    path = model.decode(ids, first, sizes).astype(np.int64)
    used = np.unique(ids)
    k = len(LATIN) if (model.table[used, len(LATIN) :] <= -12).all() else len(STATES)
    rows = model.table[:, :k][ids]
    begins = np.flatnonzero(first)
    pieces = np.bincount(np.searchsorted(live, text_of[begins]), minlength=len(live))
    piece_starts = np.concatenate([[0], np.cumsum(pieces)])
    words = np.diff(np.append(begins, len(path)))
    piece_of = np.repeat(np.arange(len(begins)), words)
    counts = np.bincount(piece_of * k + path, minlength=len(begins) * k).reshape(-1, k)
    sums = np.add.reduceat(rows, begins).astype(np.float64)
    lang = counts.argmax(1)
    at = np.arange(len(begins))
    rest = sums.copy()
    rest[at, lang] = -np.inf
    margin = sums[at, lang] - rest.max(1)
    full = (words >= LEAST_WORDS) & (counts[at, lang] >= WHOLE * words)
    shares = np.add.reduceat(counts, piece_starts[:-1])
    totals = np.add.reduceat(sums, piece_starts[:-1])
    mains = shares.argmax(1)
    rest = totals.copy()
    rest[np.arange(len(live)), mains] = -np.inf
    sure = totals[np.arange(len(live)), mains] - rest.max(1)
    word_starts = np.concatenate([[0], np.cumsum(sizes)])
    for j, i in enumerate(live.tolist()):
        a, b, main = piece_starts[j], piece_starts[j + 1], mains[j]
        if spans:
            lo, hi = word_starts[j], word_starts[j + 1]
            full_ = {int(main)} | {int(x) for x in np.unique(lang[a:b][full[a:b] & (margin[a:b] >= MARGIN)])}
            out[i] = {"main": STATES[main], "confidence": _sure(sure[j]), "whole": sorted(STATES[x] for x in full_), "segments": _spans(texts[i], path[lo:hi], rows[lo:hi])}
            if main < len(LATIN):
                known = model.rates[LATIN[main]]
                seen = sum(known.get(model.words[w], 0.0) >= RARE for w in ids[lo:hi]) / (hi - lo)
                if seen < SEEN:
                    out[i] = {"main": "und", "confidence": 1.0 - seen, "whole": [], "segments": [("und", 0, len(texts[i]), 1.0 - seen)]}
            continue
        own = lang[a:b]
        if (own == main).all():
            c = _sure(sure[j])
            out[i] = {"main": STATES[main], "confidence": c, "whole": [STATES[main]], "segments": [(STATES[main], 0, int(b - a - 1), c)]}
            continue
        whole = {int(main)} | {int(x) for x in np.unique(own[full[a:b] & (margin[a:b] >= MARGIN)])}
        segments: list[list] = []
        for n, (x, m) in enumerate(zip(own.tolist(), margin[a:b].tolist())):
            if segments and segments[-1][0] == x:
                segments[-1][2], segments[-1][3] = n, segments[-1][3] + m
            else:
                segments.append([x, n, n, m])
        out[i] = {
            "main": STATES[main],
            "confidence": _sure(sure[j]),
            "whole": sorted(STATES[x] for x in whole),
            "segments": [(STATES[x], f, t, _sure(m)) for x, f, t, m in segments],
        }
    return out


def _sure(margin: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, margin))))


def _rates(counts: dict[str, list[int]], total: list[int], least: int, rare: float) -> dict[str, dict[str, float]]:
    """By language the rates in 10,000, of what isn't rare in all of them."""
    each = {w: [1e4 * n / max(least, t) for n, t in zip(x, total)] for w, x in counts.items()}
    return {k: {w: x[i] for w, x in each.items() if x[i] and max(x) >= rare} for i, k in enumerate(LATIN)}


#: Words of a partition after which their counts are passed on.
MOST_WORDS = 500_000


def count_words(fragments: DataFrame) -> tuple[dict, list[int], dict, list[int]]:
    """What ``LanguageModel`` is fitted on, counted over all fragments: words and the sum of all words by language, trigrams and their sum.

    Everything is counted; of words and trigrams only those come to the driver that aren't rare, and so at most
    10,000 / RARE words a language, however large the table is.
    """
    ship(fragments.sparkSession)
    names = [f"n_{k}" for k in LATIN]
    schema = pa.schema([("palabra", pa.string()), *((x, pa.int64()) for x in names)])

    def emit(c: WordCounts) -> Iterator[pa.RecordBatch]:
        words, n = c.rows()
        for i in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(words[i : i + 50_000], pa.string()), *(pa.array(x) for x in n[i : i + 50_000].T)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = WordCounts()
        for b in batches:
            c.add(b.column(0).to_pylist())
            if len(c.ids) > MOST_WORDS:
                yield from emit(c)
                c.clear()
        yield from emit(c)

    texts = fragments.where(F.col("texto").isNotNull())
    ddl = "palabra string, " + ", ".join(f"{x} bigint" for x in names)
    sums = [F.sum(x).alias(x) for x in names]
    words = cut(spread(texts.select("texto"), texts).mapInArrow(run, ddl).groupBy("palabra").agg(*sums))
    padded = F.concat(F.lit(" "), "palabra", F.lit(" "))
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("palabra")), lambda i: F.substring(padded, i, F.lit(3)))).alias("palabra"), *names)
    grams = cut(grams.groupBy("palabra").agg(*sums))

    def held(df: DataFrame, least: int, rare: float, always: frozenset = frozenset()) -> tuple[dict[str, list[int]], list[int]]:
        total = [n or 0 for n in df.agg(*sums).first()]
        often = functools.reduce(lambda a, b: a | b, (1e4 * F.col(x) >= rare * max(least, t) for x, t in zip(names, total)))
        return {r[0]: list(r[1:]) for r in df.where(often | F.col("palabra").isin(*always)).collect()}, total

    return *held(words, LEAST_TOTAL, 0.9 * RARE, frozenset().union(*_SEED_SETS.values())), *held(grams, LEAST_GRAMS, 0.9 * RARE_GRAM)


def _models(fragments: DataFrame):
    return fragments.sparkSession.sparkContext.broadcast((LanguageModel(counted=count_words(fragments)), residue.fit_residue(fragments)))


RESULT = "chunk_id string, etiqueta string, idioma string, confianza double, idiomas array<string>, tramos array<struct<idioma:string,desde:int,hasta:int,confianza:double>>, excluido boolean"


def _judge(d: dict[str, list], words: LanguageModel, res: residue.ResidueModel) -> tuple[list[bool], list[dict]]:
    """Which fragments aren't natural text, and what the others are written in, by sentences."""
    texts = [t or "" for t in d["texto"]]
    skip = [k != "prosa" for k, _ in quality.kinds(texts, res.flags(texts))]
    return skip, analyse(["" if s else t for t, s in zip(texts, skip)], words)


def languages(fragments: DataFrame) -> DataFrame:
    """Language of every fragment and of its stretches.

    -> (chunk_id, etiqueta, idioma, confianza, idiomas, tramos, excluido). ``etiqueta`` is the label's
    code or null when it names none of the five languages; ``idioma`` the main language, und for a text
    in none that the model knows; ``idiomas`` all with a whole sentence, ``tramos`` stretches of words by
    language, also within a sentence: code point offsets ``desde`` and ``hasta`` and a confidence each.
    ``excluido`` are fragments that aren't natural text (problems 2 and 5); they have a language too. Null
    and blank texts, and texts without words, have null languages. The models are fitted on all fragments.
    """
    shared = _models(fragments)

    def run(d: dict[str, list]) -> dict[str, list]:
        words, res = shared.value
        texts = [t or "" for t in d["texto"]]
        skip = [k != "prosa" for k, _ in quality.kinds(texts, res.flags(texts))]
        found = analyse(texts, words, True)
        return {
            "chunk_id": d["chunk_id"],
            "etiqueta": [label(x) for x in d["idioma"]],
            "idioma": [f["main"] for f in found],
            "confianza": [round(f["confidence"], 6) for f in found],
            "idiomas": [f["whole"] for f in found],
            "tramos": [[{"idioma": a, "desde": b, "hasta": c, "confianza": round(e, 6)} for a, b, c, e in f["segments"]] for f in found],
            "excluido": skip,
        }

    return map_columns(fragments, ["chunk_id", "texto", "idioma"], RESULT, run)


def found(fragments: DataFrame) -> DataFrame:
    """p1_found: (chunk_id, idioma) for each language with a whole sentence in a case.

    A fragment is a case if its label names none of the five languages or another than the main one,
    or if several languages have whole sentences. Repeats give one row each; a text without words is no case.
    """
    shared = _models(fragments)

    def run(d: dict[str, list]) -> dict[str, list]:
        skip, found = _judge(d, *shared.value)
        out: dict[str, list] = {"chunk_id": [], "idioma": []}
        for i, name, s, f in zip(d["chunk_id"], d["idioma"], skip, found):
            if not s and f["main"] and (len(f["whole"]) > 1 or label(name) != f["main"]):
                for k in f["whole"]:
                    if k in LATIN:
                        out["chunk_id"].append(i)
                        out["idioma"].append(k)
        return out

    return map_columns(fragments, ["chunk_id", "texto", "idioma"], "chunk_id string, idioma string", run).distinct()
