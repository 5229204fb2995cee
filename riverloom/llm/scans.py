"""Problem 3: noise in the text of scanned pages, found by class and repaired into paragraphs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import quality
from .boosting import Boosted
from .common import cut, map_columns

# What a scanner reads for a letter or a pair of letters.
CONFUSIONS = [
    ("o", "0"), ("ó", "6"), ("é", "6"), ("l", "1"), ("l", "|"), ("l", "!"), ("i", "1"), ("i", "!"), ("i", "|"), ("í", "!"), ("t", "†"), ("a", "@"), ("s", "5"), ("b", "6"), ("g", "9"), ("q", "9"),
    ("B", "8"), ("S", "5"), ("O", "0"), ("I", "1"), ("I", "|"), ("Z", "2"), ("e", "c"), ("c", "e"), ("r", "ı"), ("m", "rn"), ("rn", "m"), ("n", "ri"), ("ri", "n"), ("u", "ii"), ("ú", "ii"), ("h", "li"),
    ("h", "b"), ("d", "cl"), ("cl", "d"), ("ci", "d"), ("vv", "w"), ("w", "vv"), ("n", "u"), ("u", "n"), ("f", "t"), ("i", "l"), ("l", "i"), ("in", "m"), ("m", "in"), ("nn", "m"), ("m", "nn"), ("ll", "U"), ("tí", "ü"), ("y", "v"), ("ñ", "fi"), ("ñ", "ri"),
]
_PAIRS = frozenset(CONFUSIONS)
_SYMBOL = re.compile(r"[0-9@#!|†‡ı$¢]")
_STRIP = ".,;:!?¿¡«»“”„‘’()[]{}…\"'—–-‐¬\xad|·•*/\\<>=+ "
_KEEP_END = ".,;:?¿«»“”„‘’()[]{}…\"'—–-‐¬\xad·•*/\\<>=+ "
_PLAIN = re.compile(r"^[^\W\d_]+(?:[-’'][^\W\d_]+)*$")
_INSIDE = re.compile(r"^[^\W\d_]*(?:[^\W\d_][0-9@#!|†‡ı]{1,2}[^\W\d_]|[^\W\d_]{3,}[01569|!†@#]$|^[015689@#|!†][^\W\d_]{3,})[\w@#!|†‡ı]*$")
_ADDRESS = re.compile(r"www\.|://|\w@\w+\.|\.\w{2,}\.|\.example|\.[a-z]{3}$|^\d|[A-Z]\d|=|/|_")
MARKS = "-‐¬\xad⁻‑"
_BROKEN = re.compile(rf"([^\W\d_]+)([{MARKS}]) ?$")
_PAGE = re.compile(
    r"^[\W_]*(?:(?:p|pp|p[áa]g|page|p[áa]gina|seite|s|hoja|folio)\b\.?\s*)?(?P<n>\d{1,6}|[ivxlc]{1,7})[\W_]*$", re.I
)
_PAGE_HEAD = re.compile(r"(?:\s{2,}|\s*[|·—–-]\s+)(?P<n>\d{1,6})\s*$|^\s*(?P<m>\d{1,6})(?:\s{2,}|\s*[|·—–]\s*)(?=\S)")
_RECORD = re.compile(r"^\W*\d[\d.,   ]*[.,]\d[\d.,   ]*\W*$")
_WORDS = re.compile(r"[^\W\d_]+")
#: Stands before a mark at the end of a line as long as it isn't decided whether it breaks a word.
JOINT = "\ufdd0"
_JOINTS = re.compile(rf"([^\W\d_]+){JOINT}[-‑](?=([^\W\d_]+))")
_TERMINAL = frozenset(".!?…:»”\")")


# ---------------------------------------------------------------------------------------------
# line pairs


def _source_words(source: str | None, place: str | None) -> frozenset[str]:
    s = f"{source or ''} {place or ''}".replace("_", " ").lower()
    return frozenset(w for w in _WORDS.findall(s) if len(w) > 2)


def line_features(line: str, before: str, after: str, first: bool, last: bool, blank: bool, about: frozenset[str], width: int) -> list[float]:
    """Features of a line between its neighbours."""
    s = line.strip()
    ws = _WORDS.findall(s)
    low = [w.lower() for w in ws]
    n = max(1, len(ws))
    caps = sum(w[0].isupper() for w in ws) / n
    near = sum(w in about or any(len(w) == len(a) and sum(x != y for x, y in zip(w, a)) <= 1 for a in about if a[:1] == w[:1] or a[-1:] == w[-1:]) for w in low if len(w) > 2)
    long = sum(len(w) > 2 for w in low)
    head = _PAGE_HEAD.search(s)
    return [
        near / max(1, long), min(near, 5), caps, float(s.isupper()), len(s) / max(20, width), float(len(ws)),
        float(bool(s) and s[-1] in _TERMINAL or s.endswith(",")), float(bool(before) and before.rstrip()[-1:] not in _TERMINAL), float(after[:1].islower()), float(first), float(last), float(blank),
        float("|" in s or " – " in s or ": " in s or "·" in s), float(bool(head)), float(bool(re.search(r"\b(?:19|20)\d\d\b", s))), float(s[:1].isupper() or s[:1].isdigit()),
    ]


def is_page_number(line: str, before: str, after: str, alone: bool) -> bool:
    """A line that holds a page number and nothing else; numbers of records stand together or have separators."""
    m = _PAGE.match(line.strip())
    if not m or len(line.strip()) > 24:
        return False
    token = m["n"]
    if not token.isdigit():
        # roman numerals stand alone and in lower case or within dashes
        return alone and bool(re.fullmatch(r"x{0,4}(?:l?x{0,3})(?:ix|iv|v?i{0,3})", token.lower())) and (token.islower() or line.strip() != token)
    bare = line.strip() == token
    if line.strip().endswith((".", ",", ")", "?", "!")) and not line.strip().startswith(("(", "[", "-", "—")) and not re.match(r"^\s*(?:p|s)", line.strip(), re.I):
        return False
    return alone or not bare


def _furniture_lines(source: str | None, place: str | None, rng: random.Random, page: int) -> str:
    """A running header as pages carry it, for training."""
    words = (source or "").rsplit(".", 1)[0].split("_")
    title = " ".join(words[:-1]) if len(words) > 2 else "Nota de campo Villa Alta 2010"
    year = re.search(r"(?:19|20)\d\d", title)
    title = re.sub(r" ?(?:19|20)\d\d.*", "", title)
    parts = title.split(" ")
    k = max(1, len(parts) - 2)
    kind, where = " ".join(parts[:k]), " ".join(parts[k:])
    org = (place or "archivo central").replace("_", " ")
    y = year[0] if year else "2010"
    s = rng.choice(
        [org.upper(), org.title(), f"{org.title()} | {kind}", f"{kind} – {where}", f"{kind} {where} {y}".upper(), f"{kind} {y}, {where}", f"{where}: {kind.lower()}", f"{kind} {where}".upper()]
    )
    return rng.choice([s, s, s, f"{page} | {s}", f"{s}   {page}", f"{s} — {page}"])


def train_lines(rows: list[tuple[str, str | None, str | None]], seed: int = 5) -> Boosted:
    """Header classifier: running headers set into wrapped texts of the sample against their other lines."""
    rng = random.Random(seed)
    x, y = [], []
    for text, source, place in rows[:1500]:
        flat = re.sub(r"\s+", " ", text).strip()
        if len(flat) < 120:
            continue
        width = rng.randint(44, 76)
        lines, line = [], ""
        for w in flat.split(" "):
            if line and len(line) + 1 + len(w) > width:
                lines.append(line)
                line = w
            else:
                line = f"{line} {w}".strip()
        lines.append(line)
        about = _source_words(source if rng.random() < 0.9 else None, place if rng.random() < 0.9 else None)
        at = rng.choice([0, len(lines), rng.randint(0, len(lines))])
        lines.insert(at, _furniture_lines(source, place, rng, rng.randint(1, 900)))
        others = rng.sample(range(len(lines)), min(3, len(lines)))
        for i in {at, *others}:
            f = line_features(lines[i], lines[i - 1] if i else "", lines[i + 1] if i + 1 < len(lines) else "", i == 0, i == len(lines) - 1, rng.random() < 0.3, about, width)
            x.append(f)
            y.append(float(i == at))
            if len(lines) > 3 and i != at and rng.random() < 0.2:  # headings and items that aren't furniture
                t = rng.choice(["Contexto regional", "Recomendaciones finales", "Regional context", "Empfehlungen", "- sensor", "1. mapa", "Bilan 2010", "Resumo do período 2003"])
                x.append(line_features(t, lines[i - 1], lines[i], False, False, rng.random() < 0.5, about, width))
                y.append(0.0)
    if len(set(y)) < 2:
        return Boosted(trees=0)
    return Boosted(trees=40).fit(np.array(x), np.array(y))


class LineModel:
    def __init__(self, headers: Boosted, words: dict[str, int]):
        self.headers, self.words = headers, words

    def analyse(self, text: str, source: str | None, place: str | None) -> tuple[set[str], str, list[str]]:
        """(classes of layout noise, text without it in paragraphs, the lines left out)."""
        return self.analyse_all([(text, source, place)])[0]

    def analyse_all(self, rows: list[tuple[str, str | None, str | None]], broken: list[set[tuple[str, str]]] | None = None) -> list[tuple[set[str], str, list[str]]]:
        """The same for a batch: all its lines go through the header classifier at once.

        ``broken`` has the pairs of word parts of each row that are one broken word; without it, hyphens
        at the end of a line stay undecided and have JOINT before them. Lists, tables and junk (problem 5) have no running text that a page could break, and stay as they are.
        """
        states = [self._lines(*r) if "\n" in r[0] else None for r in rows]
        tests = [f for s in states if s for _, f in s[4]]
        p = iter(self.headers.predict(np.array(tests)).tolist() if tests else ())
        return [self._finish(r[0], s, [next(p) for _ in s[4]], b) if s else (set(), r[0], []) for r, s, b in zip(rows, states, broken or [None] * len(rows))]

    def _lines(self, text: str, source: str | None, place: str | None):
        """Lines, blank neighbours, page numbers and the lines that may be headers, with their features."""
        raw = text.replace("\r\n", "\n").split("\n")
        lines = [x for x in raw if x.strip()]
        if len(lines) < 2:
            return None
        width = max(map(len, lines))
        blank = [False] * len(lines)
        if len(lines) < len(raw):
            k = -1
            for i, x in enumerate(raw):
                if x.strip():
                    k += 1
                    if i and not raw[i - 1].strip() or i + 1 < len(raw) and not raw[i + 1].strip():
                        blank[k] = True
        drop = [False] * len(lines)
        about = None
        tests: list[tuple[int, list[float]]] = []
        page = False
        for i, x in enumerate(lines):
            s = x.strip()
            if len(s) <= 24 and _PAGE.match(s):
                before, after = lines[i - 1] if i else "", lines[i + 1] if i + 1 < len(lines) else ""
                alone = not _RECORD.match(before) and not _RECORD.match(after)
                if is_page_number(s, before, after, alone):
                    page = drop[i] = True
                    continue
            c = s[0]
            if len(s) <= 84 and (not c.isalnum() or c.isupper() or c.isdigit()) and s[-1] not in ".!?…,;»”":
                if about is None:
                    about = _source_words(source, place)
                before, after = lines[i - 1] if i else "", lines[i + 1].lstrip() if i + 1 < len(lines) else ""
                tests.append((i, line_features(x, before, after, i == 0, i == len(lines) - 1, blank[i], about, width)))
        return lines, blank, drop, page, tests, width

    def _finish(self, text: str, state, scores: list[float], broken: set[tuple[str, str]] | None) -> tuple[set[str], str, list[str]]:
        lines, blank, drop, page, tests, width = state
        found: set[str] = {"pagina"} if page else set()
        for (i, f), q in zip(tests, scores):
            if q > 0.5:
                drop[i] = True
                found.add("encabezado")
                if f[13]:
                    found.add("pagina")
        if found and quality.kinds([text], [False])[0][0] != "prosa":
            return set(), text, []
        kept = [x.strip() for x, d in zip(lines, drop) if not d]
        out: list[str] = []
        hyphens = False
        for j, x in enumerate(kept):
            more = j + 1 < len(kept)
            m = _BROKEN.search(x) if more and x[-1] in MARKS else None
            if m:
                nxt = kept[j + 1]
                r = re.match(r"[^\W\d_]+", nxt)
                if r and nxt[:1].islower():
                    if m[2] not in "-‑" or broken and (m[1].lower(), r[0].lower()) in broken:
                        found.add("guion")
                        out.append(x[: m.start(2)])
                    elif broken is None:
                        out.append(x[: m.start(2)] + JOINT + x[m.start(2) :])
                    else:
                        out.append(x)
                    hyphens |= m[2] in "-‑"
                    continue
            out.append(x)
            if more:
                out.append(" " if x[-1] not in _TERMINAL or len(x) > 0.6 * width else "\n")
        if (found or hyphens) and found <= {"guion"} and quality.kinds([text], [False])[0][0] != "prosa":
            return set(), text, []
        return found, "".join(out), [x for x, d in zip(lines, drop) if d]


# ---------------------------------------------------------------------------------------------
# words


def bare(token: str) -> str:
    """A token without the punctuation around it."""
    return token.strip(_KEEP_END)


def word_counts(fragments: DataFrame) -> DataFrame:
    """(word, n, clean, inline): tokens over all fragments, and those in formats that aren't scanned; compounds within tokens of the latter.

    Counted within each partition first, so that the shuffle carries a word once a partition.
    """
    ship(fragments.sparkSession)
    schema = "word string, n long, clean long, inline long"
    kind = pa.schema([("word", pa.string()), ("n", pa.int64()), ("clean", pa.int64()), ("inline", pa.int64())])

    def emit(all_: Counter, clean: Counter) -> pa.RecordBatch:
        n: Counter = Counter()
        c: Counter = Counter()
        inline: Counter = Counter()
        for t, k in all_.items():
            w = bare(t).lower()
            if len(w) > 1:
                n[w] += k
                c[w] += clean.get(t, 0)
            if "-" in t and t in clean:
                for x in _COMPOUND.findall(t):
                    inline[x.lower()] += clean[t]
        for w in inline:
            n[w] += 0
        return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), *(pa.array([x[w] for w in n], pa.int64()) for x in (n, c, inline))], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_: Counter = Counter()
        clean: Counter = Counter()
        for b in batches:
            for t, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t:
                    ws = t.split()
                    all_.update(ws)
                    if not f:
                        clean.update(ws)
            if len(all_) > 500_000:
                yield emit(all_, clean)
                all_.clear(), clean.clear()
        yield emit(all_, clean)

    parts = fragments.select("texto", scanned().alias("f")).mapInArrow(run, schema)
    return parts.groupBy("word").agg(*[F.sum(k).alias(k) for k in ("n", "clean", "inline")])


def _parts(d: dict[str, list]) -> dict[str, list]:
    """(form, l, r): the word parts beside each undecided hyphen of a form."""
    rows = [(f, m[1].lower(), m[2].lower()) for f in d["form"] for m in _JOINTS.finditer(f)]
    return {k: [r[i] for r in rows] for i, k in enumerate(("form", "l", "r"))}


def _decided(d: dict[str, list]) -> dict[str, list]:
    """(form, word, broken): the word that a form is, once its hyphens are decided, and whether one breaks a word.

    A word that needs no look for misreadings is null."""
    out: dict[str, list] = {"form": d["form"], "word": [], "broken": []}
    for f, xs in zip(d["form"], d["parts"]):
        yes = {(x["l"], x["r"]) for x in xs if x["broken"]}
        w = _JOINTS.sub(lambda m: m[1] if (m[1].lower(), m[2].lower()) in yes else m[0], f)
        b = bare(w.replace(JOINT, "")).lower()
        out["word"].append(b if len(b) > 3 and (not _ADDRESS.search(b) or _INSIDE.match(b)) else None)
        out["broken"].append(bool(yes))
    return out


def broken_words(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(l, r, broken): whether a hyphen at the end of a line breaks a word, or is a compound's own.

    A joined word that occurs speaks for a break; halves that are words, or a compound that occurs
    within lines, against it. All of it is looked up in the whole vocabulary of formats that aren't scanned.
    """
    l, r = F.col("l"), F.col("r")
    forms = {"joined": F.concat(l, r), "compound": F.concat(l, F.lit("-"), r), "left": l, "right": r, "feminine": F.expr("concat(left(l, length(l) - 1), 'a')")}
    keys = pairs.select("l", "r", F.explode(F.array(*[F.struct(F.lit(k).alias("role"), w.alias("word")) for k, w in forms.items()])).alias("x")).select("l", "r", "x.*")
    known = vocabulary.where("clean > 0 or inline > 0").select("word", (F.col("clean") > 0).alias("is_word"), (F.col("inline") > 0).alias("is_compound"))
    is_ = lambda k, c: F.coalesce(F.max(F.when(F.col("role") == k, F.col(c))), F.lit(False)).alias(k)
    g = keys.join(known, "word", "left").groupBy("l", "r").agg(*[is_(k, "is_compound" if k == "compound" else "is_word") for k in forms])
    whole = F.expr("left and right and length(l) > 2 and length(r) > 2")
    linked = F.expr("right and length(r) > 4 and length(l) > 3 and l rlike '[oe]$' and not left and feminine")
    return g.select("l", "r", (~F.col("compound") & (F.col("joined") | ~whole & ~linked)).alias("broken"))


def scanned() -> F.Column:
    """Fragments that may come from a scan: pdf in any spelling."""
    return F.coalesce(F.regexp_replace(F.lower("formato"), r"[^a-z]", "") == "pdf", F.lit(False))


def _middle(s: str, r: str) -> tuple[str, str]:
    """What is left of both words without their common start and end."""
    i = 0
    while i < len(s) and i < len(r) and s[i] == r[i]:
        i += 1
    j = 0
    while j < len(s) - i and j < len(r) - i and s[-1 - j] == r[-1 - j]:
        j += 1
    return s[i : len(s) - j], r[i : len(r) - j]


def pair_features(s: str, n: int, r: str, m: int) -> list[float]:
    """Features of a reading ``s`` seen ``n`` times against a candidate ``r`` seen ``m`` times."""
    a, b = _middle(s, r)
    known = (b, a) in _PAIRS
    if not known:  # one letter more of context, and two confusions in one word
        i = s.find(a) if a else 0
        known = any((r[max(0, i - k) : i + len(b) + e], s[max(0, i - k) : i + len(a) + e]) in _PAIRS for k in (0, 1) for e in (0, 1))
    symbol = bool(_SYMBOL.search(s)) and not _SYMBOL.search(r)
    hole = "#" in a
    two = len(a) > 2 and len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 2 and all((y, x) in _PAIRS or x == "#" for x, y in zip(a, b) if x != y)
    grams = lambda w: {f"^{w}$"[i : i + 3] for i in range(len(w))}
    gs, gr = grams(s), grams(r)
    return [
        float(known), float(symbol), float(hole), float(two), math.log1p(m) - math.log1p(n), math.log1p(m), math.log1p(n), float(len(a)), float(len(b)), float(len(r)),
        len(gs & gr) / max(1, len(gs | gr)), float(bool(a) and bool(b) and a.isalpha()), float(s[:1] != r[:1]),
    ]


def misread(word: str, rng: random.Random) -> str | None:
    """A word with one misreading, for training."""
    ways = [(a, b) for a, b in CONFUSIONS if a in word[0 if len(a) > 1 else 0 :]]
    if rng.random() < 0.12:
        i = rng.randrange(len(word))
        return word[:i] + "#" + word[i + 1 :]
    if not ways:
        return None
    a, b = rng.choice(ways)
    at = [m.start() for m in re.finditer(re.escape(a), word)]
    i = rng.choice(at)
    out = word[:i] + b + word[i + len(a) :]
    return out if out != word else None


def train_words(words: list[tuple[str, int]], seed: int = 3) -> Boosted:
    """Ranker of candidates: misreadings of frequent words against pairs of real words that look alike."""
    rng = random.Random(seed)
    pool = [(w, n) for w, n in words if w.isalpha() and len(w) >= 4][:4000]
    x, y = [], []
    for w, n in pool[:1500]:
        for _ in range(3):
            s = misread(w, rng)
            if s and _near(s, w):
                x.append(pair_features(s, max(1, int(n * rng.choice((0.002, 0.01, 0.03)))), w, n))
                y.append(1.0)
    index: dict[str, list[tuple[str, int]]] = {}
    for w, n in pool:
        index.setdefault(w[: len(w) // 2], []).append((w, n))
        index.setdefault("$" + w[(len(w) + 1) // 2 :], []).append((w, n))
    for group in index.values():
        for i, (a, n) in enumerate(group[:40]):
            for b, m in group[i + 1 : 40]:
                if a != b and abs(len(a) - len(b)) <= 2 and _near(a, b):
                    lo, hi = sorted(((n, a), (m, b)))
                    k = rng.choice((1, 1, 0.2, 0.05))  # rarer names than the sample holds
                    x.append(pair_features(lo[1], max(1, int(lo[0] * k)), hi[1], hi[0]))
                    y.append(0.0)
    for w, n in pool[:1200]:  # letters changed without cause
        i = rng.randrange(len(w))
        s = w[:i] + rng.choice("aeioulnrstdmbpvz") + w[i + 1 :]
        if s != w:
            f = pair_features(s, rng.randint(1, max(2, n // 20)), w, n)
            if not f[0]:
                x.append(f)
                y.append(0.0)
    if len(set(y)) < 2:
        return Boosted(trees=0)
    return Boosted(trees=50).fit(np.array(x), np.array(y))


def _near(a: str, b: str) -> bool:
    x, y = _middle(a, b)
    return max(len(x), len(y)) <= 2


def _grams(w: F.Column) -> F.Column:
    """Padded character 3-grams of a word."""
    p = F.concat(F.lit("^"), w, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, 3)))


#: One misreading spoils at most so many 3-grams of the word read, and one less of the true word.
SPOILT = 4
#: Words up to LONG letters have deletion keys, and words of more than SHORT their rarest 3-grams; lengths two apart always share a kind of key.
SHORT, LONG = 5, 7


def _gaps(w: F.Column) -> F.Column:
    """A word without up to two letters at each place: what two words share that one misreading parts."""
    spans = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.transform(F.sequence(F.lit(0), F.length(w) - k), lambda i: F.struct(i.alias("i"), k.alias("k")))))
    return F.array_distinct(F.transform(spans, lambda x: F.concat(F.substring(w, F.lit(1), x["i"]), F.lit("_"), F.substring(w, x["i"] + x["k"] + 1, F.length(w)))))


def candidates(readings: DataFrame, reference: DataFrame) -> DataFrame:
    """(word, n, candidate, m): pairs that one misreading parts, and most within two edits, by inverted joins.

    Two words that one misreading parts share all but SPOILT 3-grams, so the SPOILT + 1 rarest of one
    and of the other have one in common (prefix filtering). Short words have few 3-grams, frequent ones
    among them, which would bring a large part of the vocabulary together; they are joined by what is
    left of them without the letters in question, a key that few words share.
    """
    grams = reference.where(F.length("candidate") > SHORT).select(F.explode(_grams(F.col("candidate"))).alias("g")).groupBy("g").count()

    def rare(df: DataFrame, key: str, keep: str) -> DataFrame:
        own = df.where(F.length(key) > SHORT).withColumn("g", F.explode(_grams(F.col(key))))
        ranked = own.join(grams, "g", "left").groupBy(key, keep).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("c"), "g"))).alias("gs"))
        return ranked.select(key, keep, F.explode(F.slice("gs", 1, SPOILT + 1)).alias("x")).where("x.c > 0").select(key, keep, F.col("x.g").alias("g"))

    def gaps(df: DataFrame, key: str, keep: str) -> DataFrame:
        return df.where(F.length(key) <= LONG).select(key, keep, F.explode(_gaps(F.col(key))).alias("g"))

    near = (F.abs(F.length("word") - F.length("candidate")) <= 2) & (F.col("word") != F.col("candidate")) & (F.col("m") > F.col("n"))
    long_ = rare(readings, "word", "n").join(rare(reference, "candidate", "m"), "g").where(near)
    short = gaps(readings, "word", "n").join(gaps(reference, "candidate", "m"), "g").where(near)
    pairs = long_.unionByName(short).select("word", "n", "candidate", "m").distinct()
    return pairs.where(F.levenshtein("word", "candidate", 2) >= 0)


def corrections(readings: DataFrame, reference: DataFrame, ranker: Boosted) -> DataFrame:
    """(word, correction, score): the best candidate of each misread word; null where only a symbol inside tells."""
    shared = readings.sparkSession.sparkContext.broadcast(ranker)

    def score(d: dict[str, list]) -> dict[str, list]:
        x = [pair_features(*r) for r in zip(d["word"], d["n"], d["candidate"], d["m"])]
        p = shared.value.predict(np.array(x)) if x else np.zeros(0)
        return {"word": d["word"], "correction": d["candidate"], "score": p.tolist()}

    scored = map_columns(candidates(readings, reference), ["word", "n", "candidate", "m"], "word string, correction string, score double", score).where("score > 0.5")
    best = scored.groupBy("word").agg(F.max_by("correction", F.struct("score", "correction")).alias("correction"), F.max("score").alias("score"))
    odd = readings.where(F.col("word").rlike(r"^\p{L}*(\p{L}[0-9@#!|†‡ı]{1,2}\p{L}|\p{L}{3,}[0-9@#!|†]$|^[0-9@#|!†]\p{L}{3,})[\p{L}0-9@#!|†‡ı]*$") & ~F.col("word").rlike(r"\d.*\d.*\d|^\d+\p{L}{1,2}$"))
    bare_ = odd.join(best, "word", "left_anti").select("word", F.lit(None).cast("string").alias("correction"), F.lit(0.5).alias("score"))
    return best.unionByName(bare_)


# ---------------------------------------------------------------------------------------------

#: Words that don't need a look: the most frequent ones of formats that aren't scanned. A proven bound for what is broadcast.
KNOWN_WORDS = 65_536
_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")


def _scan(fragments: DataFrame, sample: int):
    """(classes and readings by fragment, vocabulary, ranker, line model, parts of broken words by fragment) over all pdf fragments."""
    spark = fragments.sparkSession
    vocabulary = cut(word_counts(fragments))
    top = [(r.word, r.n) for r in vocabulary.where("clean > 0").orderBy(F.desc("clean"), "word").limit(KNOWN_WORDS).collect()]
    every = max(1, fragments.count() // sample)
    picked = fragments.where(F.col("texto").isNotNull() & ~scanned() & (F.pmod(F.xxhash64("chunk_id"), F.lit(every)) == 0))
    rows = [(r.texto, r.fuente, r.observatorio) for r in picked.select("texto", "fuente", "observatorio").limit(2 * sample).collect()]
    known = dict(top)
    model = LineModel(train_lines(rows), known)
    ranker = train_words(top)
    shared = spark.sparkContext.broadcast(model)

    seen: dict[str, str] = {}

    def run(d: dict[str, list]) -> dict[str, list]:
        m = shared.value
        out: dict[str, list] = {"chunk_id": [], "clase": [], "word": [], "form": []}

        def emit(chunk_id: str, clase: str | None = None, word: str | None = None, form: str | None = None) -> None:
            out["chunk_id"].append(chunk_id), out["clase"].append(clase), out["word"].append(word), out["form"].append(form)

        known = m.words
        live = [(i, t, f, o) for i, t, f, o in zip(d["chunk_id"], d["texto"], d["fuente"], d["observatorio"]) if t and t.strip()]
        for (i, *_), (classes, flat, left) in zip(live, m.analyse_all([x[1:] for x in live])):
            for c in classes:
                emit(i, clase=c)
            ws = set(flat.split())
            for x in left:
                ws.update(x.split())
            for w in ws:
                if JOINT in w and _JOINTS.search(w):
                    emit(i, form=w)
                    continue
                if w in seen:
                    b = seen[w]
                else:
                    b = bare(w).lower()
                    b = seen[w] = b if b not in known and len(b) > 3 and (not _ADDRESS.search(b) or _INSIDE.match(b)) else ""
                    if len(seen) > 300_000:
                        seen.clear()
                if b:
                    emit(i, word=b)
        return out

    pdf = fragments.where(scanned())
    rows = cut(map_columns(pdf, ["chunk_id", "texto", "fuente", "observatorio"], "chunk_id string, clase string, word string, form string", run))
    forms = rows.where("form is not null").select("chunk_id", "form")
    parts = map_columns(forms.select("form").distinct(), ["form"], "form string, l string, r string", _parts)
    parts = cut(parts.join(broken_words(parts.select("l", "r").distinct(), vocabulary), ["l", "r"]))
    by_form = parts.groupBy("form").agg(F.collect_list(F.struct("l", "r", "broken")).alias("parts"))
    decided = forms.join(map_columns(by_form, ["form", "parts"], "form string, word string, broken boolean", _decided), "form")
    none = F.lit(None).cast("string")
    found = rows.where("form is null").select("chunk_id", "clase", "word")
    found = found.unionByName(decided.where("word is not null").select("chunk_id", none.alias("clase"), "word"))
    found = found.unionByName(decided.where("broken").select("chunk_id", F.lit("guion").alias("clase"), none.alias("word")))
    return cut(found.distinct()), vocabulary, ranker, shared, forms.join(parts.where("broken"), "form").select("chunk_id", "l", "r")


def _corrected(found: DataFrame, vocabulary: DataFrame, ranker: Boosted) -> DataFrame:
    readings = found.where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    readings = readings.join(vocabulary.where("clean > 0").select("word"), "word", "left_anti")
    plain = r"^\p{L}+([-’']\p{L}+)*$"
    reference = vocabulary.where(F.col("word").rlike(plain) & (F.length("word") >= 4) & ((F.col("clean") > 0) | (F.col("n") >= 20)))
    return corrections(readings, reference.select(F.col("word").alias("candidate"), F.col("n").alias("m")), ranker)


def found(fragments: DataFrame, sample: int = 1500) -> DataFrame:
    """p3_found: (chunk_id, clase) with guion, caracter, encabezado or pagina.

    Only pdf fragments are scans. Null and blank texts give no row; repeats of a fragment give one row
    a class. Models are fitted on at most ``2 * sample`` fragments of other formats and on the bounded
    list of KNOWN_WORDS; word counts, and with them what is a broken word or a compound, cover all fragments.
    """
    rows, vocabulary, ranker, _, _ = _scan(fragments, sample)
    bad = _corrected(rows, vocabulary, ranker).select("word")
    char = rows.where("word is not null").join(bad, "word", "left_semi").select("chunk_id", F.lit("caracter").alias("clase"))
    return rows.where("clase is not null").select("chunk_id", "clase").unionByName(char.distinct())


def repaired(fragments: DataFrame, sample: int = 1500) -> DataFrame:
    """Readable paragraphs of each distinct pdf fragment -> (chunk_id, texto, clases).

    Headers and page numbers are left out, broken words joined, misread words replaced by their best
    candidate. Other formats, null and blank texts give no row.
    """
    rows, vocabulary, ranker, shared, broken = _scan(fragments, sample)
    fixes = _corrected(rows, vocabulary, ranker).where("correction is not null")
    by = rows.where("word is not null").join(fixes, "word").groupBy("chunk_id").agg(F.collect_list(F.struct("word", "correction")).alias("fixes"))
    parts = broken.groupBy("chunk_id").agg(F.collect_set(F.struct("l", "r")).alias("broken"))
    pdf = fragments.where(scanned() & F.col("texto").isNotNull()).select("chunk_id", "texto", "fuente", "observatorio")
    pdf = pdf.join(by, "chunk_id", "left").join(parts, "chunk_id", "left")

    def run(d: dict[str, list]) -> dict[str, list]:
        m = shared.value
        out: dict[str, list] = {"chunk_id": [], "texto": [], "clases": []}
        live = [x for x in zip(d["chunk_id"], d["texto"], d["fuente"], d["observatorio"], d["fixes"], d["broken"]) if x[1].strip()]
        broken = [{(r["l"], r["r"]) for r in x[5] or ()} for x in live]
        for (i, _, _, _, x, _), (classes, flat, _) in zip(live, m.analyse_all([x[1:4] for x in live], broken)):
            table = {r["word"]: r["correction"] for r in x or ()}
            if table:
                classes = classes | {"caracter"}
                flat = re.sub(r"\S+", lambda w: _replace(w[0], table), flat)
            out["chunk_id"].append(i), out["texto"].append(flat), out["clases"].append(sorted(classes))
        return out

    cols = ["chunk_id", "texto", "fuente", "observatorio", "fixes", "broken"]
    return map_columns(pdf, cols, "chunk_id string, texto string, clases array<string>", run).distinct()


def _replace(token: str, table: dict[str, str]) -> str:
    b = bare(token)
    c = table.get(b.lower())
    if c is None:
        return token
    c = c.upper() if b.isupper() else c.capitalize() if b[:1].isupper() else c
    return token.replace(b, c, 1)
