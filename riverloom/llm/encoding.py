"""Problem 4: text decoded with the wrong character encoding: find it, and restore it where possible."""

from __future__ import annotations

import heapq
import html
import re
from functools import lru_cache
from urllib.parse import unquote_to_bytes

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_columns

# ---------------------------------------------------------------------------------------------
# character plausibility

# Letters and marks of the Latin-script languages of the corpus.
_LETTERS = frozenset("áéíóúüñàâçèêëîïôùûœæãõäöß" + "ÁÉÍÓÚÜÑÀÂÇÈÊËÎÏÔÙÛŒÆÃÕÄÖ")
_MARKS = frozenset("¡¿«»“”„‘’‚–—…•°²³ªº·€§©®™½¼¾×−→←↑↓▪◦►●■□✓‹›′″ ​  ﻿£¶†‡\xad¬‐‑ı−")
_VOWEL_BEFORE_SS = frozenset("aeiouäöüyAEIOUÄÖÜY")
_OCR = frozenset("†‡ı¬\xad‐|#@!")
LOST = "�"


@lru_cache(1 << 16)
def cost(token: str) -> float:
    """Implausibility of a token: 0 for ASCII, little for the languages' own letters in place, much for the rest."""
    total = 4.0 * len(_ESCAPES.findall(token)) if not token.isalnum() else 0.0
    n = len(token)
    for i, c in enumerate(token):
        o = ord(c)
        if o < 128:
            if o < 32 and c not in "\t\n\r":
                total += 8
            continue
        before = token[i - 1] if i else " "
        after = token[i + 1] if i + 1 < n else " "
        if c in _LETTERS:
            total += 1
            if c in "æÆœŒ":
                total += 0.5
            if c.isupper() and before.islower():
                total += 4
            elif c == "ß" and before not in _VOWEL_BEFORE_SS:
                total += 4
            elif c in "ÃÂ" and (not after.isalpha() or ord(after) > 127) and not (i > 1 and before.isupper() and token[i - 2].isupper() or after == "O"):
                total += 3
        elif c in _MARKS:
            total += 1
            inside = before.isalpha() and after.isalpha()
            if inside and c not in "’‘·‐‑\xad¬†‡ı­":
                total += 5
            elif c in "½¼¾" and (before.isalpha() or after.isalpha()) or c in "‚£" and before.isalpha():
                total += 5
            elif c in "¡¿" and before.isalpha():
                total += 5
            elif c in "­ıı" or c == "\xa0":
                total += 2 if before.isalpha() and after.isalpha() else 0
        elif c == LOST:
            total += 12
        elif 0x80 <= o < 0xA0:
            total += 10
        elif o < 0x250 and c.isalpha() or 0x1E00 <= o < 0x1F00:  # letters of other Latin-script languages, where they may stand
            total += OTHER if c.islower() or not before.isalpha() and (after.islower() or not after.isalpha()) or before.isupper() else 5
        elif o < 0x250:
            total += 5
        elif 0x2500 <= o < 0x25A0:
            total += 8
        elif c.isalpha():
            latin = sum(x.isascii() and x.isalpha() for x in token)
            total += 6 if latin else 1.5
        else:
            total += 6 if before.isalpha() or after.isalpha() else 3
    return total


# ---------------------------------------------------------------------------------------------
# operations

_CHARSETS = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "iso8859_15")
_LETTER_ENTITY = r"&(?:#(?:1[6-9]\d|[2-9]\d\d|\d{4,5})|#x(?:[a-fA-F][0-9a-fA-F]|[0-9a-fA-F]{3,5})|[a-zA-Z]{1,2}(?:acute|grave|circ|tilde|uml|cedil|ring|slash|lig));"
_ENTITY = re.compile(_LETTER_ENTITY)
_PERCENT = re.compile(r"(?:%[89A-Fa-f][0-9A-Fa-f]){2,}")
_QUOTED = re.compile(r"(?:=[89A-F][0-9A-F]){2,}")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([89a-fA-F][0-9a-fA-F])")


@lru_cache(None)
def _byte_table(charset: str) -> dict[str, int]:
    """Byte of each character; bytes that cp1252 leaves undefined stand for themselves, as browsers do."""
    table = {}
    for b in range(256):
        try:
            table[bytes([b]).decode(charset)] = b
        except UnicodeDecodeError:
            table[chr(b)] = b
    if charset in ("cp1252", "latin-1", "cp1251", "iso8859_15"):
        table.setdefault("\xa0", 0xA0)
    return table


def _encode(s: str, charset: str) -> bytes | None:
    t = _byte_table(charset)
    try:
        return bytes([t[c] for c in s])
    except KeyError:
        return None


def neighbours(s: str):
    """(operation, string) reachable by one encode-decode or unescape step."""
    if _ENTITY.search(s) and (u := _ENTITY.sub(lambda m: html.unescape(m[0]), s)) != s:
        yield "html", u
    if m := _ESCAPE.search(s):
        u = _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)), s)
        if u != s:
            yield "escape", u
    for name, pat, lead in (("percent", _PERCENT, "%"), ("quoted", _QUOTED, "=")):
        if pat.search(s):
            for charset in ("utf-8", "cp1252"):
                try:
                    yield name, pat.sub(lambda m: unquote_to_bytes(m[0].replace(lead, "%")).decode(charset), s)
                    break
                except UnicodeDecodeError:
                    continue
    if s.isascii():
        return
    for charset in _CHARSETS:
        raw = _encode(s, charset)
        if raw is None:
            continue
        try:
            yield f"{charset}>utf-8", raw.decode("utf-8")
        except UnicodeDecodeError:
            pass
        for other in ("cp1252", "cp850", "cp437", "mac_roman"):
            if other != charset and not (charset in ("latin-1", "iso8859_15") and other == "cp1252"):
                try:
                    yield f"{charset}>{other}", raw.decode(other)
                except UnicodeDecodeError:
                    pass


#: Cost of a Latin letter that isn't in use in the corpus's own languages.
OTHER = 2.0
STEP = 0.75
#: Operations a path may have, and what a single one may add to the cost.
DEPTH, RISE = 4, 4.0
#: A repair must lower the cost by so much a step.
GAIN = 3.0


@lru_cache(1 << 17)
def search(token: str) -> tuple[str, tuple[str, ...]]:
    """Best-first search from a token: the cheapest string reachable, and the operations that lead there.

    States are strings, kept in a visited set; the queue is ordered by character cost plus ``STEP`` for
    each operation. The graph is searched to its end: DEPTH operations, none of which may raise the cost by more than RISE.
    """
    start = cost(token)
    best, best_cost, best_path = token, start, ()
    queue = [(start, 0, token, ())]
    seen = {token}
    count = 0
    while queue:
        f, _, s, path = heapq.heappop(queue)
        count += 1
        total = cost(s) + STEP * len(path)
        if total < best_cost - 1e-9:
            best, best_cost, best_path = s, total, path
        if len(path) >= DEPTH or cost(s) == 0 and path:
            continue
        for name, t in neighbours(s):
            if t not in seen and cost(t) <= cost(s) + RISE:
                seen.add(t)
                heapq.heappush(queue, (cost(t) + STEP * (len(path) + 1), count * 100 + len(seen), t, (*path, name)))
    if start - best_cost >= GAIN or best_path and best_path[0] in ("html", "percent", "quoted", "escape"):
        return best, best_path
    return token, ()


# ---------------------------------------------------------------------------------------------
# texts

_MARKUP = _LETTER_ENTITY + r"|(?:%[89A-Fa-f][0-9A-Fa-f]){2}|(?:=[89A-F][0-9A-F]){2}|\\u[0-9a-fA-F]{4}|\\x[89a-fA-F]"
_ESCAPES = re.compile(_MARKUP)
_ODD = re.compile(rf"[^ \n\r\t]*?(?:[^\x00-\x7f]|{_MARKUP})[^ \n\r\t]*")
_FILE_ODD = re.compile(rf"[^ \n\r\t_/]*?(?:[^\x00-\x7f]|{_MARKUP})[^ \n\r\t_/]*")
_GAP, _FILE_GAP = re.compile(r"[ \n\r\t]+"), re.compile(r"[ \n\r\t_/]+")
_SYMBOLS = re.compile(r"[#~=+<>^|*_/\\□■◊§¶†‡]")
_SUSPECT = re.compile(rf"[^\x00-\x7f]|[^\W\d_]\?+[^\W\d_.]|[^\W\d_]\? [a-z]|[\s:(]\?\w|{_MARKUP}")
#: What no language has within a word: a sign between letters or after one, a capital after a small letter.
_STRANGE = re.compile(r"[^\W\d_][¢£¤¥§©«¬®¯°±¶·¸»¼½¾¿¡‚„ˆ‹›˜´¨¦]|[¢£¤¥©¬®¯±¶¸¼½¾‚ˆ˜´¨¦][^\W\d_]|[a-zß-öø-ÿ][À-ÖØ-Þ]|[^\W\d_]¡")
# Words that open a question.
_ASKS = frozenset(
    """why what who whom whose how when where which is are was were do does did can could will would should has have had may wer was wie wo warum wann welche welcher wieso wem wen ist sind hat haben kann
    qui que quoi où comment pourquoi quand est quel quelle quels quelles faut quem como quando onde por qual quais o há será and und et e but mais aber""".split()
)
_FILE_HOLE = re.compile(r"\?")
_HOLE = re.compile(r"(?<![/=&\w.-])[^\W\d_]*(?:[^\W\d_]\?+[^\W\d_]+)+(?![=\w])")
_STOPPED = re.compile(r"[^\W\d_]\?\.(?!\.)|(?<=[\s:(])\?(?=[^\W\d_]{2})")
_WITHIN = re.compile(r"[^\W\d_]\? (?=[a-zà-ÿ])")
_EDGE = re.compile(r"(?<![\w?])\?(?=[^\W\d_])|(?<=[^\W\d_])\?(?= [a-zà-ÿ])")


def _candidates(text: str, file: bool) -> list[str]:
    """Distinct tokens that aren't ASCII or hold an escape, but for addresses and runs of symbols."""
    tokens = (_FILE_GAP if file else _GAP).split(text)
    escapes = _ESCAPES.search(text)
    found = dict.fromkeys(t for t in tokens if not t.isascii() or escapes and _ESCAPES.search(t))
    return [t for t in found if "://" not in t and not t.startswith("www.") and (t.isalpha() or len(_SYMBOLS.findall(t)) <= 0.34 * len(t))]


def _plain(token: str) -> bool:
    """Nothing out of place: every character costs what it costs at best."""
    return cost(token) < 2 + sum(c > "\x7f" for c in token) and not _ESCAPES.search(token)


def analyse(text: str, file: bool = False) -> tuple[str, str, list[str]] | None:
    """None for sound text, else (state, restored text, operations).

    State is ``reparado`` when everything found could be restored, ``parcial`` or ``perdido`` else.
    """
    if not _SUSPECT.search(text) and not (file and "?" in text):
        return None
    odd = _candidates(text, file)
    lost = LOST in text
    fixed: dict[str, str] = {}
    paths: dict[tuple[str, ...], int] = {}
    for t in odd:
        if _plain(t):
            continue
        u, path = search(t)
        if path:
            fixed[t] = u
            paths[path] = paths.get(path, 0) + 1
    if paths:
        # the path that suits the text as a whole goes first; it also takes tokens that say too little by themselves
        def through(p: tuple[str, ...]) -> dict[str, str]:
            out = {}
            for t in odd:
                u = _apply(t, p)
                if u is not None and u != t and cost(u) < cost(t) + 0.6:
                    out[t] = u
            return out

        ways = {p: through(p) for p in paths}
        main = min(paths, key=lambda p: (sum(cost(ways[p].get(t) or fixed.get(t, t)) for t in odd) + STEP * len(p) - paths[p] * 0.01, p))
        # a text with whole words that speak against a swap of one-byte charsets wasn't decoded by it
        for p, n in paths.items():
            if _swap(p) and sum(_plain(t) and ((u := _apply(t, p)) is None or u != t and cost(u) >= cost(t) + 0.6) for t in odd) >= n:
                fixed = {t: u for t, u in fixed.items() if search(t)[1] != p or _STRANGE.search(t)}
                ways[p] = {}
        paths = {p: n for p, n in paths.items() if ways[p] or any(search(t)[1] == p for t in fixed)}
        fixed |= ways[main]
    if "?" in text:
        lost = lost or (bool(_FILE_HOLE.search(text)) if file else _holes(text))
    if not fixed and not lost:
        return None
    pattern = _FILE_ODD if file else _ODD
    out = pattern.sub(lambda m: fixed.get(m[0], m[0]), text) if fixed else text
    state = "reparado" if fixed and not lost else "parcial" if fixed else "perdido"
    return state, out, [">".join(p) for p in paths]


def _swap(path: tuple[str, ...]) -> bool:
    """Only from one charset of single bytes to another, where every byte is a character and little speaks for itself."""
    return all(">" in op and not op.endswith(">utf-8") for op in path)


def _asks(text: str, at: int) -> bool:
    """The mark at ``at`` closes a question: what it ends begins with a word that asks."""
    begin = max(text.rfind(c, 0, at) for c in ".!?…\n“«\"„—:,;")
    word = re.match(r"[^\w]*([^\W\d_]+)", text[begin + 1 : at])
    return bool(word) and word[1].lower() in _ASKS


def _holes(text: str) -> bool:
    """Question marks in the place of letters. A single one after a whole word may just lack its space.

    A mark before a full stop, or before a small letter with no question open, closes nothing.
    """
    if "???" not in text and (_STOPPED.search(text) or "¿" not in text and any(not _asks(text, m.start() + 1) for m in _WITHIN.finditer(text))):
        return True
    holes = _HOLE.findall(text)
    if len(holes) == 1 and text.count("?") == 1:
        return not holes[0].split("?")[1][:1].isupper()
    return bool(holes) or len(_EDGE.findall(text)) >= 2


@lru_cache(1 << 16)
def _apply(s: str, path: tuple[str, ...]) -> str | None:
    for op in path:
        s = next((t for name, t in neighbours(s) if name == op), None)
        if s is None:
            return None
    return s


RESULT = "chunk_id string, campo string, estado string, original string, restaurado string, operaciones array<string>"


def repairs(fragments: DataFrame) -> DataFrame:
    """Damaged fields with their original text where it can be had.

    -> (chunk_id, campo, estado, original, restaurado, operaciones), one row for each damaged ``texto``
    or ``fuente`` of a distinct fragment. ``estado`` is reparado, parcial (some characters are lost) or
    perdido (nothing could be restored). Null, empty and sound fields give no row.
    """

    def run(d: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("chunk_id", "campo", "estado", "original", "restaurado", "operaciones")}
        known: dict[str, tuple | None] = {}
        for i, t, f in zip(d["chunk_id"], d["texto"], d["fuente"]):
            if f and f not in known:
                known[f] = analyse(f, True)
            for field, value, r in (("texto", t, analyse(t) if t else None), ("fuente", f, known.get(f) if f else None)):
                if r:
                    for k, v in zip(out, (i, field, r[0], value, r[1], r[2])):
                        out[k].append(v)
        return out

    return map_columns(fragments, ["chunk_id", "texto", "fuente"], RESULT, run)


def found(fragments: DataFrame) -> DataFrame:
    """p4_found: damaged fields -> (chunk_id, campo)."""
    return repairs(fragments).select("chunk_id", "campo").distinct()


def restore(fragments: DataFrame) -> DataFrame:
    """The fragments with both fields restored where possible; all other columns stay."""
    fixed = repairs(fragments).where(F.col("estado") != "perdido").select("chunk_id", "campo", "restaurado").distinct()
    t = fixed.where("campo = 'texto'").select("chunk_id", F.col("restaurado").alias("_t"))
    f = fixed.where("campo = 'fuente'").select("chunk_id", F.col("restaurado").alias("_f"))
    joined = fragments.join(t, "chunk_id", "left").join(f, "chunk_id", "left")
    return joined.withColumns({"texto": F.coalesce("_t", "texto"), "fuente": F.coalesce("_f", "fuente")}).drop("_t", "_f")
