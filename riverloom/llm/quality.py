"""Problem 5: text statistics of each fragment, and its kind by fixed thresholds with recorded reasons."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import residue
from .common import map_columns

# The most common function words of es, en, pt, fr and de.
COMMON = frozenset(
    (
        "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ya este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante "
        "the of and to in is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who will more if out so said its which "
        "do da em um para com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito nos já está eu também só pelo pela até isso ela entre era depois sem mesmo aos seus que "
        "le les des et une est dans qui pas pour ce sur ne plus au par avec sont son ses cette aux ont été sans mais nous vous il elle leur du d l "
        "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch"
    ).split()
)
# Limits as published for web text. (least, most) of each statistic; beyond them a text fails the rule of that name.
#: Gopher (Rae et al. 2021): words, mean word length, symbols a word, bullet lines, lines that end in an ellipsis, words with a letter, function words.
#: FineWeb (Penedo et al. 2024): lines that end in punctuation, lines of under 30 characters.
RULES = {
    "palabras": (50, 100_000), "largo_medio": (3, 10), "signos_palabra": (0, 0.1), "vinetas": (0, 0.9), "elipsis": (0, 0.3), "alfabeticas": (0.8, 1), "frecuentes": (2, float("inf")),
    "fin_puntuacion": (0.12, 1), "lineas_cortas": (0, 0.67),
}
#: Rules that say little of the kind: short fragments, and headings or page breaks within prose.
WEAK = frozenset({"palabras", "fin_puntuacion", "lineas_cortas", "elipsis"})
#: Shares by which a line's kind is told, and of a text's characters that one kind of lines needs.
LIMITS = {
    "common_words": 0.20,  # prose has at least this share of function words
    "common_words_line": 0.12,  # a line of wrapped prose
    "list_share": 0.5,  # share of a fragment's characters
    "digits_line": 0.10,  # a record holds at least this share of digits
    "symbols": 0.35,  # share of characters that are neither letters, digits nor white space
    "odd_words": 0.5,  # words without a plausible shape
}
STATS = (
    "palabras int, largo_medio double, simbolos double, digitos double, lineas int, fin_puntuacion double, vinetas double, comunes double, mayusculas double, "
    "signos_palabra double, elipsis double, alfabeticas double, frecuentes int, lineas_cortas double"
)
_BULLET = re.compile(r"^\s*(?:[-–—*•▪·◦‣»>+]|o(?= )|\(?\d{1,3}[.)](?!\d)|\(\d{1,3}\)|\(?[a-zA-Z][.)]|\[\d{1,3}\])\s+\S")
_LEADER = re.compile(r"(?:\.{3,}|(?:\. ){3,}|…{2,}|\t|\s{2,}|·{3,}|_{3,})\s*(?:p\.?\s*)?\d{1,4}\s*$")
_REFERENCE = re.compile(r"\(\d{4}\)|\b(?:[Vv]ol|pp|[Nn]úm|[Nn]o|S|t)\.\s*\d|\bet al\.")
_ENTRY = re.compile(r"^\S.{1,60}\(\d{4}[a-z]?\)[.,:]\s.*\b(?:[Vv]ol|pp?|S|t|[Nn]o|[Nn]úm)\.\s*\d")
_CELLS = re.compile(r"\||;|\t|\s{2,}")
_NUMBER = re.compile(r"^[-+]?[\d.,\s]*\d%?$|^(?:n/?[ad]|s/?d|-|–|—)$", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_PAIR = re.compile(r"[^\s:]+:\s+\S")
_REPEAT = re.compile(r"(.)\1{4,}|\b(\w{2,4}?)\2{1,}\b")
#: ASCII digits, superscripts and all from the first other digit on.
_MAYBE_DIGIT = re.compile(r"[^\x00-/:-\xb1\xb4-\xb8\xba-\u065f]")
_VOWELS = frozenset("aeiouyáéíóúàâãäåæèêëìîïòôõöùûüýœ")
_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxzñç]{5,}", re.I)
_MISSING = re.compile(r"(?<!\w)(?:n/?[ad]|s/?d)(?!\w)", re.I)
_HEX = re.compile(r"^(?:0x)?[0-9a-f]{2}$|^[0-9a-f]{4,}$", re.I)
_BULLETS = re.compile(_BULLET.pattern.replace(r"^\s*", r"^[ \t]*", 1), re.M)
_LEADERS = re.compile(r"(?:\.{4}|(?:\. ){3}|…{2}|\t ?)\s*\d{1,4}[ \t]*$|;\d[^;\n]*;|\t\d[^\t\n]*\t", re.M)
_LINE = re.compile(r"^.*\S", re.M)
_FULL = frozenset(".!?…:;»”\"')。！？।")
_KEYS = ("qwertyuiopasdfghjklñzxcvbnm", "mnbvcxzñlkjhgfdsapoiuytrewq")
_LOWER_UPPER = re.compile(r"[a-z][A-Z]|[A-Za-z]\d|\d[A-Za-z]")


def _key_run(w: str) -> bool:
    """A word typed along the rows of a keyboard: every letter next to the one before, or a repeat of such a run."""
    if len(w) < 3:
        return False
    near = sum(a + b in _KEYS[0] or a + b in _KEYS[1] or a == b for a, b in zip(w, w[1:]))
    return near >= 0.6 * (len(w) - 1)


def _digits(s: str) -> int:
    """How many characters are digits, also those that aren't ASCII."""
    return sum(map(str.isdigit, _MAYBE_DIGIT.findall(s)))


def _mostly_hex(tokens: list[str]) -> bool:
    """Whether at least 0.8 of the tokens are hexadecimal numbers; the rest isn't looked at once too many are not."""
    left = len(tokens)
    for t in tokens:
        if not _HEX.match(t):
            left -= 1
            if left < 0.8 * len(tokens):
                return False
    return True


@lru_cache(1 << 16)
def odd(word: str) -> bool:
    """No plausible word of a readable language."""
    w = word.lower()
    if len(w) < 3:
        return False
    if len(set(w)) == 1:
        return True
    if not any(c in _VOWELS for c in w):
        return len(w) > 3 and not word.isupper()
    return bool(_CLUSTER.search(w)) and len(w) < 12 or _key_run(w) or bool(_REPEAT.search(w)) and len(set(w)) < 5 and len(w) > 3


def line_kind(line: str) -> str:
    """prosa, lista, tabla, basura or nada (too little to say)."""
    s = line.strip()
    if not s:
        return "nada"
    if _BULLET.match(line):
        parts = s.split()
        return "prosa" if len(parts) > 15 and sum(w.lower() in COMMON for w in parts) >= LIMITS["common_words"] * len(parts) else "lista"
    if len(s) >= 20 and len(set(s.lower()) - {" "}) <= 5:
        return "basura"
    if len(s) < 24 and s.replace(" ", "").isalpha() and s.count(" ") < 4:
        names = s.split()
        return "basura" if len(names) > 3 and sum(map(odd, names)) > 2 else "corta"
    leader = s[-1].isdigit() and _LEADER.search(s)
    for mark in "|;\t":
        if s.count(mark) >= 3 and _digits(s) >= LIMITS["digits_line"] * len(s) and not leader:
            return "tabla"
    words = _WORD.findall(_MISSING.sub(" ", s))
    letters = sum(map(len, words))
    digits = _digits(s)
    dense = len(s) - s.count(" ")
    if letters + digits < (1 - LIMITS["symbols"]) * dense and not leader and "|" not in s and dense > 12:
        return "basura"
    if s.count("(cid:") > 2:
        return "basura"
    tokens = s.split()
    if len(tokens) >= 8 and _mostly_hex(tokens) and re.search("[a-fA-F]", s):
        return "basura"
    if max(map(len, s.split())) > 40 and _LOWER_UPPER.search(s):
        return "basura"
    common = sum(map(COMMON.__contains__, map(str.lower, words))) / max(1, len(words))
    if leader and not _CELLS.search(_LEADER.sub("", s)):
        return "lista"
    if len(words) > 3 and sum(map(odd, words)) > LIMITS["odd_words"] * len(words):
        return "basura"
    if _ENTRY.search(s) or len(_REFERENCE.findall(s)) >= 2 and common < LIMITS["common_words"]:
        return "lista"
    cells = [c.strip() for c in _CELLS.split(s.strip("|")) if c.strip()]
    numbers = sum(bool(_NUMBER.match(c)) for c in cells)
    if len(cells) >= 3 and (numbers >= 2 or common < 0.1 and len(max(cells, key=len)) < 25 and "," not in s):
        return "tabla"
    if len(_PAIR.findall(s)) >= 2 and digits >= LIMITS["digits_line"] * dense * 0.5 and common < LIMITS["common_words"]:
        return "tabla"
    if words and common >= LIMITS["common_words_line"] and len(words) >= 4:
        return "prosa"
    amounts = sum(bool(_NUMBER.match(t)) for t in tokens)
    if len(tokens) > 8 and amounts >= 0.3 * len(tokens) and common < 0.1:
        return "tabla"
    if not words:
        return "numero" if digits or _NUMBER.match(s) else "nada"
    if common < 0.06 and len(words) >= 8 and s.count(",") + s.count(";") + s.count("·") + s.count("/") >= len(words) / 5:
        return "lista"
    return "corta" if len(words) <= 6 else "prosa"


def failures(stats: dict[str, list], i: int) -> list[str]:
    """The published rules that text ``i`` fails, each with its value."""
    return [f"{k} {v:.2f}" for k, (lo, hi) in RULES.items() if not lo <= (v := stats[k][i]) <= hi]


def classify(text: str, common: float, bullets: float, failed: bool = False) -> tuple[str, str]:
    """(kind, reason) of one text. A text that ``failed`` a rule is judged by its lines, as is one with few common words or marks of lists and tables."""
    if not text.strip():
        return "vacio", ""
    marks = "...." in text or ". . ." in text or "……" in text or "\t" in text or ";" in text
    if not failed and common >= 0.25 and not bullets and "|" not in text and ". . ." not in text and "...." not in text and "……" not in text and not (marks and _LEADERS.search(text)):
        if "\n" not in text or _digits(text) < 0.06 * len(text):
            return "prosa", f"palabras comunes {common:.2f}"
    lines = text.split("\n")
    weight: dict[str, int] = {}
    shorts = []
    for x in lines:
        k = line_kind(x)
        weight[k] = weight.get(k, 0) + len(x.strip())
        if k in ("corta", "numero"):
            shorts.append((k, x.strip()))
    total = sum(weight.values()) or 1
    if shorts:
        # one cell a line, a run of items, or headings beside prose
        numbers = sum(k == "numero" for k, _ in shorts)
        size = weight.get("corta", 0) + weight.get("numero", 0)
        if numbers >= 0.35 * len(shorts) and len(shorts) >= 6:
            weight["tabla"] = weight.get("tabla", 0) + size
        elif len(shorts) >= 4 or weight.get("lista", 0) or common < 0.05 and ("·" in text or "," in text):
            weight["lista" if weight.get("tabla", 0) < size else "tabla"] = weight.get("lista" if weight.get("tabla", 0) < size else "tabla", 0) + size
        else:
            weight["prosa"] = weight.get("prosa", 0) + size
    best = max(("prosa", "lista", "tabla", "basura", "nada"), key=lambda k: weight.get(k, 0))
    share = weight.get(best, 0) / total
    if best == "nada":
        return "basura", "sin palabras"
    if best != "prosa" and share < LIMITS["list_share"]:
        best = "prosa"
    return best, f"{best} {share:.2f}, palabras comunes {common:.2f}"


def statistics(texts: list[str]) -> dict[str, list]:
    """Vectorised per-text statistics over a batch."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1] if len(texts) else np.zeros(0, np.int64)
    add = lambda mask: np.add.reduceat(mask.astype(np.int64), starts) if len(texts) else np.zeros(0)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 0xA0) | (codes == 0x2028)
    digit = (codes >= 48) & (codes <= 57)
    upper = ((codes >= 65) & (codes <= 90)) | ((codes >= 0xC0) & (codes <= 0xDE))
    letter = ((codes | 32) >= 97) & ((codes | 32) <= 122) & (codes < 128) | (codes >= 0xC0) & ((codes < 0x2000) | (codes > 0x2BFF)) & (codes != 0xFFFD)
    dense = np.maximum(1, sizes - (add(space) - 1))
    letters = np.maximum(1, add(letter))
    # words and lines begin where a character follows white space or a line break
    before = np.concatenate([[True], space[:-1]]) if len(codes) else space
    begins = ~space & before
    n = add(begins)
    some = np.maximum(1, n)
    held = np.flatnonzero(begins)
    lettered = np.zeros(len(codes), dtype=bool)
    if len(held):
        lettered[held] = np.add.reduceat(letter, held, dtype=np.int32) > 0
    split = [t.lower().split() for t in texts]
    rows = [_LINE.findall(t) if "\n" in t else [t] if t.strip() else [] for t in texts]
    lines = np.array([len(x) for x in rows])
    full = np.maximum(1, lines)
    frequent = [[w for w in ws if w in COMMON] for ws in split]
    return {
        "palabras": n.tolist(),
        "largo_medio": (np.where(n > 0, dense, 0) / some).tolist(),
        "simbolos": ((dense - add(letter) - add(digit)) / dense).tolist(),
        "digitos": (add(digit) / dense).tolist(),
        "lineas": lines.tolist(),
        "fin_puntuacion": (np.array([sum(x.rstrip()[-1:] in _FULL for x in xs) for xs in rows]) / full).tolist(),
        "vinetas": (np.array([sum(bool(_BULLET.match(x)) for x in xs) for xs in rows]) / full).tolist(),
        "comunes": (np.array([len(x) for x in frequent]) / some).tolist(),
        "mayusculas": (add(upper) / letters).tolist(),
        "signos_palabra": (add((codes == 35) | (codes == 0x2026)) / some).tolist(),
        "elipsis": (np.array([sum(x.rstrip().endswith(("...", "…")) for x in xs) for xs in rows]) / full).tolist(),
        "alfabeticas": np.where(n > 0, add(lettered) / some, 1.0).tolist(),
        "frecuentes": [len(set(x)) for x in frequent],
        "lineas_cortas": (np.array([sum(len(x) < 30 for x in xs) for xs in rows]) / full).tolist(),
    }


def _shares(texts: list[str]) -> dict[str, list]:
    """The two statistics that most texts are decided by."""
    return {
        "comunes": [sum(map(COMMON.__contains__, w)) / (len(w) or 1) for w in (t.lower().split() for t in texts)],
        "vinetas": [len(_BULLETS.findall(t)) / (len(_LINE.findall(t)) or 1) if "\n" in t else float(bool(_BULLET.match(t))) for t in texts],
    }


def kinds(texts: list[str], residues: list[bool], stats: dict[str, list] | None = None) -> list[tuple[str, list[str]]]:
    """(kind, reasons) of each text: the rules it fails and what its lines say. Without ``stats`` only the shares of common words and bullets are looked at first."""
    rules = stats is not None
    stats = stats or _shares(texts)
    out = []
    for i, (t, r) in enumerate(zip(texts, residues)):
        why = failures(stats, i) if rules and t.strip() else []
        if r:
            out.append(("residuo", ["residuo de plantilla", *why]))
            continue
        k, said = classify(t, stats["comunes"][i], stats["vinetas"][i], any(w.split(" ", 1)[0] not in WEAK for w in why))
        out.append((k, [said, *why] if said else why))
    return out


def text_statistics(fragments: DataFrame) -> DataFrame:
    """Statistics, kind and reason of each distinct fragment.

    -> (chunk_id, palabras, largo_medio, simbolos, digitos, lineas, fin_puntuacion, vinetas, comunes, mayusculas,
    signos_palabra, elipsis, alfabeticas, frecuentes, lineas_cortas, clase, razones). ``razones`` has what decided on the
    kind and then every rule of RULES that the text fails, with its value. ``clase`` is prosa, lista, tabla, basura, residuo (problem 2) or vacio for null and
    blank texts. Repeats of a fragment that differ in other columns give one row.
    """
    return _with_kind(fragments).distinct()


def _with_kind(fragments: DataFrame) -> DataFrame:
    shared = fragments.sparkSession.sparkContext.broadcast(residue.fit_residue(fragments))

    def run(d: dict[str, list]) -> dict[str, list]:
        texts = [t or "" for t in d["texto"]]
        stats = statistics(texts)
        found = kinds(texts, shared.value.flags(texts), stats)
        return stats | {"chunk_id": d["chunk_id"], "clase": [k for k, _ in found], "razones": [r for _, r in found]}

    return map_columns(fragments, ["chunk_id", "texto"], f"chunk_id string, {STATS}, clase string, razones array<string>", run)


def found(fragments: DataFrame) -> DataFrame:
    """p5_found: fragments that aren't prose, with their kind -> (chunk_id, clase)."""
    return _with_kind(fragments).where(F.col("clase").isin("lista", "tabla", "basura")).select("chunk_id", "clase").distinct()
