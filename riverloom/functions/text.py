"""Text functions as Column -> Column, inside whole-stage code generation where Spark allows it."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import ship
from ..config import ABBREVIATIONS, ARTICLES, DEFAULT_RELATION, RELATION_VERBS, RETRIEVAL

SENTENCE_BREAK = r"""(?U)(?<=[.!?…])["'”’)\]]*\s+(?=[¿¡"'“(\[]*[A-ZÁÉÍÓÚÑÜ0-9])"""
SENTENCE_START = r"""^["'“¿¡(\[]*[A-ZÁÉÍÓÚÑÜ0-9]"""
SENTENCE_END = r"""[.!?…]["'”’)\]]*$"""
RELATION = r"(?i)\b(" + "|".join(f"{v}|{v}n" for v in RELATION_VERBS) + r")\b"
NOT_WORD = r"[^\p{L}\p{N}_\s]"
_SPACE = r"(?U)\s+"


def missing(c: Column) -> Column:
    """Null for null, blank and the string nan."""
    t = F.trim(c)
    return F.when((t != "") & (F.lower(t) != "nan"), c)


def strip(c: Column) -> Column:
    """Without white space of any kind around it."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def normalized(c: Column) -> Column:
    """T1 for text in composed form: lower case, everything but letters, digits and _ as a space, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), NOT_WORD, " "), r"\s+", " "))


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def composed(df: DataFrame, column: str) -> DataFrame:
    """Composed form (NFC); only rows that hold a combining mark go through Python."""
    ship(df.sparkSession)
    odd = F.coalesce(F.col(column).rlike(r"[\p{M}ᄀ-ᇿＡ-￯K]"), F.lit(False))
    return df.where(~odd).unionByName(df.where(odd).withColumn(column, _nfc(column)))


def words(c: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(c, _SPACE), lambda x: x != "")


def tokens(c: Column) -> Column:
    """Words of the normalised text."""
    return F.filter(F.split(normalized(c), " "), lambda x: x != "")


def sentences(c: Column) -> Column:
    """Pieces after closing marks, joined again where the one before ends in an abbreviation; never empty."""
    text = strip(c)
    pieces = F.filter(F.transform(F.split(text, SENTENCE_BREAK), strip), lambda x: x != "")
    merged = F.aggregate(
        pieces,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & F.coalesce(F.element_at(acc, -1), F.lit("")).rlike("(?iU)" + ABBREVIATIONS),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat_ws(" ", F.element_at(acc, -1), x))),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    return F.when(F.size(merged) > 0, merged).otherwise(F.array(text))


def trimmed(c: Column, kept_share: float = RETRIEVAL.kept_share) -> Column:
    """T5: without a first and a last piece that aren't whole sentences, unless too little would be left."""
    text = strip(c)
    s = sentences(c)
    first = F.when(F.get(s, F.lit(0)).rlike(SENTENCE_START), 0).otherwise(1)
    count = F.size(s)
    stop = F.when(~F.element_at(s, -1).rlike(SENTENCE_END) & (count - first > 1), count - 1).otherwise(count)
    cut = F.array_join(F.slice(s, first + 1, F.greatest(stop - first, F.lit(0))), " ")
    keep = (count >= 2) & (first < stop) & (F.size(words(cut)) >= kept_share * F.size(words(text)))
    return F.when(keep, strip(cut)).otherwise(text)


def windows(c: Column, most: int = RETRIEVAL.max_words) -> Column:
    """Greedy windows of whole sentences of at most ``most`` words, overlapping by one sentence.

    One fold over the sentences. The state holds the open window as sentences with their word counts,
    its total and the closed windows. A sentence longer than ``most`` gives a window of its first words.
    """
    text = strip(c)
    kind = "array<struct<s:string,n:int>>"
    items = F.transform(sentences(c), lambda x: F.struct(x.alias("s"), F.size(words(x)).alias("n")))
    empty = F.array().cast(kind)

    def said(cur: Column) -> Column:
        return F.array_join(F.transform(cur, lambda x: x["s"]), " ")

    def state(cur: Column, out: Column) -> Column:
        return F.struct(cur.cast(kind).alias("cur"), out.alias("out"))

    def fresh(x: Column, out: Column) -> Column:
        cut = F.array_join(F.slice(words(x["s"]), 1, most), " ")
        return F.when(x["n"] > most, state(empty, F.concat(out, F.array(cut)))).otherwise(state(F.array(x), out))

    def total(cur: Column) -> Column:
        return F.aggregate(cur, F.lit(0), lambda a, x: a + x["n"])

    def step(acc: Column, x: Column) -> Column:
        cur, out = acc["cur"], acc["out"]
        last = F.slice(cur, -1, 1)
        closed = F.concat(out, F.array(said(cur)))
        over = F.when(
            F.size(cur) >= 2,
            F.when(F.get(last, F.lit(0))["n"] + x["n"] <= most, state(F.concat(last, F.array(x)), closed)).otherwise(fresh(x, F.concat(closed, F.array(said(last))))),
        ).otherwise(fresh(x, closed))
        return F.when(F.size(cur) == 0, fresh(x, out)).when(total(cur) + x["n"] <= most, state(F.concat(cur, F.array(x)), out)).otherwise(over)

    folded = F.aggregate(items, state(empty, F.array().cast("array<string>")), step)
    closed = F.when(F.size(folded["cur"]) > 0, F.concat(folded["out"], F.array(said(folded["cur"])))).otherwise(folded["out"])
    return F.when(F.size(words(text)) <= most, F.array(text)).otherwise(closed)


def first_words(c: Column, most: int = RETRIEVAL.max_words) -> Column:
    """T7, as a hard limit."""
    w = words(c)
    return F.when(F.size(w) <= most, c).otherwise(F.array_join(F.slice(w, 1, most), " "))


def entity(c: Column) -> Column:
    """T8."""
    return F.lower(collapse(c))


def without_articles(c: Column) -> Column:
    """Leading articles dropped; what is nothing but articles stays."""
    t = F.regexp_replace(F.trim(c), r"(?i)^((" + "|".join(ARTICLES) + r")(?U:\s+|$))+", "")
    return F.when(t == "", F.trim(c)).otherwise(collapse(t))


def contains_phrase(text: Column, phrase: Column) -> Column:
    """A phrase within word bounds; an empty one is nowhere."""
    return (phrase != "") & F.regexp_like(text, F.concat(F.lit(r"(?U)\b\Q"), F.regexp_replace(phrase, r"\\E", ""), F.lit(r"\E\b")))


def unmangled(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, where all of it can be turned back; else unchanged."""
    possible = c.rlike("[ÃÂâ][\u0080-ÿ]") & ~c.rlike("[^\u0000-ÿ]")
    raw = F.encode(F.when(possible, c), "ISO-8859-1")
    return F.when(possible & F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(c)


def clean(c: Column, keep_lines: bool = False) -> Column:
    """Repaired, without control characters, collapsed; lines may stay."""
    t = F.regexp_replace(unmangled(c), r"[\p{C}&&[^\n\t]]", "")
    if keep_lines:
        return F.trim(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r" ?\n ?", "\n"))
    return collapse(t)


def truthy(c: Column) -> Column:
    """T14."""
    return F.coalesce(F.upper(F.trim(c.cast("string"))).isin("VERDADERO", "VERDADEIRO", "TRUE", "SI", "SIM", "1"), F.lit(False))


_ACCENTED = "".join(chr(i) for i in range(0xC0, 0x180) if unicodedata.decomposition(chr(i)) and "<" not in unicodedata.decomposition(chr(i)))
_BASE = "".join(unicodedata.normalize("NFD", x)[0] for x in _ACCENTED)


def without_accents(c: Column) -> Column:
    """T15 for Latin letters, with a table made from their decompositions."""
    return F.translate(F.regexp_replace(c, "[\u0300-\u036f]", ""), _ACCENTED, _BASE)


def thousands(c: Column) -> Column:
    """An integer with . between thousands; null for what is no number."""
    return F.translate(F.format_number(c.cast("string").try_cast("double").try_cast("bigint"), 0), ",", ".")


def as_list(c: Column) -> Column:
    """Null and nan give [], a JSON list its items, any other value a list of itself; blanks are dropped."""
    parsed = F.from_json(F.when(F.trim(c).startswith("["), c), "array<string>")
    items = F.when(missing(c).isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array(c)))
    return F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def enumerated(items: Column, conjunction: str = "y") -> Column:
    """A, b y c."""
    n = F.size(items)
    head = F.array_join(F.slice(items, 1, F.greatest(n - 1, F.lit(0))), ", ")
    return F.when(n == 0, "").when(n == 1, F.get(items, F.lit(0))).otherwise(F.concat(head, F.lit(f" {conjunction} "), F.element_at(items, -1)))


def core(c: Column) -> Column:
    """A name without parentheses, accents and marks."""
    return F.regexp_replace(F.lower(without_accents(F.regexp_replace(c, r"\([^)]*\)", ""))), "[^a-z0-9 ]", "")


def popup_names(c: Column) -> Column:
    """Names of a pop-up, in order, the first of those equal but for case.

    Lines lose a leading dash and are split at spaced dashes; ``SIGLA: Name`` becomes ``Name (SIGLA)``
    where the short form has at most 12 characters and two words.
    """
    parts = F.flatten(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.split(F.regexp_replace(F.trim(x), r"^-\s*", ""), r"\s+-\s+")))

    def name(x: Column) -> Column:
        t = F.trim(x)
        short, full = F.trim(F.regexp_extract(t, r"^([^:]+):(.*)$", 1)), F.trim(F.regexp_extract(t, r"^([^:]+):(.*)$", 2))
        ok = (short != "") & (full != "") & (F.length(short) <= 12) & (F.size(F.split(short, r"\s+")) <= 2)
        return F.when(ok, F.concat(full, F.lit(" ("), short, F.lit(")"))).otherwise(t)

    names = F.filter(F.transform(parts, name), lambda x: x != "")
    return F.aggregate(
        names,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))),
    )


def extension(c: Column) -> Column:
    """T26."""
    return F.lower(F.regexp_extract(c, r"\.([^./\\]+)$", 1))


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, r"[/\\]"), -1)


def phenomenon(c: Column) -> Column:
    """1 for F1."""
    return F.regexp_replace(c.cast("string"), "^[Ff]+", "").try_cast("int")


def relation(c: Column) -> Column:
    """The first verb of relation."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(c, RELATION, 1)), F.lit("")), F.lit(DEFAULT_RELATION))


def entity_surface(c: Column) -> Column:
    """A recognised name without marks around it."""
    return F.regexp_replace(F.trim(c), r"""^[.,;:()"'…\s]+|[.,;:()"'…\s]+$""", "")


def signature(c: Column) -> Column:
    """Capitalised words as X."""
    return F.regexp_replace(c, r"[A-ZÁÉÍÓÚÑ][\wáéíóúñçã]*", "X")


def declared_groups(c: Column) -> Column:
    """The number of structures that a text declares, 1 where it names none, null where it declares nothing."""
    pattern = r"presencia de (?:la|las)?\s*(una|dos|tres|\d+)?\s*estructuras?"
    n = F.regexp_extract(c, pattern, 1)
    return F.when(F.regexp_like(c, F.lit(pattern)), F.when(n.isin("", "una"), 1).when(n == "dos", 2).when(n == "tres", 3).otherwise(n.try_cast("int")))
