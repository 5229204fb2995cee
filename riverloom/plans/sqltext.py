"""Pieces of the queries' SQL."""

from __future__ import annotations

from ..config import ABBREVIATIONS, RELATION_VERBS, STOPWORDS

WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]"
STOP = "(" + ", ".join(f"'{w}'" for w in sorted(STOPWORDS)) + ")"
RELATION = "(" + "|".join(f"{v}|{v}n" for v in RELATION_VERBS) + ")"
FRAG = "frag as (select * from (select *, row_number() over (partition by chunk_id order by cargado_en desc) rn_ from metadata) where rn_ = 1)"
ABBR = ABBREVIATIONS.replace(r"\b(?:", r"(?:^|[^\p{L}\p{N}_])(?:", 1)


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def norm(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def tokens(x: str) -> str:
    return f"list_filter(string_split({norm(x)}, ' '), lambda t: t <> '')"


def words(x: str) -> str:
    return f"list_filter(string_split(regexp_replace({x}, '{WS}+', ' ', 'g'), ' '), lambda t: t <> '')"


def sentences(key: str, text: str, table: str) -> str:
    """Sentences as rows (key, t, k, s) of the rows with text."""
    return rf"""f as (select distinct {key}, {strip(text)} as t from {table} where {text} is not null),
l as (select {key}, t, list_filter(list_transform(string_split(regexp_replace(t, '([.!?…])["''”’)\]]*{WS}+([¿¡"''“(\[]*[A-ZÁÉÍÓÚÑÜ0-9])', '\1' || chr(30) || '\2', 'g'), chr(30)),
      lambda x: {strip('x')}), lambda x: x <> '') as l from f where t <> ''),
p as (select {key}, t, unnest(range(1, len(l) + 1)) as i, unnest(l) as s from l),
q as (select *, case when regexp_matches(lag(s) over (partition by {key} order by i), '(?i){ABBR}') then 0 else 1 end as b from p),
g as (select *, sum(b) over (partition by {key} order by i) as k from q),
sent as (select {key}, t, k, string_agg(s, ' ' order by i) as s from g group by {key}, t, k)"""


#: Sentences of the fragments.
SENTENCES = sentences("chunk_id", "texto", "metadata")
