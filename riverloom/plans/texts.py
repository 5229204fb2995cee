"""Queries over the text and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..session import load, spread
from . import sqltext as Q


def text_normalize(s, d):
    docs = T.composed(load(s, d, "documents").select("doc_id", "text"), "text")
    return docs.select("doc_id", T.normalized(F.col("text")).alias("normalizado"), F.size(T.tokens(F.col("text"))).cast("bigint").alias("palabras")).where("text is not null")


def _texts(s, d):
    return spread(load(s, d, "metadata").select("chunk_id", "texto").where("texto is not null")).where(T.strip(F.col("texto")) != "")


def sentence_split(s, d):
    return _texts(s, d).select("chunk_id", T.sentences(F.col("texto")).alias("x")).select("chunk_id", F.size("x").cast("bigint").alias("n"), F.array_join("x", " ¦ ").alias("oraciones")).dropDuplicates(["chunk_id"])


def trim_sentences(s, d):
    return _texts(s, d).select("chunk_id", T.trimmed(F.col("texto")).alias("recorte")).dropDuplicates(["chunk_id"])


def windows_250(s, d):
    x = load(s, d, "documents").where("text is not null").select("doc_id", F.posexplode(T.windows(F.col("text"))).alias("i", "ventana"))
    return x.select("doc_id", "i", F.size(T.words(F.col("ventana"))).alias("palabras"))


def strip_accents(s, d):
    return load(s, d, "nodos").select("node_id", T.without_accents(F.col("texto")).alias("sin_tildes"))


def fragment_fields(s, d):
    m = load(s, d, "metadata")
    return m.select(
        "chunk_id", T.basename(F.col("ruta_fuente")).alias("archivo"), T.extension(F.col("ruta_fuente")).alias("extension"), T.phenomenon(F.concat(F.lit("F"), "fenomeno")).alias("fenomeno"),
        F.regexp_replace(F.lower("formato"), "[^a-z]", "").alias("formato"),
    ).distinct()


def relation_verb(s, d):
    return load(s, d, "metadata").where("texto is not null").select("chunk_id", T.relation(F.col("texto")).alias("relacion")).distinct()


def entity_clean(s, d):
    t = F.col("texto")
    return load(s, d, "nodos").select("node_id", T.entity(t).alias("entidad"), T.entity_surface(t).alias("superficie"), T.without_articles(F.concat(F.lit("El la "), t)).alias("sin_articulo"))


def thousands(s, d):
    return load(s, d, "metadata").where("num_tokens is not null").select("chunk_id", T.thousands(F.col("num_tokens")).alias("tokens")).distinct()


def enumerate_documents(s, d):
    return load(s, d, "nodos").select("node_id", T.enumerated(F.slice(F.array_sort("doc_ids"), 1, 3)).alias("documentos"))


def fix_mojibake(s, d):
    return load(s, d, "metadata").where("texto is not null").select("chunk_id", T.unmangled(F.col("texto")).alias("texto")).distinct()


QUERIES = {
    "text_normalize": (text_normalize, f"select doc_id, {Q.norm('nfc_normalize(text)')} as normalizado, len({Q.tokens('nfc_normalize(text)')}) as palabras from documents where text is not null"),
    "sentence_split": (sentence_split, f"with {Q.SENTENCES} select chunk_id, count(*) as n, string_agg(s, ' ¦ ' order by k) as oraciones from sent group by chunk_id"),
    "trim_sentences": (
        trim_sentences,
        rf"""with {Q.SENTENCES},
        a as (select chunk_id, t, list(s order by k) as l from sent group by chunk_id, t),
        b as (select *, case when regexp_matches(l[1], '^["''“¿¡(\[]*[A-ZÁÉÍÓÚÑÜ0-9]') then 0 else 1 end as ini from a),
        c as (select *, case when not regexp_matches(l[len(l)], '[.!?…]["''”’)\]]*$') and len(l) - ini > 1 then len(l) - 1 else len(l) end as fin from b),
        e as (select *, array_to_string(list_slice(l, ini + 1, fin), ' ') as cut from c)
        select chunk_id, case when len(l) >= 2 and ini < fin and len({Q.words('cut')}) >= 0.6 * len({Q.words('t')}) then {Q.strip('cut')} else t end as recorte from e""",
    ),
    "windows_250": (
        windows_250,
        f"""with recursive {Q.sentences("doc_id", "text", "documents")}, n as (select doc_id, k, len({Q.words('s')}) as n from sent),
        total as (select doc_id, len({Q.words('text')}) as total from documents where text is not null),
        r as (
          select doc_id, 0 as k, 0 as held, 0 as words, 0 as last, null::bigint as e1, null::bigint as e2, null::bigint as e3 from total where total > 250
          union all
          select doc_id, k, case when alone then 0 else held + 1 end, case when alone then 0 else words + n end, case when alone then 0 else n end, e1, e2, case when alone then 250 end from (
            select *, held = 0 and n > 250 as alone from (
              select doc_id, k, n, case when not over then held when last + n <= 250 and held > 1 then 1 else 0 end as held, case when not over then words when last + n <= 250 and held > 1 then last else 0 end as words,
                case when over then words end as e1, case when over and held > 1 and last + n > 250 then last end as e2
              from (select r.doc_id, n.k, n.n, r.held, r.words, r.last, r.held > 0 and r.words + n.n > 250 as over from r join n on n.doc_id = r.doc_id and n.k = r.k + 1)))),
        e as (select doc_id, k, 1 as o, e1 as p from r union all select doc_id, k, 2, e2 from r union all select doc_id, k, 3, e3 from r
          union all select doc_id, k, 4, words from (select *, row_number() over (partition by doc_id order by k desc) as rn from r) where rn = 1 and held > 0)
        select doc_id, (row_number() over (partition by doc_id order by k, o) - 1)::int as i, p::int as palabras from e where p is not null
        union all select doc_id, 0, total::int from total where total <= 250""",
    ),
    "strip_accents": (strip_accents, "select node_id, strip_accents(texto) as sin_tildes from nodos"),
    "fragment_fields": (
        fragment_fields,
        r"""select distinct chunk_id, regexp_extract(ruta_fuente, '[^/\\]*$') as archivo, lower(regexp_extract(ruta_fuente, '\.([^./\\]+)$', 1)) as extension,
        fenomeno, regexp_replace(lower(formato), '[^a-z]', '', 'g') as formato from metadata""",
    ),
    "relation_verb": (
        relation_verb,
        rf"select distinct chunk_id, coalesce(nullif(lower(regexp_extract(texto, '(?i)\b{Q.RELATION}\b', 1)), ''), 'relacionado_con') as relacion from metadata where texto is not null",
    ),
    "entity_clean": (
        entity_clean,
        r"""select node_id, lower(trim(regexp_replace(texto, '\s+', ' ', 'g'))) as entidad,
        regexp_replace(regexp_replace(trim(texto), '^[.,;:()"''…\s]+', ''), '[.,;:()"''…\s]+$', '') as superficie,
        case when n.t = '' then 'El la ' || texto else trim(regexp_replace(n.t, '\s+', ' ', 'g')) end as sin_articulo
        from (select *, regexp_replace(trim('El la ' || texto), '^(?i)((el|la|los|las|un|una|unos|unas|the|a|an)(\s+|$))+', '') as t from nodos) n""",
    ),
    "thousands": (thousands, "select distinct chunk_id, replace(format('{:,}', num_tokens), ',', '.') as tokens from metadata where num_tokens is not null"),
    "enumerate_documents": (
        enumerate_documents,
        """select node_id, case when len(l) = 0 then '' when len(l) = 1 then l[1] else array_to_string(list_slice(l, 1, len(l) - 1), ', ') || ' y ' || l[len(l)] end as documentos
        from (select node_id, list_slice(list_sort(doc_ids), 1, 3) as l from nodos)""",
    ),
    "fix_mojibake": (fix_mojibake, None),
}
