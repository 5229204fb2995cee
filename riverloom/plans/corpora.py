"""Queries over fragments as a relation: dedupe, lookups, positions, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus as C
from ..session import load
from . import sqltext as Q


def _m(s, d):
    return load(s, d, "metadata")


def latest_fragments(s, d):
    return C.latest(_m(s, d).select("chunk_id", "doc_id", "posicion", "fenomeno", "cargado_en"))


def chunk_position(s, d):
    m = C.latest(_m(s, d).select("chunk_id", "doc_id", "formato", "posicion", "cargado_en"))
    fmt = F.regexp_replace(F.lower("formato"), "[^a-z]", "")
    pdf = F.coalesce(fmt == "pdf", F.lit(False))
    u = C.union_partitions(m.where(pdf), m.where(~pdf))
    return C.positions(u, "part", "posicion", "chunk_id").select("chunk_id", "nueva_posicion")


def position_contiguity(s, d):
    return C.contiguity(C.latest(_m(s, d).select("chunk_id", "doc_id", "posicion", "cargado_en")))


def duplicate_ids(s, d):
    return C.duplicates(_m(s, d), "chunk_id")


def index_append_anti(s, d):
    m = _m(s, d)
    late = F.col("cargado_en") >= F.lit("2024-02-01").cast("timestamp")
    return C.new_rows(m.where(late).select("chunk_id").distinct(), m.where(~late))


def referential_check(s, d):
    return C.unknown_keys(_m(s, d).select("doc_id").distinct(), load(s, d, "inventario"), "doc_id")


def inventory_join(s, d):
    return C.inventory_lookup(_m(s, d).select("chunk_id", "doc_id").distinct(), load(s, d, "inventario"))


def missing_fields(s, d):
    return C.missing_fields(C.latest(_m(s, d)))


def lint_patterns(s, d):
    return C.lint(_m(s, d))


def signature_share(s, d):
    return C.signature_share(_m(s, d))


def validate_chunks(s, d):
    return C.validate_chunks(_m(s, d))


def word_statistics(s, d):
    n = F.size(T.words(F.col("texto"))).alias("n")
    m = _m(s, d).where("texto is not null").select("chunk_id", n, F.xxhash64("texto").alias("h"), F.regexp_replace(F.lower("formato"), "[^a-z]", "").alias("formato")).distinct()
    return m.groupBy("formato").agg(F.min("n").alias("menor"), F.round(F.avg("n"), 4).alias("media"), F.max("n").alias("mayor"), F.count(F.lit(1)).alias("fragmentos"))


def source_bijection(s, d):
    """Documents under several sources and sources under several documents."""
    p = _m(s, d).where("fuente is not null").select("doc_id", "fuente").distinct()
    a = p.groupBy("doc_id").count().where("count > 1").select(F.lit("doc_id").alias("lado"), F.col("doc_id").alias("clave"), F.col("count").alias("n"))
    b = p.groupBy("fuente").count().where("count > 1").select(F.lit("fuente").alias("lado"), F.col("fuente").alias("clave"), F.col("count").alias("n"))
    return a.unionAll(b)


def stratified_sample(s, d):
    m = C.latest(_m(s, d).select("chunk_id", "fenomeno", "num_tokens", "cargado_en"))
    return C.stratified(m, "fenomeno", F.coalesce("num_tokens", F.lit(-1000000)), "chunk_id").select("fenomeno", "chunk_id", F.col("rn").cast("bigint").alias("rn"))


def summary(s, d):
    """A13."""
    m = C.latest(_m(s, d).select("chunk_id", "doc_id", "observatorio", "num_tokens", "fenomeno", "cargado_en"))
    return m.groupBy("observatorio").agg(
        F.count(F.lit(1)).alias("fragmentos"), F.count_distinct("doc_id").alias("documentos"), F.sum(F.greatest("num_tokens", F.lit(0))).cast("bigint").alias("tokens"),
        F.sum((F.coalesce("fenomeno", F.lit(0)) > 0).cast("int")).cast("bigint").alias("con_fenomeno"),
    )


_D = "select distinct chunk_id, texto from metadata"
_LATE = "cargado_en >= timestamp '2024-02-01'"
_UNION = " union all ".join(
    f"select '{k}' as regla, coalesce(sum(case when regexp_matches(texto, '{p}') then 1 else 0 end), 0)::bigint as n from t"
    for k, p in C.LINT.items()
)
QUERIES = {
    "latest_fragments": (latest_fragments, f"with {Q.FRAG} select chunk_id, doc_id, posicion, fenomeno, cargado_en from frag"),
    "chunk_position": (
        chunk_position,
        f"""with {Q.FRAG} select chunk_id, row_number() over (partition by doc_id order by case when regexp_replace(lower(formato), '[^a-z]', '', 'g') = 'pdf' then 0 else 1 end, posicion, chunk_id) - 1
        as nueva_posicion from frag""",
    ),
    "position_contiguity": (
        position_contiguity,
        f"with {Q.FRAG} select doc_id, count(*) as n, coalesce(min(posicion) = 0 and max(posicion) = count(*) - 1 and count(distinct posicion) = count(*), false) as contigua from frag group by doc_id",
    ),
    "duplicate_ids": (duplicate_ids, "select chunk_id, count(*) as n from metadata group by chunk_id having count(*) > 1"),
    "index_append_anti": (index_append_anti, f"select distinct chunk_id from metadata where {_LATE} and chunk_id not in (select chunk_id from metadata where not {_LATE})"),
    "referential_check": (referential_check, "select distinct doc_id from metadata where doc_id not in (select doc_id from inventario where doc_id is not null)"),
    "inventory_join": (
        inventory_join,
        r"""with i as (select * from (select *, row_number() over (partition by doc_id order by nombre_estandarizado desc nulls last, observatorio desc nulls last, carpeta desc nulls last) rn from inventario) where rn = 1)
        select m.doc_id, m.chunk_id, i.observatorio as observatorio_inv, replace(i.carpeta, '\', '/') as carpeta, i.nombre_estandarizado as nombre
        from (select distinct chunk_id, doc_id from metadata) m left join i on m.doc_id = i.doc_id""",
    ),
    "missing_fields": (
        missing_fields,
        f"with {Q.FRAG} "
        + " union all ".join(f"select '{c}' as campo, sum(case when {c} is null or trim({c}::varchar) = '' then 1 else 0 end)::bigint as faltan from frag" for c in C.MANDATORY),
    ),
    "lint_patterns": (lint_patterns, f"with t as ({_D}) {_UNION}"),
    "signature_share": (
        signature_share,
        rf"""with g as (select count(*) as n from ({_D}) where texto is not null group by regexp_replace(texto, '[A-ZÁÉÍÓÚÑ][\wáéíóúñçã]*', 'X', 'g'))
        select max(n) as n, count(*) as firmas, sum(n)::bigint as total from g""",
    ),
    "validate_chunks": (
        validate_chunks,
        rf"""with t as (select distinct chunk_id, texto, fenomeno from metadata)
        select 'sin texto' as control, sum(case when texto is null or trim(texto) = '' or lower(trim(texto)) = 'nan' then 1 else 0 end)::bigint as n from t
        union all select 'mas de 250 palabras', sum(case when len({Q.words("coalesce(texto, '')")}) > 250 then 1 else 0 end)::bigint from t
        union all select 'sin cierre', sum(case when not regexp_matches(trim(coalesce(texto, '')), '[.!?]$') then 1 else 0 end)::bigint from t
        union all select 'valor nulo', sum(case when regexp_matches(texto, '\b(None|nan)\b') then 1 else 0 end)::bigint from t
        union all select 'fenomeno', sum(case when fenomeno between 1 and 4 then 0 else 1 end)::bigint from t""",
    ),
    "word_statistics": (
        word_statistics,
        f"""with t as (select distinct chunk_id, texto, regexp_replace(lower(formato), '[^a-z]', '', 'g') as formato from metadata where texto is not null), w as (select *, len({Q.words('texto')}) as n from t)
        select formato, min(n)::int as menor, round(avg(n), 4) as media, max(n)::int as mayor, count(*) as fragmentos from w group by formato""",
    ),
    "source_bijection": (
        source_bijection,
        """with p as (select distinct doc_id, fuente from metadata where fuente is not null)
        select 'doc_id' as lado, doc_id as clave, count(*) as n from p group by doc_id having count(*) > 1 union all select 'fuente', fuente, count(*) from p group by fuente having count(*) > 1""",
    ),
    "stratified_sample": (
        stratified_sample,
        f"""with {Q.FRAG}, r as (select fenomeno, chunk_id, coalesce(num_tokens, -1000000) as s, row_number() over (partition by fenomeno order by coalesce(num_tokens, -1000000) desc, chunk_id) as rn, count(*) over (partition by fenomeno) as total from frag),
        z as (select *, min(case when s <= 0 then rn end) over (partition by fenomeno) as zero from r)
        select fenomeno, chunk_id, rn from z where rn = 1 or rn = total // 2 + 1 or rn = coalesce(zero, total)""",
    ),
    "summary": (
        summary,
        f"""with {Q.FRAG} select observatorio, count(*) as fragmentos, count(distinct doc_id) as documentos, sum(greatest(num_tokens, 0))::bigint as tokens,
        sum(case when coalesce(fenomeno, 0) > 0 then 1 else 0 end)::bigint as con_fenomeno from frag group by observatorio""",
    ),
}
