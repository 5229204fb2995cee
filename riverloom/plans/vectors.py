"""Queries over vectors and their maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vector as V
from ..functions.encoder import encode
from ..operators import index as I
from ..session import load
from . import sqltext as Q


def _e(s, d):
    return load(s, d, "embeddings")


def _pair(s, d):
    e = _e(s, d)
    v = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("v"))
    return v, q


def vector_topk(s, d):
    return V.top_k(*_pair(s, d), 10)


def self_retrieval(s, d):
    return I.self_retrieval(*_pair(s, d))


def l2_normalize(s, d):
    u = V.unit(F.transform(F.col("embedding"), lambda x: x * 2))
    return _e(s, d).select("vec_id", F.round(F.get(u, F.lit(0)), 6).alias("x0"), F.round(V.norm(u), 6).alias("norma"), (V.max_error(u, F.col("embedding")) < 1e-5).alias("igual"))


def unit_norm_check(s, d):
    return I.not_unit(_e(s, d), 1e-8).select("vec_id", F.round("norma", 6).alias("norma"))


def index_merge(s, d):
    e = _e(s, d)
    m = I.merged(e.where("label < 5"), e.where("label >= 5 or label is null"))
    return I.running(m, "label", "part", "vec_id").select("vec_id", "part", "posicion", F.round(F.get("embedding", F.lit(1)), 6).alias("x1"))


def hash_encode(s, d):
    v = encode(load(s, d, "consultas"), "query_id", "consulta")
    return v.select(F.col("id").alias("query_id"), F.posexplode("v").alias("cubo", "x")).where("x <> 0").select("query_id", F.col("cubo").cast("bigint").alias("cubo"), F.round("x", 9).alias("peso"))


def hash_sql(rows: str, key: str, text: str, size: int = 64) -> str:
    """(key, cubo, peso) of the offline encoder."""
    return f"""select {key}, cubo, n / sqrt(sum(n * n) over (partition by {key})) as peso from (
        select {key}, ('0x' || substr(md5(t), 1, 8))::bigint % {size} as cubo, count(*)::double as n from (select {key}, unnest({Q.tokens(text)}) as t from {rows}) group by 1, 2)"""


_DOT = "list_dot_product(list_transform(q.embedding, lambda x: x::double), list_transform(e.embedding, lambda x: x::double))"
QUERIES = {
    "vector_topk": (
        vector_topk,
        f"""select * from (select q.vec_id as query_id, e.vec_id as id, round({_DOT}, 6) as score, row_number() over (partition by q.vec_id order by round({_DOT}, 6) desc, e.vec_id) as rank
        from embeddings q join embeddings e on q.vec_id % 50 = 0) where rank <= 10""",
    ),
    "self_retrieval": (
        self_retrieval,
        f"""select query_id, own = top as propio from (select q.vec_id as query_id, max(round({_DOT}, 6)) as top, max(case when q.vec_id = e.vec_id then round({_DOT}, 6) end) as own
        from embeddings q join embeddings e on q.vec_id % 50 = 0 group by q.vec_id)""",
    ),
    "l2_normalize": (
        l2_normalize,
        """with n as (select vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: (2 * x)::double * (2 * x)::double))) as n from embeddings)
        select vec_id, round((2 * embedding[1])::double / n, 6) as x0, round(sqrt(list_sum(list_transform(embedding, lambda x: ((2 * x)::double / n) * ((2 * x)::double / n)))), 6) as norma,
        list_max(list_transform(embedding, lambda x: abs((2 * x)::double / n - x::double))) < 1e-5 as igual from n""",
    ),
    "unit_norm_check": (
        unit_norm_check,
        "select vec_id, round(n, 6) as norma from (select vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as n from embeddings) where abs(n - 1) > 1e-8 + 1e-5",
    ),
    "index_merge": (
        index_merge,
        """with u as (select vec_id, label, embedding, case when label < 5 then 0 else 1 end as part, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as n from embeddings)
        select vec_id, part, row_number() over (partition by label order by part, vec_id) - 1 as posicion, round(embedding[2]::double / n, 6) as x1 from u""",
    ),
    "hash_encode": (hash_encode, f"select query_id, cubo, round(peso, 9) as peso from ({hash_sql('consultas', 'query_id', 'consulta')})"),
}
