"""Queries of the hybrid retrieval over the text corpus and the given graph evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import RETRIEVAL
from ..functions import vector as V
from ..functions.encoder import HashEncoder, encode
from ..operators import corpus as C
from ..operators import quality as QC
from ..operators import retrieval as R
from ..session import cut, load, stored
from . import sqltext as Q
from .vectors import hash_sql


#: Offline stand-ins of the two encoders: the common space, and a second one with buckets of its own.
COMMON, SECOND = HashEncoder(), HashEncoder(256)


class Base:
    """What all steps read: fragments, questions, evidence, and the vectors of both spaces (R2), encoded once and stored."""

    def __init__(self, s, d):
        self.frags = C.latest(load(s, d, "metadata").select("chunk_id", "doc_id", "fuente", "texto", "cargado_en"))
        self.queries = encode(load(s, d, "consultas"), "query_id", "consulta", COMMON).withColumnRenamed("id", "query_id")
        self.queries2 = encode(load(s, d, "consultas"), "query_id", "consulta", SECOND).withColumnRenamed("id", "query_id")
        self.vectors = stored(encode(self.frags, "chunk_id", "texto", COMMON))
        self.vectors2 = stored(encode(self.frags, "chunk_id", "texto", SECOND))
        self.evidence = load(s, d, "evidencia")

    def pool(self):
        """Candidates of both spaces and of the graph, each with its cosine in the common space and its document.

        Every fragment with text has a stored vector in the common space, so none is encoded anew.
        """
        spaces = [V.top_k(self.vectors, self.queries, RETRIEVAL.top_k), V.top_k(self.vectors2, self.queries2, RETRIEVAL.second_top_k)]
        pool = R.candidates([x.withColumnRenamed("id", "chunk_id") for x in spaces], self.evidence)
        v = self.vectors.select(F.col("id").alias("chunk_id"), F.col("v").alias("cv"))
        q = self.queries.select("query_id", F.col("v").alias("qv"))
        rows = pool.join(v, "chunk_id").join(q, "query_id").withColumn("coseno", F.round(V.dot(F.col("qv"), F.col("cv")), 6)).drop("qv", "cv")
        return rows.join(self.frags.select("chunk_id", "doc_id", "fuente"), "chunk_id")

    def fused(self):
        return R.fused(self.pool(), self.evidence)

    def top(self):
        return R.best(self.fused(), RETRIEVAL.refine)


def candidate_union(s, d):
    return Base(s, d).pool().select("query_id", "chunk_id", "origen", "coseno")


def zscore_fusion(s, d):
    return Base(s, d).fused().select("query_id", "chunk_id", "p")


def fragments_top10_capped(s, d):
    return R.capped(Base(s, d).top()).select("query_id", "rank", "chunk_id", "doc_id", "p")


def documents_top3(s, d):
    return R.documents(Base(s, d).top()).select("query_id", "rank", "doc_id", F.col("puntos"))


def hybrid_results(s, d):
    """Both fusions, the second over the refined fragments, up to the nested result."""
    base = Base(s, d)
    pool = cut(base.fused().select("query_id", "chunk_id", "doc_id", "fuente", "coseno", "p"))  # else each use searches anew
    top = R.best(pool, RETRIEVAL.refine).drop("p", "previo")
    texts = top.join(base.frags.select("chunk_id", "texto"), "chunk_id")
    windows = R.best_window(texts, base.queries)
    again = top.drop("coseno").join(windows, ["query_id", "chunk_id"]).withColumnRenamed("coseno_refinado", "coseno")
    ranked = R.fused(again, base.evidence)
    return R.results(R.capped(ranked), R.documents(ranked, fill=pool))


def result_json(s, d):
    return hybrid_results(s, d).select("query_id", F.to_json(F.struct("query_id", "documents", "fragments")).alias("linea"))


def validate_results(s, d):
    return R.validate_results(hybrid_results(s, d))


def traceability(s, d):
    """Q5: none of the result's ids may lack in the base."""
    return QC.traceability(hybrid_results(s, d), load(s, d, "metadata"))


def best_window(s, d):
    base = Base(s, d)
    top = base.top().select("query_id", "chunk_id", "coseno").join(base.frags.select("chunk_id", "texto"), "chunk_id")
    return R.best_window(top, base.queries)


def _space(n: str, size: int, k: int) -> str:
    """The k best of a space of ``size`` buckets, as sp{n}; all cosines as cs{n}."""
    return f"""cv{n} as ({hash_sql('(select chunk_id, texto from frag where texto is not null)', 'chunk_id', 'texto', size)}), qv{n} as ({hash_sql('consultas', 'query_id', 'consulta', size)}),
dots{n} as (select q.query_id, c.chunk_id, sum(q.peso * c.peso) as x from qv{n} q join cv{n} c using (cubo) group by 1, 2),
cs{n} as (select a.query_id, t.chunk_id, coalesce(round(x, 6), 0) as coseno from (select query_id from consultas) a cross join withtext t left join dots{n} using (query_id, chunk_id)),
sp{n} as (select * from (select *, row_number() over (partition by query_id order by coseno desc, chunk_id) as rn from cs{n}) where rn <= {k})"""


_POOL = f"""{Q.FRAG}, withtext as (select distinct chunk_id from frag where texto is not null), {_space('', 64, RETRIEVAL.top_k)}, {_space('2', 256, RETRIEVAL.second_top_k)},
gr as (select * from (select *, row_number() over (partition by query_id order by score desc, chunk_id) as rn from evidencia where score is not null) where rn <= 100),
pool as (select query_id, chunk_id, max(o)::int as origen from (select query_id, chunk_id, 0 as o from sp union all select query_id, chunk_id, 1 from sp2 union all select query_id, chunk_id, -1 from gr) group by 1, 2),
pc as (select p.query_id, p.chunk_id, p.origen, cs.coseno, f.doc_id, f.fuente from pool p join cs using (query_id, chunk_id) join frag f on f.chunk_id = p.chunk_id)"""
_FUSED = """gn as (select query_id, chunk_id, case when max(score) over (partition by query_id) > 0 then score / max(score) over (partition by query_id) else 0 end as g from evidencia where score is not null),
fu as (select pc.*, round((case when stddev_pop(coseno) over (partition by pc.query_id) < 1e-9 then 0 else (coseno - avg(coseno) over (partition by pc.query_id)) / stddev_pop(coseno) over (partition by pc.query_id) end) + 0.5 * coalesce(g, 0), 6) as p
  from pc left join gn on gn.query_id = pc.query_id and gn.chunk_id = pc.chunk_id),
top as (select * from (select *, row_number() over (partition by query_id order by p desc, chunk_id) as previo from fu) where previo <= 60)"""
QUERIES = {
    "candidate_union": (candidate_union, f"with {_POOL} select query_id, chunk_id, origen, coseno from pc"),
    "zscore_fusion": (zscore_fusion, f"with {_POOL}, {_FUSED} select query_id, chunk_id, p from fu"),
    "fragments_top10_capped": (
        fragments_top10_capped,
        f"""with {_POOL}, {_FUSED}, a as (select *, row_number() over (partition by query_id, doc_id order by p desc, chunk_id) as rnd from top)
        select query_id, rank, chunk_id, doc_id, p from (select *, row_number() over (partition by query_id order by case when rnd > 5 then 1 else 0 end, p desc, chunk_id) as rank from a) where rank <= 10""",
    ),
    "documents_top3": (
        documents_top3,
        f"""with {_POOL}, {_FUSED}, g as (select query_id, coalesce(nullif(trim(fuente), ''), doc_id) as grupo, max(p) as m, sum(greatest(p, 0)) as s, arg_max(doc_id, (p, chunk_id)) as doc_id from top group by 1, 2),
        t as (select *, round(m + 0.3 * (s - greatest(m, 0)), 7) as puntos from g)
        select query_id, rank, doc_id, puntos from (select *, row_number() over (partition by query_id order by puntos desc, grupo) as rank from t) where rank <= 3""",
    ),
    "best_window": (best_window, None),
    "hybrid_results": (hybrid_results, None),
    "result_json": (result_json, None),
    "validate_results": (validate_results, None),
    "traceability": (traceability, None),
}
