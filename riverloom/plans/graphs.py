"""Queries over the knowledge graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import lexical as L
from ..session import cut, load, spread
from . import sqltext as Q


def _total(s, d):
    return load(s, d, "metadata").agg(F.greatest(F.count_distinct("chunk_id"), F.lit(1)).cast("double").alias("total"))


def _texts(s, d):
    return spread(load(s, d, "metadata").select("chunk_id", "texto"))  # repeats of a fragment fall together in its terms


def _phrases(s, d):
    q = load(s, d, "consultas")
    return L.phrase_weights(L.ngrams(q), L.term_frequencies(_texts(s, d), q), _total(s, d))


def _entities(s, d):
    nodes = load(s, d, "nodos")
    return G.query_entities(_phrases(s, d), nodes, G.node_weights(G.mentions_of(nodes), _total(s, d)))


def query_term_df(s, d):
    return L.term_frequencies(_texts(s, d), load(s, d, "consultas"))


def query_ngrams(s, d):
    return L.ngrams(load(s, d, "consultas")).select("query_id", "frase", F.col("n").cast("bigint").alias("n"))


def phrase_weight(s, d):
    return _phrases(s, d).select("query_id", "frase", F.round("peso", 6).alias("peso"))


def node_idf(s, d):
    return G.node_weights(G.mentions_of(load(s, d, "nodos")), _total(s, d)).select("node_id", "df", F.round("peso", 6).alias("peso"))


def chunk_density(s, d):
    return G.density(G.mentions_of(load(s, d, "nodos")))


def query_entities(s, d):
    return _entities(s, d).select("query_id", "node_id", F.round("peso", 6).alias("peso"))


def direct_evidence(s, d):
    m = G.mentions_of(load(s, d, "nodos"))
    return G.direct(_entities(s, d), m).select("query_id", "chunk_id", F.round("suma", 5).alias("suma"), "nodos")


def _near(s, d, entities=None):
    w = G.node_weights(G.mentions_of(load(s, d, "nodos")), _total(s, d))
    return G.neighbours(_entities(s, d) if entities is None else entities, load(s, d, "aristas"), w)


def neighbor_topk(s, d):
    return _near(s, d).select("query_id", "node_id", "vecino", F.round("fuerza", 5).alias("fuerza"), F.col("rn").cast("bigint").alias("rn"))


def graph_evidence(s, d):
    m = G.mentions_of(load(s, d, "nodos"))
    entities = cut(_entities(s, d))  # a few rows for each question, read twice
    e = G.evidence(entities, m, _near(s, d, entities), load(s, d, "metadata"))
    return e.select("query_id", "chunk_id", F.round("score", 5).alias("score"))


def node_phrase_match(s, d):
    return G.phrase_nodes(load(s, d, "consultas"), load(s, d, "nodos"))


def one_hop_evidence(s, d):
    nodes = load(s, d, "nodos")
    return G.one_hop(G.phrase_nodes(load(s, d, "consultas"), nodes), G.mentions_of(nodes), load(s, d, "aristas"))


def _mentions(s, d):
    return G.mentions(spread(load(s, d, "metadata").select("chunk_id", "doc_id", "fenomeno", "texto").where("texto is not null")))


def entity_mentions(s, d):
    return _mentions(s, d).select("chunk_id", "node_id", F.col("ord").cast("bigint").alias("ord"), "relacion")


def graph_nodes(s, d):
    return G.nodes(_mentions(s, d))


def graph_edges(s, d):
    return G.edges(_mentions(s, d))


def graph_edge_lists(s, d):
    return G.edge_lists(_mentions(s, d)).select("src", "dst", "relacion", F.array_join("chunk_ids", "|").alias("chunk_ids"))


def entity_match(s, d):
    """J7 with the questions' capitalised names as recognised entities."""
    names = load(s, d, "consultas").select("query_id", F.explode(F.regexp_extract_all("consulta", F.lit(G.NAME), F.lit(0))).alias("entidad")).distinct()
    return G.entity_nodes(names, load(s, d, "nodos")).distinct()


def graph_consult(s, d):
    c = G.consult(load(s, d, "consultas"), load(s, d, "nodos"), load(s, d, "aristas"))
    return c.select("query_id", "rank", "chunk_id", "puntuacion", F.array_join("relaciones", "; ").alias("relaciones"))


_TOTAL = "tot as (select greatest(count(distinct chunk_id), 1)::double as total from metadata)"
_DF = f"""terms as (select distinct t from (select unnest({Q.tokens('consulta')}) as t from consultas) where t not in {Q.STOP}),
tdf as (select t as token, count(*) as df from (select chunk_id, unnest(list_distinct({Q.tokens("coalesce(texto, '')")})) as t from (select distinct chunk_id, texto from metadata)) where t in (select t from terms) group by t)"""
_NG = rf"""qs as (select query_id, {Q.words(r"regexp_replace(consulta, '[^\p{L}\p{N}_\s]', ' ', 'g')")} as s from consultas),
qn as (select query_id, s, unnest(range(1, least(len(s), 6) + 1)) as n from qs),
qi as (select query_id, s, n, unnest(range(1, len(s) - n + 2)) as i from qn),
qw as (select query_id, n, list_slice(s, i, i + n - 1) as w from qi),
ng as (select distinct query_id, lower(array_to_string(w, ' ')) as frase, n from qw where lower(w[1]) not in {Q.STOP} and lower(w[len(w)]) not in {Q.STOP}
  and (n > 1 or (length(w[1]) >= 4 and regexp_matches(w[1], '^\p{{Lu}}|\p{{N}}'))))"""
_PW = """pw as (select query_id, frase, n, case when m < ln(1 + total / 2000) then 0 else m * (1 + 0.25 * (n - 1)) end as peso from (
  select g.query_id, g.frase, g.n, avg(ln(1 + total / (1 + coalesce(df, 0)))) as m, max(total) as total
  from (select *, unnest(string_split(frase, ' ')) as token from ng) g left join tdf using (token) cross join tot group by 1, 2, 3))"""
_M = "ment as (select node_id, unnest(list_distinct(chunk_ids)) as chunk_id from nodos)"
_W = "w as (select node_id, df, case when df > 0.02 * total then 0 else ln(1 + total / greatest(df, 5)) end as peso from (select node_id, count(*) as df from ment group by 1) cross join tot)"
_ENT = f"ent as (select p.query_id, n.node_id, max(p.peso) as peso from pw p join nodos n on {Q.norm('n.node_id')} = p.frase where p.peso > 0 and n.node_id in (select node_id from w where peso > 0) group by 1, 2)"
_ALL = ",\n".join([_TOTAL, _DF, _NG, _PW, _M, _W, _ENT])
_NEAR = """nb as (select src as node_id, dst as vecino, len(chunk_ids) as apoyo from aristas union all select dst, src, len(chunk_ids) from aristas),
near as (select * from (select e.query_id, e.node_id, e.peso, nb.vecino, w.peso as pv, round(apoyo * w.peso, 9) as fuerza, row_number() over (partition by e.query_id, e.node_id order by round(apoyo * w.peso, 9) desc, nb.vecino) as rn
  from ent e join nb on nb.node_id = e.node_id join w on w.node_id = nb.vecino where w.peso > 0 and w.df <= 200) where rn <= 25)"""
_PN = f"""pn as (select distinct q.query_id, n.node_id from consultas q join nodos n on length(n.node_id) >= 3 and {Q.norm('n.node_id')} <> ''
  and contains(' ' || {Q.norm('q.consulta')} || ' ', ' ' || {Q.norm('n.node_id')} || ' '))"""
_MEN = rf"""fr as (select distinct chunk_id, doc_id, fenomeno, texto from metadata where texto is not null and length(trim(texto)) >= 10),
raw as (select chunk_id, doc_id, fenomeno, texto, unnest(l) as raw, unnest(range(0, len(l))) as ord from (select *, regexp_extract_all(texto, '\p{{Lu}}\p{{L}}{{2,}}(?: \p{{Lu}}\p{{L}}{{2,}}){{0,3}}') as l from fr)),
me as (select * from (select chunk_id, doc_id, fenomeno, texto, ord, raw as surface, lower(raw) as node_id, row_number() over (partition by chunk_id, lower(raw) order by ord) as rn from raw where lower(raw) not in {Q.STOP}) where rn = 1),
men as (select *, coalesce(nullif(lower(regexp_extract(texto, '(?i)\b{Q.RELATION}\b', 1)), ''), 'relacionado_con') as relacion from me)"""
QUERIES = {
    "query_term_df": (query_term_df, f"with {_DF} select token, df from tdf"),
    "query_ngrams": (query_ngrams, f"with {_NG} select query_id, frase, n from ng"),
    "phrase_weight": (phrase_weight, f"with {_TOTAL}, {_DF}, {_NG}, {_PW} select query_id, frase, round(peso, 6) as peso from pw"),
    "node_idf": (node_idf, f"with {_TOTAL}, {_M}, {_W} select node_id, df, round(peso, 6) as peso from w"),
    "chunk_density": (chunk_density, f"with {_M} select chunk_id, count(*) as densidad from ment group by 1"),
    "query_entities": (query_entities, f"with {_ALL} select query_id, node_id, round(peso, 6) as peso from ent"),
    "direct_evidence": (direct_evidence, f"with {_ALL} select query_id, chunk_id, round(sum(peso), 5) as suma, count(*) as nodos from ent join ment using (node_id) group by 1, 2"),
    "neighbor_topk": (neighbor_topk, f"with {_ALL}, {_NEAR} select query_id, node_id, vecino, round(fuerza, 5) as fuerza, rn from near"),
    "graph_evidence": (
        graph_evidence,
        f"""with {_ALL}, {_NEAR},
        c as (select query_id, chunk_id, peso as v, 1 as c from ent join ment using (node_id) union all select query_id, chunk_id, 0.15 * peso * pv, 0 from near n join ment m on m.node_id = n.vecino),
        g as (select query_id, chunk_id, sum(v) as v, sum(c) as c from c group by 1, 2), dens as (select chunk_id, count(*) as den from ment group by 1)
        select query_id, chunk_id, round(v * (1 + 0.4 * greatest(0, c - 1)) / sqrt(den), 5) as score from g join dens using (chunk_id) where chunk_id in (select chunk_id from metadata)""",
    ),
    "node_phrase_match": (node_phrase_match, f"with {_PN} select * from pn"),
    "one_hop_evidence": (
        one_hop_evidence,
        f"""with {_PN}, {_M}, e as (select src, dst, unnest(chunk_ids) as chunk_id from aristas),
        u as (select query_id, chunk_id from pn join ment using (node_id) union all select query_id, chunk_id from pn join e on e.src = pn.node_id union all select query_id, chunk_id from pn join e on e.dst = pn.node_id)
        select query_id, chunk_id, count(*) as puntuacion from u group by 1, 2""",
    ),
    "entity_mentions": (entity_mentions, f"with {_MEN} select chunk_id, node_id, ord, relacion from men"),
    "graph_nodes": (
        graph_nodes,
        f"""with {_MEN} select node_id, arg_min(surface, (chunk_id, ord)) as texto, arg_min_null(fenomeno, (chunk_id, ord)) as fenomeno, count(distinct chunk_id) as n_chunks, count(distinct doc_id) as n_docs from men group by 1""",
    ),
    "graph_edges": (
        graph_edges,
        f"with {_MEN} select a.node_id as src, b.node_id as dst, arg_min(a.relacion, a.chunk_id) as relacion, count(*) as support from men a join men b on a.chunk_id = b.chunk_id and a.ord < b.ord group by 1, 2",
    ),
    "graph_edge_lists": (
        graph_edge_lists,
        f"with {_MEN} select a.node_id as src, b.node_id as dst, arg_min(a.relacion, a.chunk_id) as relacion, array_to_string(list_sort(list(distinct a.chunk_id)), '|') as chunk_ids from men a join men b on a.chunk_id = b.chunk_id and a.ord < b.ord group by 1, 2",
    ),
    "entity_match": (
        entity_match,
        rf"""with n as (select distinct query_id, unnest(regexp_extract_all(consulta, '\p{{Lu}}\p{{L}}{{2,}}(?: \p{{Lu}}\p{{L}}{{2,}}){{0,3}}')) as entidad from consultas),
        e as (select query_id, entidad, lower(trim(regexp_replace(case when x = '' then entidad else x end, '\s+', ' ', 'g'))) as id from (select *, regexp_replace(entidad, '^(?i)((el|la|los|las|un|una|unos|unas|the|a|an)(\s+|$))+', '') as x from n)),
        ex as (select query_id, entidad, node_id from e join nodos on node_id = id),
        rest as (select * from e where length(id) >= 3 and (query_id, entidad) not in (select (query_id, entidad) from ex)),
        cand as materialized (select query_id, entidad, id, node_id from rest join nodos on length(node_id) >= 3 and (contains(node_id, id) or contains(id, node_id)))
        select distinct * from (select * from ex union all select query_id, entidad, node_id from cand where
          regexp_matches(node_id, '(?:^|[^\p{{L}}\p{{N}}_])' || regexp_escape(id) || '(?:$|[^\p{{L}}\p{{N}}_])') or regexp_matches(id, '(?:^|[^\p{{L}}\p{{N}}_])' || regexp_escape(node_id) || '(?:$|[^\p{{L}}\p{{N}}_])'))""",
    ),
}
QUERIES["graph_consult"] = (
    graph_consult,
    f"""with {_M}, e as (select src, dst, src || ' ' || relacion || ' ' || dst as r, unnest(chunk_ids) as chunk_id from aristas),
    fo as (select distinct query_id, node_id from ((select query_id, node_id from ({QUERIES['node_phrase_match'][1]})) union all (select query_id, node_id from ({QUERIES['entity_match'][1]})))),
    u as (select query_id, chunk_id, null as r from fo join ment using (node_id) union all select query_id, chunk_id, r from fo join e on e.src = fo.node_id union all select query_id, chunk_id, r from fo join e on e.dst = fo.node_id),
    g as (select query_id, chunk_id, count(*) as puntuacion, array_to_string(list_sort(list(distinct r) filter (where r is not null)), '; ') as relaciones from u group by 1, 2),
    t as (select *, row_number() over (partition by query_id order by puntuacion desc, chunk_id) as rank from g)
    select query_id, rank, chunk_id, puntuacion, coalesce(relaciones, '') as relaciones from t where rank <= 10""",
)
