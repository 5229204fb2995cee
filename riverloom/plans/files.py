"""Queries that write the test tables to files and read them again: sources and sinks by round trip, in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import corpus as C
from ..session import load, shared_folder
from ..sources import fragments as S
from ..sources import graphml as X
from ..sources import questions as QS
from . import sqltext as Q


def _path(s, name: str) -> str:
    return f"{shared_folder(s)}/{name}-{uuid.uuid4().hex}"


def _rows(s, d):
    return C.latest(load(s, d, "metadata").drop("idioma")).drop("cargado_en")


def jsonl_strict(s, d):
    """Fragments as JSON Lines, read strictly in the canonical dialect."""
    path = _path(s, "fragmentos")
    S.write_lines(_rows(s, d), path)
    r = S.dialect(S.read_strict(s, path))
    return r.select("chunk_id", "doc_id", "posicion", "fenomeno", "num_tokens", F.md5("texto").alias("huella"), "pagina_inicio")


def jsonl_lenient(s, d):
    """The same files read leniently; texts of under ten characters drop out."""
    path = _path(s, "base")
    S.write_lines(_rows(s, d).where("texto is not null"), path)
    r = S.read_lenient(s, path, "*.json")
    return r.select("chunk_id", "doc_id", F.length("texto").alias("puntos"))


def staged_parquet(s, d):
    """K4, K8: written beside its place, verified, renamed, read."""
    path = _path(s, "tabla")
    rows = load(s, d, "inventario")
    n = rows.count()
    S.write_staged(rows, path, lambda t: t.count() == n)
    S.write_staged(rows, path)
    return s.read.parquet(path).groupBy("observatorio").agg(F.count(F.lit(1)).alias("filas"))


def graphml_nodes(s, d):
    """K3, S6, S8."""
    path = _path(s, "grafo")
    X.write_graph(load(s, d, "nodos"), load(s, d, "aristas"), path)
    n = X.read_nodes(s, path)
    return n.select("node_id", "tipo", "fenomeno", F.size("chunk_ids").alias("fragmentos"), F.array_join(F.array_sort("doc_ids"), "|").alias("documentos"))


def graphml_edges(s, d):
    """K3, S7, S8."""
    path = _path(s, "grafo")
    X.write_graph(load(s, d, "nodos"), load(s, d, "aristas"), path)
    return X.read_edges(s, path).select("src", "dst", "relacion", F.array_join(F.array_sort("chunk_ids"), "|").alias("chunk_ids"))


def questions_json(s, d):
    """S10."""
    path = _path(s, "preguntas")
    S.write_lines(load(s, d, "consultas").withColumnRenamed("consulta", "pregunta"), path, "query_id")
    return QS.read_json(s, path).select("query_id", "consulta")


QUERIES = {
    "jsonl_strict": (jsonl_strict, f"with {Q.FRAG} select chunk_id, doc_id, posicion, fenomeno, num_tokens, md5(texto) as huella, pagina_inicio from frag"),
    "jsonl_lenient": (jsonl_lenient, f"with {Q.FRAG} select chunk_id, doc_id, length(trim(texto, ' ')) as puntos from frag where length(trim(texto, ' ')) >= 10"),
    "staged_parquet": (staged_parquet, "select observatorio, count(*) as filas from inventario group by 1"),
    "graphml_nodes": (
        graphml_nodes,
        "select node_id, tipo, fenomeno, len(list_distinct(chunk_ids)) as fragmentos, array_to_string(list_sort(list_distinct(doc_ids)), '|') as documentos from nodos",
    ),
    "graphml_edges": (graphml_edges, "select src, dst, relacion, array_to_string(list_sort(chunk_ids), '|') as chunk_ids from aristas"),
    "questions_json": (questions_json, "select query_id, consulta from consultas"),
}
