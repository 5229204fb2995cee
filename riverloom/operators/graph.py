"""Knowledge graph: build, evidence for all questions in one pass, one-hop lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import GRAPH, STOPWORDS, Graph
from ..functions import text as T
from ..session import small

#: X2, offline recogniser: runs of capitalised words.
NAME = r"\p{Lu}\p{L}{2,}(?: \p{Lu}\p{L}{2,}){0,3}"


# ---------------------------------------------------------------------------------------------
# build


def mentions(fragments: DataFrame, cfg: Graph = GRAPH) -> DataFrame:
    """(chunk_id, node_id, ord, surface, doc_id, fenomeno, relacion), each node once a fragment; repeats of a fragment fall together."""
    text = F.col("texto")
    names = F.regexp_extract_all(text, F.lit(NAME), F.lit(0))
    rows = fragments.where(F.length(F.trim(text)) >= cfg.min_text)
    rows = rows.select("chunk_id", "doc_id", "fenomeno", T.relation(text).alias("relacion"), F.posexplode(names).alias("ord", "raw"))
    rows = rows.withColumn("surface", T.entity_surface(F.col("raw"))).withColumn("node_id", T.entity(F.col("surface")))
    rows = rows.where((F.length("node_id") >= cfg.min_length) & ~F.col("node_id").isin(*sorted(STOPWORDS)))
    first = F.min(F.struct("ord", "surface", "doc_id", "fenomeno", "relacion")).alias("f")
    g = rows.groupBy("chunk_id", "node_id").agg(first)
    return g.select("chunk_id", "node_id", "f.ord", "f.surface", "f.doc_id", "f.fenomeno", "f.relacion")


def nodes(m: DataFrame) -> DataFrame:
    """(node_id, texto, fenomeno, n_chunks, n_docs); attributes of the first mention.

    The fragments of a node stay rows of ``mentions``; only an export needs them as a list (``node_lists``).
    """
    first = F.min_by(F.struct("surface", "fenomeno"), F.struct("chunk_id", "ord"))
    g = m.groupBy("node_id").agg(first.alias("f"), F.count(F.lit(1)).alias("n_chunks"), F.count_distinct("doc_id").alias("n_docs"))
    return g.select("node_id", F.col("f.surface").alias("texto"), F.col("f.fenomeno").alias("fenomeno"), "n_chunks", "n_docs")


def node_lists(m: DataFrame) -> DataFrame:
    """A9 for an export: (node_id, chunk_ids, doc_ids), sorted sets; a node's list must fit a row there anyway."""
    return m.groupBy("node_id").agg(F.array_sort(F.collect_set("chunk_id")).alias("chunk_ids"), F.array_sort(F.collect_set("doc_id")).alias("doc_ids"))


def edges(m: DataFrame) -> DataFrame:
    """(src, dst, relacion, support): pairs in order of occurrence within a fragment, which is bounded in words."""
    a = m.select("chunk_id", F.col("node_id").alias("src"), F.col("ord").alias("i"), "relacion")
    b = m.select("chunk_id", F.col("node_id").alias("dst"), F.col("ord").alias("j"))
    g = a.join(b, "chunk_id").where("i < j").groupBy("src", "dst")
    return g.agg(F.min_by("relacion", "chunk_id").alias("relacion"), F.count(F.lit(1)).alias("support"))


def edge_lists(m: DataFrame) -> DataFrame:
    """A10 for an export, one-hop lookup and consult: (src, dst, relacion, chunk_ids), the sorted set of the fragments of each pair."""
    a = m.select("chunk_id", F.col("node_id").alias("src"), F.col("ord").alias("i"), "relacion")
    b = m.select("chunk_id", F.col("node_id").alias("dst"), F.col("ord").alias("j"))
    g = a.join(b, "chunk_id").where("i < j").groupBy("src", "dst")
    return g.agg(F.min_by("relacion", "chunk_id").alias("relacion"), F.array_sort(F.collect_set("chunk_id")).alias("chunk_ids"))


def mentions_of(node_table: DataFrame) -> DataFrame:
    """The node table's fragments as rows (node_id, chunk_id)."""
    return node_table.select("node_id", F.explode(F.array_distinct("chunk_ids")).alias("chunk_id"))


def density(m: DataFrame) -> DataFrame:
    """A2."""
    return m.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("densidad"))


def node_weights(m: DataFrame, total: DataFrame, cfg: Graph = GRAPH) -> DataFrame:
    """A3, V5: (node_id, df, peso); 0 for a node in more than ``df_max_share`` of the fragments."""
    g = m.groupBy("node_id").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(total))
    weight = F.log1p(F.col("total") / F.greatest(F.col("df"), F.lit(cfg.df_saturation)))
    return g.select("node_id", "df", F.when(F.col("df") > cfg.df_max_share * F.col("total"), 0.0).otherwise(weight).alias("peso"))


# ---------------------------------------------------------------------------------------------
# evidence


def query_entities(phrases: DataFrame, node_table: DataFrame, weights: DataFrame) -> DataFrame:
    """Nodes named in a question -> (query_id, node_id, peso), the largest phrase weight times nothing.

    A phrase equals the normalised id of a node; one phrase may name several nodes.
    """
    alias = node_table.select("node_id", T.normalized(F.col("node_id")).alias("frase"))
    found = phrases.where("peso > 0").join(alias, "frase").groupBy("query_id", "node_id").agg(F.max("peso").alias("peso"))
    return found.join(weights.where("peso > 0").select("node_id"), "node_id", "left_semi")


def direct(entities: DataFrame, m: DataFrame) -> DataFrame:
    """(query_id, chunk_id, suma, nodos)."""
    return entities.join(m, "node_id").groupBy("query_id", "chunk_id").agg(F.sum("peso").alias("suma"), F.count(F.lit(1)).alias("nodos"))


def neighbours(entities: DataFrame, edge_table: DataFrame, weights: DataFrame, cfg: Graph = GRAPH, digits: int = 9) -> DataFrame:
    """The strongest neighbours of each entity of a question, over both directions of an edge."""
    e = edge_table.select("src", "dst", F.size("chunk_ids").alias("apoyo"))
    both = e.select(F.col("src").alias("node_id"), F.col("dst").alias("vecino"), "apoyo").unionAll(e.select(F.col("dst").alias("node_id"), F.col("src").alias("vecino"), "apoyo"))
    w = weights.where((F.col("peso") > 0) & (F.col("df") <= cfg.df_max_neighbour)).select(F.col("node_id").alias("vecino"), F.col("peso").alias("peso_vecino"))
    rows = entities.join(both, "node_id").join(w, "vecino").withColumn("fuerza", F.round(F.col("apoyo") * F.col("peso_vecino"), digits))
    rank = Window.partitionBy("query_id", "node_id").orderBy(F.desc("fuerza"), "vecino")
    return rows.withColumn("rn", F.row_number().over(rank)).where(F.col("rn") <= cfg.neighbours)


def evidence(entities: DataFrame, m: DataFrame, near: DataFrame, fragments: DataFrame, cfg: Graph = GRAPH) -> DataFrame:
    """Graph score of each (query_id, chunk_id) whose fragment exists."""
    own = entities.join(m, "node_id").select("query_id", "chunk_id", F.col("peso").alias("v"), F.lit(1).alias("c"))
    far = near.join(m.withColumnRenamed("node_id", "vecino"), "vecino").select("query_id", "chunk_id", (cfg.neighbour_weight * F.col("peso") * F.col("peso_vecino")).alias("v"), F.lit(0).alias("c"))
    g = own.unionAll(far).groupBy("query_id", "chunk_id").agg(F.sum("v").alias("v"), F.sum("c").alias("c"))
    g = g.join(density(m), "chunk_id").join(fragments.select("chunk_id").distinct(), "chunk_id", "left_semi")
    score = F.col("v") * (1 + cfg.coverage_bonus * F.greatest(F.lit(0), F.col("c") - 1)) / F.sqrt("densidad")
    return g.select("query_id", "chunk_id", score.alias("score"))


# ---------------------------------------------------------------------------------------------
# one-hop lookup


def phrase_nodes(queries: DataFrame, node_table: DataFrame, cfg: Graph = GRAPH, longest: int = 8) -> DataFrame:
    """Nodes whose normalised id stands in the question within word bounds -> (query_id, node_id).

    The containment becomes an equi-join on the question's n-grams; ids of more than ``longest`` words
    are few and go through a direct comparison.
    """
    n = node_table.select("node_id", T.tokens(F.col("node_id")).alias("t")).where(F.length("node_id") >= cfg.min_node)
    n = n.where(F.size("t") > 0).withColumn("frase", F.array_join("t", " "))
    q = queries.select("query_id", T.tokens(F.col("consulta")).alias("t")).where(F.size("t") > 0)
    g = q.select("query_id", "t", F.explode(F.sequence(F.lit(1), F.least(F.size("t"), F.lit(longest)))).alias("k"))
    g = g.select("query_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("t") - F.col("k") + 1), lambda i: F.array_join(F.slice("t", i, F.col("k")), " "))).alias("frase")).distinct()
    short = g.join(n.where(F.size("t") <= longest), "frase").select("query_id", "node_id")
    pad = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    far = n.where(F.size("t") > longest).select("node_id", pad("t").alias("p"))
    long_ = small(q.select("query_id", pad("t").alias("pq"))).join(far, F.col("pq").contains(F.col("p"))).select("query_id", "node_id")
    return short.unionAll(long_).distinct()


def entity_nodes(entities: DataFrame, node_table: DataFrame, cfg: Graph = GRAPH) -> DataFrame:
    """(query_id, entidad) matched with a node exactly, else with nodes that hold it or that it holds.

    A phrase within word bounds has all its words in the other text, so the pairs come from a join on the
    phrase's longest word; only names without any word are compared directly.
    """
    e = entities.withColumn("id", T.entity(T.without_articles(F.col("entidad"))))
    n = node_table.select("node_id")
    exact = e.join(n, e.id == n.node_id).select("query_id", "entidad", "node_id")
    rest = e.join(exact.select("query_id", "entidad"), ["query_id", "entidad"], "left_anti").where(F.length("id") >= cfg.min_node)
    a, b = F.col("node_id"), F.col("id")
    near: Column = a.contains(b) & T.contains_phrase(a, b) | b.contains(a) & T.contains_phrase(b, a)
    words = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    longest = lambda c: F.array_max(F.transform(words(c), lambda x: F.struct(F.length(x).alias("n"), x.alias("w"))))["w"]
    n = n.where(F.length("node_id") >= cfg.min_node)
    own = rest.select("query_id", "entidad", "id")
    holds = n.withColumn("w", F.explode(words(F.col("node_id")))).join(own.withColumn("w", longest(b)), "w")
    held = own.withColumn("w", F.explode(words(b))).join(n.withColumn("w", longest(a)), "w")
    cols = ["query_id", "entidad", "id", "node_id"]
    bare = F.size(words(b)) == 0
    odd = small(own.where(bare)).join(n, near).select(*cols).unionByName(small(n.where(F.size(words(a)) == 0)).join(own, near).select(*cols))
    loose = holds.select(*cols).unionByName(held.select(*cols)).where(near).unionByName(odd).select("query_id", "entidad", "node_id").distinct()
    return exact.unionByName(loose)


def _at_edges(found: DataFrame, edge_table: DataFrame, end: str, *more: str) -> DataFrame:
    """The fragments of the edges whose ``end`` is a found node; only those edges' lists are unfolded."""
    e = edge_table.select("src", "dst", "chunk_ids", *more)
    return found.join(e, F.col("node_id") == F.col(end)).withColumn("chunk_id", F.explode("chunk_ids")).drop("chunk_ids")


def one_hop(found: DataFrame, m: DataFrame, edge_table: DataFrame) -> DataFrame:
    """(query_id, chunk_id, puntuacion): one for each direct mention and for each fragment of an edge that
    leaves or reaches a found node; an edge between two found nodes counts twice."""
    own = found.join(m, "node_id").select("query_id", "chunk_id")
    out = _at_edges(found, edge_table, "src").select("query_id", "chunk_id")
    back = _at_edges(found, edge_table, "dst").select("query_id", "chunk_id")
    return own.unionAll(out).unionAll(back).groupBy("query_id", "chunk_id").agg(F.count(F.lit(1)).alias("puntuacion"))


def consult(queries: DataFrame, node_table: DataFrame, edge_table: DataFrame, entities: DataFrame | None = None, cfg: Graph = GRAPH) -> DataFrame:
    """The best fragments of each question by one-hop evidence -> (query_id, rank, chunk_id, puntuacion, relaciones).

    ``entities`` are recognised names (query_id, entidad), by default the question's capitalised runs.
    ``relaciones`` are the triples of the fragment's edges at found nodes, sorted.
    """
    if entities is None:
        entities = queries.select("query_id", F.explode(F.regexp_extract_all("consulta", F.lit(NAME), F.lit(0))).alias("entidad")).distinct()
    found = entity_nodes(entities, node_table, cfg).select("query_id", "node_id").unionByName(phrase_nodes(queries, node_table, cfg)).distinct()
    scores = one_hop(found, mentions_of(node_table), edge_table)
    w = Window.partitionBy("query_id").orderBy(F.desc("puntuacion"), "chunk_id")
    top = scores.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= cfg.evidence)
    at = _at_edges(found, edge_table, "src", "relacion").unionByName(_at_edges(found, edge_table, "dst", "relacion")).select("query_id", "chunk_id", F.concat_ws(" ", "src", "relacion", "dst").alias("r"))
    at = at.join(top.select("query_id", "chunk_id"), ["query_id", "chunk_id"], "left_semi")
    lists = at.groupBy("query_id", "chunk_id").agg(F.array_sort(F.collect_set("r")).alias("relaciones"))
    return top.join(lists, ["query_id", "chunk_id"], "left").select("query_id", "rank", "chunk_id", "puntuacion", F.coalesce("relaciones", F.array().cast("array<string>")).alias("relaciones"))
