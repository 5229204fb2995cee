"""Hybrid retrieval over all questions at once: candidates, fusion, refinement, ranking, result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import RETRIEVAL, Retrieval
from ..functions import text as T
from ..functions import vector as V
from ..functions.encoder import Encoder, encode
from ..functions.windows import refined_windows


def candidates(spaces: list[DataFrame], evidence: DataFrame, cfg: Retrieval = RETRIEVAL) -> DataFrame:
    """(query_id, chunk_id, origen); a later space overrides an earlier one, the graph only adds."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")
    graph = evidence.where("score is not null").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= cfg.graph_candidates)
    rows = graph.select("query_id", "chunk_id", F.lit(-1).alias("p"))
    for i, s in enumerate(spaces):
        rows = rows.unionAll(s.select("query_id", "chunk_id", F.lit(i)))
    return rows.groupBy("query_id", "chunk_id").agg(F.max("p").alias("origen"))


def fused(pool: DataFrame, evidence: DataFrame, cfg: Retrieval = RETRIEVAL, digits: int = 6) -> DataFrame:
    """z(cosine) + weight * evidence / its maximum over all fragments of the question -> adds p.

    ``pool`` has (query_id, chunk_id, coseno, ...).
    """
    ev = evidence.where("score is not null").select("query_id", "chunk_id", "score")
    top = ev.groupBy("query_id").agg(F.max("score").alias("m"))  # not a window: a question may hold most of the evidence
    g = pool.select("query_id", "chunk_id").join(ev, ["query_id", "chunk_id"]).join(top, "query_id")
    g = g.select("query_id", "chunk_id", F.when(F.col("m") > 0, F.col("score") / F.col("m")).otherwise(0.0).alias("g"))
    rows = pool.join(g, ["query_id", "chunk_id"], "left")
    z = V.zscore(F.col("coseno"), "query_id", epsilon=cfg.z_epsilon)
    return rows.withColumn("p", F.round(z + cfg.graph_weight * F.coalesce("g", F.lit(0.0)), digits))


def best(rows: DataFrame, k: int) -> DataFrame:
    """O3: the k best of each question by p."""
    w = Window.partitionBy("query_id").orderBy(F.desc("p"), "chunk_id")
    return rows.withColumn("previo", F.row_number().over(w)).where(F.col("previo") <= k)


def best_window(rows: DataFrame, queries: DataFrame, encoder: Encoder | None = None, digits: int = 6, cfg: Retrieval = RETRIEVAL) -> DataFrame:
    """The best window of each refined fragment -> (query_id, chunk_id, ventana, coseno_refinado).

    ``rows`` has (query_id, chunk_id, texto, coseno), ``queries`` (query_id, v). Only the few refined
    fragments are encoded, each distinct window once; the stored cosine stays where the text is one
    unchanged window.
    """
    w = refined_windows(rows.select("query_id", "chunk_id", "coseno", "texto"), most=cfg.max_words)
    w = w.select("query_id", "chunk_id", "coseno", "igual", F.posexplode("ventanas").alias("i", "ventana"))
    pending = w.where(~F.col("igual"))
    vectors = encode(pending.select(F.xxhash64("ventana").alias("h"), "ventana").distinct(), "h", "ventana", encoder)
    q = queries.select("query_id", F.col("v").alias("qv"))
    fresh = pending.withColumn("h", F.xxhash64("ventana")).join(vectors, F.col("h") == F.col("id")).join(q, "query_id")
    fresh = fresh.select("query_id", "chunk_id", "i", "ventana", F.round(V.dot(F.col("qv"), F.col("v")), digits).alias("c"))
    every = w.where("igual").select("query_id", "chunk_id", "i", "ventana", F.col("coseno").alias("c")).unionByName(fresh)
    g = every.groupBy("query_id", "chunk_id").agg(F.max_by(F.struct("ventana", "c"), F.struct("c", -F.col("i"))).alias("b"))
    return g.select("query_id", "chunk_id", F.col("b.ventana").alias("ventana"), F.col("b.c").alias("coseno_refinado"))


def capped(rows: DataFrame, cfg: Retrieval = RETRIEVAL) -> DataFrame:
    """Top fragments with at most ``per_document`` of a document, filled up with the rest -> adds rank."""
    a = Window.partitionBy("query_id", "doc_id").orderBy(F.desc("p"), "chunk_id")
    rows = rows.withColumn("rnd", F.row_number().over(a))
    b = Window.partitionBy("query_id").orderBy((F.col("rnd") > cfg.per_document).cast("int"), F.desc("p"), "chunk_id")
    return rows.withColumn("rank", F.row_number().over(b).cast("bigint")).where(F.col("rank") <= cfg.fragments).drop("rnd")


def documents(rows: DataFrame, cfg: Retrieval = RETRIEVAL, digits: int = 7, fill: DataFrame | None = None) -> DataFrame:
    """Best documents of each question, grouped by source, reported by their best fragment's doc_id.

    Points have one digit more than p, so that none lies between two roundings. Where ``rows`` has fewer sources than are asked for, those of ``fill``, the whole pool, follow in its order.
    """
    source = F.coalesce(F.nullif(F.trim("fuente"), F.lit("")), F.col("doc_id"))

    def scored(x: DataFrame) -> DataFrame:
        g = x.groupBy("query_id", source.alias("grupo")).agg(
            F.max("p").alias("m"), F.sum(F.greatest("p", F.lit(0.0))).alias("s"), F.max_by("doc_id", F.struct("p", F.col("chunk_id"))).alias("doc_id")
        )
        return g.withColumn("puntos", F.round(F.col("m") + cfg.document_bonus * (F.col("s") - F.greatest("m", F.lit(0.0))), digits))

    g = scored(rows).withColumn("tarde", F.lit(0))
    if fill is not None:
        g = g.unionByName(scored(fill).join(g.select("query_id", "grupo"), ["query_id", "grupo"], "left_anti").withColumn("tarde", F.lit(1)))
    w = Window.partitionBy("query_id").orderBy("tarde", F.desc("puntos"), "grupo")
    return g.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= cfg.documents).drop("tarde")


def results(fragments: DataFrame, docs: DataFrame) -> DataFrame:
    """One nested row for each question."""
    f = fragments.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(F.col("rank"), "chunk_id", "doc_id", F.col("ventana").alias("text")))).alias("fragments"))
    d = docs.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("documents"))
    return d.join(f, "query_id").select("query_id", "documents", "fragments")


def validate_results(results_: DataFrame, cfg: Retrieval = RETRIEVAL) -> DataFrame:
    """Q1 to Q4: (query_id, fallo), one row for each broken rule."""
    d, f = F.col("documents"), F.col("fragments")
    ids = F.transform(d, lambda x: x["doc_id"])
    ranks = lambda a: F.exists(F.transform(a, lambda x, i: x["rank"] != i + 1), lambda b: b)
    tests = {
        "documentos": F.size(d) != cfg.documents, "rango de documento": ranks(d), "documentos repetidos": F.size(F.array_distinct(ids)) != F.size(ids),
        "fragmentos": F.size(f) != cfg.fragments, "rango de fragmento": ranks(f), "palabras": F.exists(f, lambda x: F.size(T.words(x["text"])) > cfg.max_words),
        "vacio": F.exists(f, lambda x: F.trim(x["text"]) == ""), "query_id": ~F.col("query_id").rlike(r"^q\d{3}$"),
    }
    broken = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in tests.items()]), lambda x: x.isNotNull())
    return results_.select("query_id", F.explode(broken).alias("fallo"))
