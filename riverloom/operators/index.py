"""Vector index maintenance: merge, append, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vector as V
from ..functions.encoder import Encoder, encode
from .corpus import append_mode, union_partitions
from .ranking import numbered


def merged(*parts: DataFrame, dimension: int | None = None) -> DataFrame:
    """Partitions (vec_id, embedding) in order, renormalised, with a running position; rows of another dimension raise."""
    rows = union_partitions(*parts)
    if dimension is not None:
        rows = rows.withColumn("embedding", F.when(F.size("embedding") == dimension, F.col("embedding")).otherwise(F.raise_error(F.lit("dimension"))))
    return rows.withColumn("embedding", V.unit(F.col("embedding")))


def running(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Position within ``key``."""
    return numbered(rows, key, list(order), "posicion")


def not_unit(rows: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """V3: vectors whose length isn't 1."""
    return rows.withColumn("norma", V.norm(F.col("embedding"))).where(F.abs(F.col("norma") - 1) > tolerance + 1e-5)


def self_retrieval(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """Q12: (query_id, propio): whether a stored vector finds itself first, or an equal one."""
    top = V.top_k(vectors, queries, 1)
    own = queries.select("query_id", F.col("v").alias("qv"))
    score = own.join(vectors.select(F.col("id").alias("query_id"), "v"), "query_id").select("query_id", F.round(V.dot(F.col("qv"), F.col("v")), 6).alias("s"))
    return top.join(score, "query_id").select("query_id", (F.col("score") == F.col("s")).alias("propio"))


def positional(metadata: DataFrame, vectors: DataFrame) -> DataFrame:
    """Metadata (linea, ...) and vectors (linea, embedding) by line number; unequal counts raise."""
    n, m = metadata.count(), vectors.count()
    if n != m:
        raise ValueError(f"{n} rows of metadata, {m} vectors")
    return metadata.join(vectors, "linea")


def append(existing: DataFrame, incoming: DataFrame, path: str, encoder: Encoder | None = None) -> str:
    """Encode and append new fragments (chunk_id, texto) to an index (chunk_id, embedding) kept at ``path``.

    All incoming ids must be new (append) or known (nothing to do); a part raises. The batch is written
    beside the index, checked for dimension and length, then appended; a second run changes nothing.
    """
    mode = append_mode(incoming, existing)
    if mode == "append":
        fresh = encode(incoming, "chunk_id", "texto", encoder).select(F.col("id").alias("chunk_id"), F.col("v").alias("embedding"))
        staged = f"{path}__batch"
        fresh.write.mode("overwrite").parquet(staged)
        batch = existing.sparkSession.read.parquet(staged)
        sizes = {r.d for r in existing.select(F.size("embedding").alias("d")).union(batch.select(F.size("embedding"))).distinct().collect()}
        if len(sizes) > 1 or not_unit(batch.where(F.exists("embedding", lambda x: x != 0))).limit(1).count():
            raise ValueError("dimension or length of the new vectors")
        batch.write.mode("append").parquet(path)
    return mode
