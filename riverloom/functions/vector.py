"""Vector functions: dense ARRAY columns, sums in double."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship

#: A query matrix of at most so many bytes is broadcast; more queries go in blocks.
QUERY_BYTES = 64 << 20


def dot(a: Column, b: Column) -> Column:
    """V1."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """V2: unit length; the zero vector stays."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def max_error(a: Column, b: Column) -> Column:
    """V10."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def zscore(c: Column, *keys: str, epsilon: float = 1e-9) -> Column:
    """V4: population z-score in each group; 0 where the values are all alike."""
    w = Window.partitionBy(*keys)
    sd = F.stddev_pop(c).over(w)
    return F.when(sd < epsilon, F.lit(0.0)).otherwise((c - F.avg(c).over(w)) / sd)


def over_max(c: Column, *keys: str) -> Column:
    """V8: share of the group's maximum; 0 where that isn't positive."""
    m = F.max(c).over(Window.partitionBy(*keys))
    return F.when(m > 0, c / m).otherwise(F.lit(0.0))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, digits: int = 6, id_type: str = "bigint") -> DataFrame:
    """Exact top-k by inner product -> (query_id, id, score, rank).

    ``vectors`` has (id, v), ``queries`` (query_id, v). The stated queries come to the driver in blocks of
    QUERY_BYTES and are broadcast; each partition of the vectors keeps its own k best of a query by
    matrix product, and a window ranks what is left. Ties by id.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = queries.select("query_id", "v").where("v is not null").collect()
    parts = []
    step = max(1, QUERY_BYTES // max(1, 8 * len(rows[0].v))) if rows else 1
    schema = f"query_id {dict(queries.dtypes)['query_id']}, id {dict(vectors.dtypes)['id']}, score double"
    for i in range(0, len(rows), step):
        block = rows[i : i + step]
        shared = spark.sparkContext.broadcast(([r.query_id for r in block], np.array([r.v for r in block], dtype=np.float64)))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            best: list[tuple[np.ndarray, np.ndarray]] = []
            for b in batches:
                column = b.column(1)
                keep = np.flatnonzero(np.array(column.is_valid()))
                if not len(keep):
                    continue
                own = np.array(b.column(0).to_pylist(), dtype=object)[keep]
                m = np.asarray(column.flatten(), dtype=np.float64).reshape(len(keep), -1)
                s = np.round(m @ q.T, digits)
                # what can't be among the k best of this batch, or of all so far, isn't sorted
                least = np.partition(s, len(s) - k, axis=0)[len(s) - k] if len(s) > k else np.full(len(ids), -np.inf)
                for j in range(len(ids)):
                    if len(best) <= j:
                        best.append((own[:0], s[:0, j]))
                    floor = max(least[j], best[j][1][-1]) if len(best[j][1]) == k else least[j]
                    top = np.flatnonzero(s[:, j] >= floor)
                    if not len(top):
                        continue
                    cand, score = np.concatenate([best[j][0], own[top]]), np.concatenate([best[j][1], s[top, j]])
                    order = np.lexsort((cand.astype(own.dtype) if own.dtype != object else np.argsort(np.argsort(cand)), -score))[:k]
                    best[j] = (cand[order], score[order])
            if best:
                q_ids = np.repeat(np.arange(len(ids)), [len(c) for c, _ in best])
                yield pa.RecordBatch.from_pydict(
                    {"query_id": [ids[x] for x in q_ids], "id": np.concatenate([c for c, _ in best]).tolist(), "score": np.concatenate([s for _, s in best])}
                )

        parts.append(vectors.select("id", "v").mapInArrow(search, schema))
    if not parts:
        return spark.createDataFrame([], schema + ", rank bigint")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
