"""Term statistics and recognition of graph entities in questions, for all questions at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GRAPH, STOPWORDS, Graph
from ..functions import text as T
from ..session import small_enough


def query_terms(queries: DataFrame) -> DataFrame:
    """U4: distinct tokens of the questions but stop words -> (token)."""
    return queries.select(F.explode(F.array_distinct(T.tokens(F.col("consulta")))).alias("token")).where(~F.col("token").isin(*sorted(STOPWORDS))).distinct()


def term_frequencies(fragments: DataFrame, queries: DataFrame) -> DataFrame:
    """Fragments that hold each term of the questions -> (token, df)."""
    terms = query_terms(queries)
    kept = terms.agg(F.collect_set("token").alias("terminos")) if small_enough(terms) else None
    own = fragments.select("chunk_id", F.array_distinct(T.tokens(F.coalesce("texto", F.lit("")))).alias("t"))
    if kept is not None:  # a bounded list of terms thins out each text before its words become rows
        own = own.join(F.broadcast(kept)).select("chunk_id", F.array_intersect("t", "terminos").alias("t"))
    rows = own.select("chunk_id", F.explode("t").alias("token"))
    if kept is None:
        rows = rows.join(terms, "token", "left_semi")
    return rows.distinct().groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def ngrams(queries: DataFrame, cfg: Graph = GRAPH) -> DataFrame:
    """Admissible n-grams of each question -> (query_id, frase, n, tokens), every occurrence once.

    Neither end may be a stop word; a single word must have ``min_chars`` characters and start with a
    capital or hold a digit where it stands in the question.
    """
    surface = T.words(F.regexp_replace("consulta", T.NOT_WORD, " "))
    q = queries.select("query_id", surface.alias("s")).withColumn("k", F.size("s"))
    q = q.select("query_id", "s", F.explode(F.sequence(F.lit(1), F.least("k", F.lit(cfg.max_ngram)))).alias("n"), "k").where("k > 0")
    q = q.select("query_id", "s", "n", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("n") + 1)).alias("i"))
    g = q.select("query_id", "n", F.slice("s", F.col("i"), F.col("n")).alias("w"))
    g = g.withColumn("tokens", F.transform("w", lambda x: F.lower(x))).withColumn("frase", F.array_join("tokens", " "))
    first, last = F.get("tokens", F.lit(0)), F.element_at("tokens", -1)
    ends = ~first.isin(*sorted(STOPWORDS)) & ~last.isin(*sorted(STOPWORDS))
    one = F.get("w", F.lit(0))
    single = (F.col("n") > 1) | ((F.length(one) >= cfg.min_chars) & one.rlike(r"^\p{Lu}|\p{N}"))
    return g.where(ends & single).select("query_id", "frase", "n", "tokens").distinct()


def phrase_weights(phrases: DataFrame, frequencies: DataFrame, total: DataFrame, cfg: Graph = GRAPH) -> DataFrame:
    """V6: mean informativeness of a phrase's tokens, raised by its length -> (query_id, frase, n, peso).

    Stop words have df 0, as they aren't counted. ``total`` has one row (total). Phrases under the
    threshold weigh 0.
    """
    tok = phrases.select("query_id", "frase", "n", F.explode("tokens").alias("token")).join(frequencies, "token", "left").crossJoin(F.broadcast(total))
    w = F.avg(F.log1p(F.col("total") / (1 + F.coalesce("df", F.lit(0)))))
    g = tok.groupBy("query_id", "frase", "n").agg(w.alias("m"), F.max("total").alias("total"))
    weight = F.col("m") * (1 + cfg.phrase_bonus * (F.col("n") - 1))
    return g.select("query_id", "frase", "n", F.when(F.col("m") < F.log1p(F.col("total") / cfg.df_informative), 0.0).otherwise(weight).alias("peso"))
