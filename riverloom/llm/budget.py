"""Problem 6: token totals by source, language, phenomenon and format as they should read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encoding, language, tokens


def sources(fragments: DataFrame) -> DataFrame:
    """(doc_id, fuente): the file name of each document: the most frequent of its intact and restored names, null without any."""
    fixed = encoding.repairs(fragments).where("campo = 'fuente'").select("chunk_id", "estado", "restaurado").distinct()
    own = fragments.select("chunk_id", "doc_id", "fuente").distinct().join(fixed, "chunk_id", "left")
    name = F.when(F.col("estado").isNull(), F.nullif(F.trim("fuente"), F.lit(""))).when(F.col("estado") == "reparado", F.col("restaurado"))
    counts = own.withColumn("f", name).where("f is not null").groupBy("doc_id", "f").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("doc_id").agg(F.max_by("f", F.struct("n", "f")).alias("fuente"))


def labelled(fragments: DataFrame, tokenizer_dir: str | None = None) -> DataFrame:
    """One row for each distinct fragment: (chunk_id, tokens, utilizable, fuente, idioma, fenomeno, formato).

    ``idioma`` is what the text is written in, for lists, tables and junk the label's code, else und;
    ``formato`` is in lower case without marks; ``utilizable`` tells whether the recorded count can be used.
    """
    est = tokens.token_estimates(fragments, tokenizer_dir).groupBy("chunk_id").agg(F.max("tokens").alias("tokens"), F.max(F.col("motivo").isNull()).alias("utilizable"))
    lang = language.languages(fragments).select("chunk_id", F.coalesce("idioma", "etiqueta", F.lit("und")).alias("idioma")).groupBy("chunk_id").agg(F.max("idioma").alias("idioma"))
    form = F.nullif(F.regexp_replace(F.lower("formato"), "[^a-z0-9]", ""), F.lit(""))
    own = fragments.groupBy("chunk_id").agg(F.max("doc_id").alias("doc_id"), F.max("fenomeno").alias("fenomeno"), F.max(form).alias("formato"))
    return own.join(est, "chunk_id").join(lang, "chunk_id").join(sources(fragments), "doc_id", "left").drop("doc_id")


def totals(fragments: DataFrame, tokenizer_dir: str | None = None) -> DataFrame:
    """(corte, valor, fragmentos, tokens, inservibles): totals of each slice by fuente, idioma, fenomeno and formato, and of all.

    Values are text; null stays null. ``inservibles`` counts fragments whose recorded count can't enter a budget.
    """
    rows = labelled(fragments, tokenizer_dir)
    pairs = ["fuente", "idioma", "fenomeno", "formato"]
    long = rows.select("tokens", "utilizable", F.explode(F.array(*[F.struct(F.lit(p).alias("corte"), F.col(p).cast("string").alias("valor")) for p in pairs], F.struct(F.lit("todo").alias("corte"), F.lit("todo").alias("valor")))).alias("c"))
    g = long.groupBy(F.col("c.corte").alias("corte"), F.col("c.valor").alias("valor"))
    return g.agg(F.count(F.lit(1)).alias("fragmentos"), F.sum("tokens").cast("bigint").alias("tokens"), F.sum((~F.col("utilizable")).cast("int")).cast("bigint").alias("inservibles"))
