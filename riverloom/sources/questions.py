"""Question files: numbered text, JSON Lines, PDF."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_START = r"(?i)^\s*(q\d{3})\b[\s:.\-\t]*(.+)$"


def from_lines(lines: DataFrame) -> DataFrame:
    """(archivo, pos, linea) -> (query_id, consulta). A line without a number goes on with the question before it;
    what stands before the first number is dropped."""
    from pyspark.sql import Window

    rows = lines.withColumn("id", F.lower(F.regexp_extract("linea", _START, 1)))
    w = Window.partitionBy("archivo").orderBy("pos")
    rows = rows.withColumn("isla", F.sum((F.col("id") != "").cast("int")).over(w)).where("isla > 0")
    said = F.when(F.col("id") != "", F.regexp_extract("linea", _START, 2)).otherwise(F.col("linea"))
    g = rows.withColumn("t", said).groupBy("archivo", "isla").agg(F.max("id").alias("query_id"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), " ").alias("t"))
    return g.select("query_id", F.trim(F.regexp_replace("t", r"(?U)\s+", " ")).alias("consulta"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True)
    return from_lines(raw.select(F.col("_metadata.file_path").alias("archivo"), F.posexplode(F.split("value", r"\r?\n")).alias("pos", "linea")))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """The first of query, pregunta and text that isn't empty."""
    rows = spark.read.schema("query_id string, query string, pregunta string, text string").json(path)
    first = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("query", "pregunta", "text")], F.lit(""))
    return rows.select("query_id", first.alias("consulta"))


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """The text of the pages, then as numbered text. Needs pypdf on the workers."""
    try:
        import pypdf  # noqa: F401
    except ImportError as e:
        raise RuntimeError("questions in PDF need the optional package pypdf") from e

    def pages(batches: Iterator):
        import io

        import pandas as pd
        import pypdf

        for b in batches:
            text = ["\n".join(p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(c)).pages) for c in b.content]
            yield pd.DataFrame({"archivo": b.path, "value": text})

    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(pages, "archivo string, value string")
    return from_lines(raw.select("archivo", F.posexplode(F.split("value", r"\r?\n")).alias("pos", "linea")))
