"""Fragment files: JSON Lines in both dialects, strict and lenient; sinks of fragments and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..schemas import FRAGMENT, FRAGMENT_ANY


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """One fragment a line; a bad line fails the read."""
    return spark.read.schema(FRAGMENT).option("mode", "FAILFAST").json(path)


def dialect(rows: DataFrame) -> DataFrame:
    """The canonical columns from either dialect; columns that lack count as null."""
    have = {c for c in rows.columns}
    get = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have], F.lit(None))
    path = get("ruta_fuente", "source_path")
    source = F.coalesce(X.missing(get("fuente").cast("string")), X.basename(path.cast("string")))
    phen = F.coalesce(get("fenomeno").cast("string"), get("phenomenon").cast("string"))
    return rows.select(
        get("doc_id").cast("string").alias("doc_id"), get("chunk_id").cast("string").alias("chunk_id"), source.alias("fuente"),
        F.coalesce(X.missing(get("formato").cast("string")), X.extension(source)).alias("formato"), X.phenomenon(phen).alias("fenomeno"), get("posicion").cast("int").alias("posicion"),
        get("num_tokens", "word_count").cast("int").alias("num_tokens"), get("texto", "text").cast("string").alias("texto"), path.cast("string").alias("ruta_fuente"),
        get("observatorio", "observatory").cast("string").alias("observatorio"), get("pagina_inicio", "page_start").cast("int").alias("pagina_inicio"),
        get("pagina_fin", "page_end").cast("int").alias("pagina_fin"),
    )


def read_lenient(spark: SparkSession, folder: str, pattern: str = "*.jsonl", least: int = 10) -> DataFrame:
    """Every matching file under ``folder``; blank and bad lines drop out, as do texts under ``least`` characters.

    Adds ``base_origen``, the file's folder. Lacking ids become ``{folder}_chunk_{line}`` and ``unknown``,
    a lacking phenomenon 1. Lines are numbered within their file as they stand, blank ones included.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    lines = raw.select(F.col("_metadata.file_path").alias("f"), F.posexplode(F.split("value", r"\r?\n")).alias("linea", "value")).where(F.trim("value") != "")
    kept = T.StructType([f for f in FRAGMENT_ANY.fields if f.name not in ("fenomeno", "phenomenon")] + [T.StructField(n, T.StringType()) for n in ("fenomeno", "phenomenon")])
    rows = lines.withColumn("j", F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})).where("j is not null and j._corrupt_record is null")
    rows = rows.select("f", "linea", "j.*").drop("_corrupt_record")
    base = F.element_at(F.split("f", "/"), -2)
    out = rows.withColumn("base_origen", base)
    text = F.trim(F.coalesce("texto", "text"))
    return out.select(
        F.coalesce("doc_id", F.lit("unknown")).alias("doc_id"), F.coalesce("chunk_id", F.concat(F.col("base_origen"), F.lit("_chunk_"), F.col("linea").cast("string"))).alias("chunk_id"),
        text.alias("texto"), F.coalesce(X.phenomenon(F.coalesce("fenomeno", "phenomenon")), F.lit(1)).alias("fenomeno"), "base_origen",
    ).where(F.length("texto") >= least)


def write_lines(rows: DataFrame, path: str, order: str | None = None) -> None:
    """K1, K6: JSON Lines; with ``order`` in one sorted file, for results of a bounded set of questions."""
    (rows.orderBy(order).coalesce(1) if order else rows).write.mode("overwrite").json(path)


def write_staged(rows: DataFrame, path: str, verify=None) -> None:
    """K8: written beside its place, verified, then renamed; a failed check leaves the old data."""
    spark = rows.sparkSession
    staged = f"{path}__staged"
    rows.write.mode("overwrite").parquet(staged)
    if verify is not None and not verify(spark.read.parquet(staged)):
        raise ValueError(f"{staged} failed its check")
    jvm = spark._jvm
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staged)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{staged} could not be renamed")


def write_sample(rows: DataFrame, path: str, n: int = 50) -> None:
    """K5."""
    rows.limit(n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
