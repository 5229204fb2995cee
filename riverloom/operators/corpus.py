"""Fragments as a relation: dedupe, positions, lookups, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import MANDATORY
from .ranking import numbered


def latest(fragments: DataFrame) -> DataFrame:
    """One row a chunk_id, the one loaded last."""
    cols = [c for c in fragments.columns if c != "chunk_id"]
    best = F.max_by(F.struct(*cols), F.col("cargado_en")).alias("r")
    return fragments.groupBy("chunk_id").agg(best).select("chunk_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def union_partitions(*parts: DataFrame) -> DataFrame:
    """Partitions in order, with their number."""
    tagged = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def positions(fragments: DataFrame, *order: str) -> DataFrame:
    """Running number from 0 within each document, whatever its size."""
    return numbered(fragments, "doc_id", list(order), "nueva_posicion")


def new_rows(incoming: DataFrame, existing: DataFrame, key: str = "chunk_id") -> DataFrame:
    """J12."""
    return incoming.join(existing.select(key), key, "left_anti")


def append_mode(incoming: DataFrame, existing: DataFrame, key: str = "chunk_id") -> str:
    """All new -> append; none new -> nothing to do; a part -> error."""
    n, fresh = incoming.count(), new_rows(incoming, existing, key).count()
    if fresh not in (0, n):
        raise ValueError(f"{n - fresh} of {n} incoming keys exist already")
    return "append" if fresh else "nothing"


def inventory_lookup(fragments: DataFrame, inventory: DataFrame) -> DataFrame:
    """Left lookup; of several inventory rows the last by name wins. Size decides broadcast at run time."""
    inv = inventory.groupBy("doc_id").agg(F.max(F.struct("nombre_estandarizado", "observatorio", "carpeta")).alias("i"))
    inv = inv.select("doc_id", F.col("i.observatorio").alias("observatorio_inv"), F.regexp_replace("i.carpeta", r"\\", "/").alias("carpeta"), F.col("i.nombre_estandarizado").alias("nombre"))
    return fragments.join(inv, "doc_id", "left")


def unknown_keys(rows: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """J14."""
    return rows.join(reference.select(key), key, "left_anti")


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """A16."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def contiguity(fragments: DataFrame) -> DataFrame:
    """Whether positions run from 0 without gaps."""
    g = fragments.groupBy("doc_id").agg(F.min("posicion").alias("lo"), F.max("posicion").alias("hi"), F.count_distinct("posicion").alias("d"), F.count(F.lit(1)).alias("n"))
    ok = (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1) & (F.col("d") == F.col("n"))
    return g.select("doc_id", "n", F.coalesce(ok, F.lit(False)).alias("contigua"))


def missing_fields(fragments: DataFrame, fields: tuple[str, ...] = MANDATORY) -> DataFrame:
    """(campo, faltan), one row a mandatory field."""
    sums = [F.sum(F.when(F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == ""), 1).otherwise(0)).cast("bigint").alias(f) for f in fields]
    pairs = ", ".join(f"'{f}', {f}" for f in fields)
    return fragments.agg(*sums).selectExpr(f"stack({len(fields)}, {pairs}) as (campo, faltan)")


#: Q10: what a finished text must not hold: values that weren't filled in, marks of a template or of HTML, slips of spacing and of joining.
_UNFILLED = ("None", "nan", "NaN", "null", "undefined")
_JOINERS = ("de", "del", "en", "y")
LINT = {
    "sin_valor": rf"\b({'|'.join(_UNFILLED)})\b",
    "campo_de_plantilla": r"\{[a-z_]+\}",
    "parentesis_sin_nada": r"\(\s*\)",
    "espacios_seguidos": r" {2,}",
    "etiqueta_html": r"<[a-zA-Z/][^>]*>",
    "coma_suelta": r"\s,|,,",
    "nexo_doble": r"\b(" + "|".join(rf"{w}\s+{w}" for w in _JOINERS) + r")\b",
}


def lint(fragments: DataFrame) -> DataFrame:
    """Q10: (regla, n) of the patterns that a finished text must not hold."""
    hits = [F.coalesce(F.col("texto").rlike(p), F.lit(False)).alias(f"h{i}") for i, p in enumerate(LINT.values())]
    rows = fragments.select("chunk_id", F.xxhash64("texto").alias("h"), *hits).distinct()
    sums = [F.sum(F.col(f"h{i}").cast("int")).cast("bigint").alias(f"c{i}") for i in range(len(LINT))]
    pairs = ", ".join(f"'{k}', c{i}" for i, k in enumerate(LINT))
    return rows.agg(*sums).selectExpr(f"stack({len(LINT)}, {pairs}) as (regla, n)").select("regla", F.coalesce("n", F.lit(0)).alias("n"))


def signature_share(fragments: DataFrame) -> DataFrame:
    """How many texts share the most common shape."""
    shape = F.xxhash64(T.signature(F.col("texto"))).alias("s"), F.md5(T.signature(F.col("texto"))).alias("m")
    rows = fragments.where("texto is not null").select("chunk_id", F.xxhash64("texto").alias("h"), *shape).distinct()
    g = rows.groupBy("s", "m").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("firmas"), F.sum("n").alias("total"))


def stratified(rows: DataFrame, stratum: str, score: Column, key: str) -> DataFrame:
    """Of each stratum the best and the median row, and the first whose score is 0 or null, the last where none is -> adds rn from 1."""
    ranked = numbered(rows.withColumn("_s", score), stratum, [F.desc("_s"), key], "_r", "_all").withColumn("rn", F.col("_r") + 1)
    zero = F.min(F.when(F.coalesce("_s", F.lit(0)) <= 0, F.col("rn"))).alias("_zero")
    least = ranked.groupBy(F.col(stratum).alias("_g")).agg(zero)
    ranked = ranked.join(least, F.col(stratum).eqNullSafe(F.col("_g")))
    return ranked.where((F.col("rn") == 1) | (F.col("rn") == F.floor(F.col("_all") / 2) + 1) | (F.col("rn") == F.coalesce("_zero", "_all"))).drop("_s", "_r", "_all", "_g", "_zero")


def validate_chunks(fragments: DataFrame, most: int = 250) -> DataFrame:
    """Q7, Q9: one row a check with the number of offending fragments."""
    t = F.col("texto")
    tests = {
        "sin texto": T.missing(t).isNull(),
        "mas de 250 palabras": F.size(T.words(F.coalesce(t, F.lit("")))) > most,
        "sin cierre": ~F.coalesce(F.trim(t), F.lit("")).rlike(r"[.!?]$"),
        "valor nulo": F.coalesce(t.rlike(r"\b(None|nan)\b"), F.lit(False)),
        "fenomeno": F.coalesce(~F.col("fenomeno").between(1, 4), F.lit(True)),
    }
    hits = [F.coalesce(c, F.lit(False)).alias(f"h{i}") for i, c in enumerate(tests.values())]
    rows = fragments.select("chunk_id", F.xxhash64("texto").alias("h"), "fenomeno", *hits).distinct()
    sums = [F.sum(F.col(f"h{i}").cast("int")).cast("bigint").alias(f"c{i}") for i in range(len(tests))]
    pairs = ", ".join(f"'{k}', c{i}" for i, k in enumerate(tests))
    return rows.agg(*sums).selectExpr(f"stack({len(tests)}, {pairs}) as (control, n)").select("control", F.coalesce("n", F.lit(0)).alias("n"))
