"""Checks as report rows (control, gravedad, n, muestra); FALLO stops a job, AVISO doesn't."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import corpus as C
from .maps import SAY

FAIL, WARN = "FALLO", "AVISO"
COUNTRIES = ("Colombia", "Brasil", "Venezuela", "Ecuador", "Perú", "Bolivia")
MOJIBAKE = "[ÃÂâ][\u0080-ÿ]"


def check(name: str, severity: str, bad: DataFrame, key: str) -> DataFrame:
    """One row: how many rows break the rule, and the least key among them."""
    return bad.agg(F.count(F.lit(1)).alias("n"), F.min(F.col(key).cast("string")).alias("muestra")).select(F.lit(name).alias("control"), F.lit(severity).alias("gravedad"), "n", "muestra")


def tests(rows: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """Many rules in one pass over the rows; a null condition doesn't break a rule."""
    cols = []
    for i, (_, c) in enumerate(rules.values()):
        bad = F.coalesce(c, F.lit(False))
        cols += [F.coalesce(F.sum(bad.cast("int")), F.lit(0)).cast("bigint").alias(f"n{i}"), F.min(F.when(bad, F.col(key).cast("string"))).alias(f"m{i}")]
    pairs = ", ".join(f"'{k}', '{s}', n{i}, m{i}" for i, (k, (s, _)) in enumerate(rules.items()))
    return rows.agg(*cols).selectExpr(f"stack({len(rules)}, {pairs}) as (control, gravedad, n, muestra)")


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def enforce(report_: DataFrame) -> None:
    """Raise where a FALLO was found."""
    bad = report_.where((F.col("gravedad") == FAIL) & (F.col("n") > 0)).collect()
    if bad:
        raise ValueError("; ".join(f"{r.control}: {r.n} ({r.muestra})" for r in bad))


def traceability(results: DataFrame, fragments: DataFrame) -> DataFrame:
    """(query_id, campo, valor) of reported ids that the base lacks."""
    f = results.select("query_id", F.explode("fragments").alias("f"))
    chunk = C.unknown_keys(f.select("query_id", F.col("f.chunk_id").alias("chunk_id")), fragments.select("chunk_id").distinct(), "chunk_id")
    docs = f.select("query_id", F.col("f.doc_id").alias("doc_id")).unionByName(results.select("query_id", F.explode("documents").alias("d")).select("query_id", F.col("d.doc_id").alias("doc_id")))
    doc = C.unknown_keys(docs.distinct(), fragments.select("doc_id").distinct(), "doc_id")
    return chunk.select("query_id", F.lit("chunk_id").alias("campo"), F.col("chunk_id").alias("valor")).unionByName(doc.select("query_id", F.lit("doc_id").alias("campo"), F.col("doc_id").alias("valor")))


def missing_countries(rows: DataFrame, expected: tuple[str, ...] = COUNTRIES) -> DataFrame:
    """Expected countries without a row, accents aside."""
    want = rows.sparkSession.createDataFrame([(c,) for c in expected], "esperado string").withColumn("k", F.lower(T.without_accents(F.col("esperado"))))
    have = rows.select(F.lower(T.without_accents(F.col("pais"))).alias("k")).distinct()
    return want.join(have, "k", "left_anti").select("esperado")


def municipalities(rows: DataFrame, expected: int = 985, tolerance: float = 0.10, countries: tuple[str, ...] = COUNTRIES) -> DataFrame:
    """Q6, Q8."""
    n = rows.agg(F.count(F.lit(1)).alias("n")).where(F.abs(F.col("n") - expected) > tolerance * expected)
    pairs = rows.select("doc_id", "fuente").where("doc_id is not null and fuente is not null").distinct()
    rules = {
        "sin nivel2": (FAIL, T.missing(F.col("nivel2")).isNull()), "mojibake": (FAIL, F.concat_ws(" ", "nivel1", "nivel2", "pais").rlike(MOJIBAKE)),
        "poblacion fuera de rango": (FAIL, ~F.col("poblacion").between(0, 20_000_000)), "sin pais": (WARN, T.missing(F.col("pais")).isNull()),
    }
    return report(
        check("numero de municipios", WARN, n, "n"), check("repetidos", FAIL, C.duplicates(rows, "id_municipio"), "id_municipio"), check("paises que faltan", FAIL, missing_countries(rows, countries), "esperado"),
        check("fuente con varios documentos", FAIL, pairs.groupBy("fuente").count().where("count > 1"), "fuente"), tests(rows, "id_municipio", rules),
    )


def map_texts(chunks: DataFrame, most: int = 250) -> DataFrame:
    """Q7, Q10: texts made from municipalities."""
    t = F.col("texto")
    part = lambda *keys: "|".join(max(re.split(r"\{\}", SAY[k]), key=len).strip(" .,—") for k in keys)  # noqa: E731  the longest stretch between two values
    english = t.rlike(part("en", "en_nada"))
    portuguese = t.rlike(part("es_pt"))
    none, local = t.rlike(part("nada", "en_nada")), t.rlike(f"{SAY['local'].split(' ', 1)[1]}|{SAY['locales'].split(' ', 1)[1]}")
    declared = T.declared_groups(t)
    plain = lambda c: (F.length(c) > 4) & (F.col(c) == T.without_accents(F.col(c)))
    rules = {
        "campos obligatorios": (FAIL, T.missing(t).isNull() | F.col("chunk_id").isNull() | F.col("doc_id").isNull()), "limite de palabras": (FAIL, F.size(T.words(t)) > most), "sin cierre": (FAIL, ~F.trim(t).rlike(r"[.!?]$")),
        "portugues fuera de Brasil": (FAIL, portuguese & (F.col("pais") != "Brasil")), "contradiccion": (FAIL, none & local), "grupos declarados": (WARN, declared.isNotNull() & ~local & (declared != F.col("n_grupos"))),
        "mezcla de idiomas": (FAIL, portuguese & t.rlike(part("poblacion", "area"))), "toponimos sin tilde": (WARN, plain("nivel1") | plain("nivel2")),
    } | {k: (WARN, t.rlike(p)) for k, p in C.LINT.items()}
    share = C.signature_share(chunks).where(F.col("n") > 0.5 * F.col("total"))
    tail = chunks.agg(F.count(F.lit(1)).alias("t"), F.sum((~english).cast("int")).alias("n")).where((F.col("n") > 0) & (F.col("n") < F.col("t")))
    return report(tests(chunks, "chunk_id", rules), check("estructura repetida", WARN, share, "n"), check("cola en ingles incompleta", FAIL, tail, "n"), check("chunk_id repetidos", FAIL, C.duplicates(chunks, "chunk_id"), "chunk_id"))


def index_checks(before: DataFrame, after: DataFrame, key: str = "vec_id", tolerance: float = 1e-5) -> DataFrame:
    """Q11, Q12: rows of an index that were lost, changed or aren't of unit length after a merge or an append."""
    from ..functions import vector as V
    from .index import not_unit

    b = before.select(key, F.col("embedding").alias("old"))
    joined = b.join(after.select(key, "embedding"), key, "left")
    return report(
        check("vectores perdidos", FAIL, joined.where("embedding is null"), key), check("vectores cambiados", FAIL, joined.where(V.max_error(V.unit(F.col("old")), F.col("embedding")) > tolerance), key),
        check("norma", FAIL, not_unit(after), key), check("claves repetidas", FAIL, C.duplicates(after, key), key),
    )


def review_sample(chunks: DataFrame, stratum: str = "pais") -> DataFrame:
    """K9: one text a stratum and rank for reading: (linea)."""
    s = C.stratified(chunks, stratum, F.col("n_grupos"), "chunk_id")
    return s.select(F.concat(F.lit("["), F.coalesce(stratum, F.lit("?")), F.lit(" "), F.col("rn").cast("string"), F.lit("] "), F.col("chunk_id"), F.lit(": "), F.coalesce("texto", F.lit(""))).alias("linea"))
