import numpy as np
import pytest
from pyspark.sql import functions as F

from riverloom.functions import vector as V
from riverloom.functions.encoder import HashEncoder, encode
from riverloom.operators import corpus as C
from riverloom.operators import graph as G
from riverloom.operators import index as I
from riverloom.operators import maps as M
from riverloom.operators import retrieval as R


def rows(df, *keys):
    return sorted(tuple(r) for r in (df.select(*keys) if keys else df).collect())


def test_zscore_and_share(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 1.0), ("b", 3.0)], "q string, x double")
    z = df.withColumn("z", V.zscore(F.col("x"), "q")).withColumn("s", V.over_max(F.col("x"), "q"))
    assert rows(z, "q", "z") == [("a", 0.0), ("a", 0.0), ("b", -1.0), ("b", 1.0)]
    neg = spark.createDataFrame([("a", -2.0)], "q string, x double").select(V.over_max(F.col("x"), "q").alias("s"))
    assert neg.first().s == 0.0


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    m = rng.standard_normal((60, 8))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[7] = m[3]
    vecs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(99, None)], "id bigint, v array<double>").repartition(3)
    q = vecs.where("id < 5").select(F.col("id").alias("query_id"), "v")
    got = {(r.query_id, r.rank): r.id for r in V.top_k(vecs, q, 4).collect()}
    for i in range(5):
        order = sorted(range(60), key=lambda j: (-round(float(m[i] @ m[j]), 6), j))[:4]
        assert [got[i, k + 1] for k in range(4)] == order
    assert all(r.propio for r in I.self_retrieval(vecs.where("v is not null"), q).collect())
    assert V.top_k(vecs, q.limit(0), 3).count() == 0


def test_unit(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "i int, v array<double>")
    assert rows(df.select("i", V.unit(F.col("v")).alias("u"))) == [(1, [0.6, 0.8]), (2, [0.0, 0.0])]


def test_encoder(spark):
    v = {r.id: r.v for r in encode(spark.createDataFrame([("a", "Uno dos uno"), ("b", ""), ("c", None)], "k string, t string"), "k", "t").collect()}
    assert set(v) == {"a", "b"} and abs(sum(x * x for x in v["a"]) - 1) < 1e-12 and not any(v["b"])
    assert v["a"] == HashEncoder().encode(["uno, DOS: uno"])[0].tolist()


def test_capped(spark):
    data = [("q", f"a{i}", "A", 1.0 - i / 100) for i in range(7)] + [("q", "b0", "B", 0.5), ("q", "b1", "B", 0.4)]
    df = spark.createDataFrame(data, "query_id string, chunk_id string, doc_id string, p double")
    got = [r.chunk_id for r in R.capped(df).orderBy("rank").collect()]
    assert got == ["a0", "a1", "a2", "a3", "a4", "b0", "b1", "a5", "a6"]


def test_document_score(spark):
    df = spark.createDataFrame([("q", "c1", "d", "f", 1.0), ("q", "c2", "d", "f", 0.5), ("q", "c3", "d", "f", -0.2), ("q", "c4", "e", "", 0.9)], "query_id string, chunk_id string, doc_id string, fuente string, p double")
    assert rows(R.documents(df), "rank", "doc_id", "puntos") == [(1, "d", 1.15), (2, "e", 0.9)]


def test_candidates_precedence(spark):
    a = spark.createDataFrame([("q", "c1"), ("q", "c2")], "query_id string, chunk_id string")
    b = spark.createDataFrame([("q", "c2")], "query_id string, chunk_id string")
    ev = spark.createDataFrame([("q", "c3", 1.0), ("q", "c1", 2.0), ("q", "c4", None)], "query_id string, chunk_id string, score double")
    assert rows(R.candidates([a, b], ev), "chunk_id", "origen") == [("c1", 0), ("c2", 1), ("c3", -1)]


def test_results_validation(spark):
    bad = spark.createDataFrame([("x1", [(1, "d"), (3, "d")], [(1, "c", "d", " ")])], "query_id string, documents array<struct<rank:bigint,doc_id:string>>, fragments array<struct<rank:bigint,chunk_id:string,doc_id:string,text:string>>")
    assert {r.fallo for r in R.validate_results(bad).collect()} == {"documentos", "rango de documento", "documentos repetidos", "fragmentos", "vacio", "query_id"}


def test_graph_direction_and_doubles(spark):
    m = spark.createDataFrame([("c1", "b", 0, "r1"), ("c1", "a", 1, "r1"), ("c2", "a", 0, "r2"), ("c2", "b", 1, "r2")], "chunk_id string, node_id string, ord int, relacion string")
    assert rows(G.edges(m)) == [("a", "b", "r2", 1), ("b", "a", "r1", 1)]
    ents = spark.createDataFrame([("q", "u", 1.0)], "query_id string, node_id string, peso double")
    edge = spark.createDataFrame([("u", "v", ["c"]), ("v", "u", ["c"])], "src string, dst string, chunk_ids array<string>")
    w = spark.createDataFrame([("u", 1, 1.0), ("v", 1, 1.0)], "node_id string, df bigint, peso double")
    assert G.neighbours(ents, edge, w).count() == 2
    ment = spark.createDataFrame([("v", "c")], "node_id string, chunk_id string")
    e = G.evidence(ents, ment, G.neighbours(ents, edge, w), ment).first()
    assert abs(e.score - 0.3) < 1e-12
    found = spark.createDataFrame([("q", "u"), ("q", "v")], "query_id string, node_id string")
    assert rows(G.one_hop(found, ment.limit(0), edge.limit(1)), "chunk_id", "puntuacion") == [("c", 2)]


def test_phrase_and_entity_nodes(spark):
    nodes = spark.createDataFrame([("el coronavirus",), ("coronavirus",), ("ab",), ("gran río negro del norte largo y muy ancho",)], "node_id string")
    q = spark.createDataFrame([("q1", "novel coronavirus"), ("q2", "El gran Río negro del norte largo y muy ancho.")], "query_id string, consulta string")
    assert rows(G.phrase_nodes(q, nodes)) == [("q1", "coronavirus"), ("q2", "gran río negro del norte largo y muy ancho")]
    e = spark.createDataFrame([("q", "El Coronavirus"), ("q", "río negro")], "query_id string, entidad string")
    assert rows(G.entity_nodes(e, nodes)) == [("q", "El Coronavirus", "coronavirus"), ("q", "río negro", "gran río negro del norte largo y muy ancho")]


def test_partial_append_aborts(spark):
    old = spark.createDataFrame([("a",)], "chunk_id string")
    for ids, mode in ((["a"], "nothing"), (["b", "c"], "append")):
        assert C.append_mode(spark.createDataFrame([(i,) for i in ids], "chunk_id string"), old) == mode
    with pytest.raises(ValueError):
        C.append_mode(spark.createDataFrame([("a",), ("b",)], "chunk_id string"), old)


def test_merge_checks_dimension(spark):
    e = spark.createDataFrame([(1, [2.0, 0.0])], "vec_id bigint, embedding array<double>")
    m = I.merged(e, e, dimension=2).collect()
    assert [r.embedding for r in m] == [[1.0, 0.0]] * 2 and {r.part for r in m} == {0, 1}
    with pytest.raises(Exception, match="dimension"):
        I.merged(e, dimension=3).collect()


def _municipality(spark, **over):
    base = {
        "id_municipio": "m1", "pais": "Colombia", "nivel1": "Bolivar", "nivel2": "Leticia", "nivel1_pt": None, "nivel2_pt": None, "poblacion": 1234.0, "area_km2": 10.4, "grupos": [], "n_grupos": 0,
        "popup_es": None, "investigado": False, "zoom": 3, "tile_x": 1, "tile_y": 2, "doc_id": "D", "fuente": "f.pbf",
    } | over
    kinds = {"poblacion": "double", "area_km2": "double", "grupos": "array<string>", "n_grupos": "int", "investigado": "boolean", "zoom": "int", "tile_x": "int", "tile_y": "int"}
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in base))


def test_municipality_text(spark):
    t = M.chunks(_municipality(spark)).first()
    assert t.chunk_id == "D_chunk_0" and t.texto.startswith("Leticia es un municipio del departamento de Bolívar (Bolivar), Colombia, con una población de 1.234 habitantes y una extensión de 10 km² en la Amazonía colombiana.")
    assert "no registra información" in t.texto and t.texto.endswith("for Leticia, Bolívar Department, Colombia, in the Colombian Amazon.")
    t = M.chunks(_municipality(spark, pais="Brasil", nivel1="Amapá", nivel2="Oiapoque", nivel1_pt="Amapá", nivel2_pt="Oiapoque", grupos=["Comando Vermelho (CV)"], n_grupos=1, investigado=True, poblacion=None)).first()
    assert t.texto.startswith("Oiapoque é um município do estado do Amapá (Amapa), Brasil, com uma extensão de 10 km² na Amazônia brasileira. Según el observatorio Amazon Underworld, en este municipio de la Amazonía brasileña")
    assert "una estructura armada: Comando Vermelho (CV)." in t.texto and t.idiomas == ["pt", "es", "en"]
    t = M.chunks(_municipality(spark, popup_es="- EMBF: Frente Uno", area_km2=None, poblacion=0.0)).first()
    assert "la estructura local Frente Uno (EMBF)." in t.texto and "no fue objeto" in t.texto


def test_dedupe_keeps_lowest_zoom(spark):
    df = spark.createDataFrame([("m", 5, 1, 1, "b"), ("m", 3, 2, 2, "a"), ("n", 4, 0, 0, "a")], "id_municipio string, zoom int, tile_x int, tile_y int, ruta string")
    assert rows(M.deduplicated(df), "id_municipio", "zoom", "fuentes_todas", "n_apariciones") == [("m", 3, ["a", "b"], 2), ("n", 4, ["a"], 1)]


def test_empty_tables(spark):
    f = spark.createDataFrame([], "chunk_id string, doc_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string, cargado_en timestamp")
    assert C.latest(f).count() == 0 and C.contiguity(f).count() == 0 and C.duplicates(f, "chunk_id").count() == 0
    assert [r.n for r in C.lint(f).collect()] == [0] * len(C.LINT)
    assert G.mentions(f).count() == 0


def test_numbered_equals_a_window(spark):
    from pyspark.sql import Window

    from riverloom.operators.ranking import numbered

    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("g"), F.col("id") % 11)).alias("g"), F.xxhash64("id").alias("o"), "id").repartition(5)
    own = numbered(df, "g", ["o"], "n", "t")
    w = Window.partitionBy("g")
    ref = df.withColumn("n", (F.row_number().over(w.orderBy("o")) - 1).cast("bigint")).withColumn("t", F.count(F.lit(1)).over(w))
    assert own.exceptAll(ref).count() == 0 and ref.exceptAll(own).count() == 0
    assert numbered(df.limit(0), "g", ["o"], "n").count() == 0


def test_quality_reports(spark):
    from riverloom.operators import quality as QC

    m = _municipality(spark, nivel2="BogotÃ¡", poblacion=-1.0)
    got = {r.control: r.n for r in QC.municipalities(m, 1, countries=("COLÓMBIA", "Perú")).collect()}
    assert got["mojibake"] == 1 and got["poblacion fuera de rango"] == 1 and got["paises que faltan"] == 1 and got["repetidos"] == 0 and got["numero de municipios"] == 0
    with pytest.raises(ValueError, match="mojibake"):
        QC.enforce(QC.municipalities(m))
    c = M.chunks(_municipality(spark))
    texts = {r.control: r.n for r in QC.map_texts(c).collect()}
    assert not any(n for k, n in texts.items() if k not in ("estructura repetida", "toponimos sin tilde"))
    assert QC.review_sample(c).count() == 1
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    ok = {r.control: r.n for r in QC.index_checks(e, I.merged(e)).collect()}
    assert not any(ok.values())
    assert {r.control: r.n for r in QC.index_checks(e, e.where("vec_id = 1")).collect()}["vectores perdidos"] == 1
    res = spark.createDataFrame([("q001", [(1, "d9")], [(1, "c", "d", "x")])], "query_id string, documents array<struct<rank:bigint,doc_id:string>>, fragments array<struct<rank:bigint,chunk_id:string,doc_id:string,text:string>>")
    base = spark.createDataFrame([("c", "d")], "chunk_id string, doc_id string")
    assert rows(QC.traceability(res, base)) == [("q001", "doc_id", "d9")]


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "index")
    encode(spark.createDataFrame([("a", "uno dos")], "chunk_id string, texto string"), "chunk_id", "texto").selectExpr("id as chunk_id", "v as embedding").write.parquet(path)
    new = spark.createDataFrame([("b", "tres"), ("c", "cuatro")], "chunk_id string, texto string")
    assert [I.append(spark.read.parquet(path), new, path) for _ in range(2)] == ["append", "nothing"]
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        I.append(spark.read.parquet(path), spark.createDataFrame([("a", "x"), ("z", "y")], "chunk_id string, texto string"), path)
    line = spark.createDataFrame([(0, "a")], "linea int, chunk_id string")
    assert I.positional(line, spark.createDataFrame([(0, [1.0])], "linea int, embedding array<double>")).count() == 1
    with pytest.raises(ValueError):
        I.positional(line, line.limit(0))


def test_retrieval_searches_both_spaces(spark, tmp_path):
    """200 of the common space and 100 of the second one reach the pool, with cosines of the common space."""
    from riverloom.plans import retrievals

    rng = np.random.default_rng(3)
    words = [f"palabra{i}" for i in range(300)]
    texts = {f"c{i:03}": " ".join(rng.choice(words, 30)) for i in range(400)}
    question = " ".join(rng.choice(words, 12))
    spark.createDataFrame([(k, "d", "f", t, 1) for k, t in texts.items()], "chunk_id string, doc_id string, fuente string, texto string, cargado_en int").write.parquet(f"{tmp_path}/metadata.parquet")
    spark.createDataFrame([("q001", question)], "query_id string, consulta string").write.parquet(f"{tmp_path}/consultas.parquet")
    spark.createDataFrame([], "query_id string, chunk_id string, score double").write.parquet(f"{tmp_path}/evidencia.parquet")
    want, cosines = {}, {}
    for i, (enc, k) in enumerate(((HashEncoder(), 200), (retrievals.SECOND, 100))):
        score = dict(zip(texts, np.round(enc.encode(list(texts.values())) @ enc.encode([question])[0], 6)))
        cosines = cosines or score
        want |= {c: i for c in sorted(texts, key=lambda c: (-score[c], c))[:k]}
    pool = {r.chunk_id: (r.origen, r.coseno) for r in retrievals.Base(spark, str(tmp_path)).pool().collect()}
    assert len(pool) > 200 and {c: o for c, (o, _) in pool.items()} == want
    assert all(abs(x - cosines[c]) < 2e-6 for c, (_, x) in pool.items())
