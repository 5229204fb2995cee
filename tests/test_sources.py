import gzip
import json

import pytest
from pyspark.sql import functions as F

from riverloom.sources import fragments, graphml, questions, tiles
from riverloom.streaming import landing


def test_lenient_fragments(spark, tmp_path):
    d = tmp_path / "base_a"
    d.mkdir()
    lines = [json.dumps({"doc_id": "d", "chunk_id": "c", "texto": "  un texto largo  ", "fenomeno": 2}), "", "{mal", json.dumps({"text": "otro texto largo", "phenomenon": "F3"}), json.dumps({"text": "corto"})]
    (d / "metadata.jsonl").write_text("\n".join(lines), encoding="utf-8")
    got = sorted(tuple(r) for r in fragments.read_lenient(spark, str(tmp_path)).collect())
    assert got == [("d", "c", "un texto largo", 2, "base_a"), ("unknown", "base_a_chunk_3", "otro texto largo", 3, "base_a")]


def test_strict_and_dialect(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"chunk_id":"c"}\n{mal\n')
    with pytest.raises(Exception):
        fragments.read_strict(spark, str(p)).collect()
    b = spark.createDataFrame([("d", "c", "hola", "F1", "a/b.pdf", 7)], "doc_id string, chunk_id string, text string, phenomenon string, source_path string, word_count int")
    r = fragments.dialect(b).first()
    assert (r.fuente, r.formato, r.fenomeno, r.num_tokens, r.texto) == ("b.pdf", "pdf", 1, 7, "hola")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("q2", 1), ("q1", 2)], "query_id string, n int")
    fragments.write_lines(df, str(tmp_path / "j"), "query_id")
    assert [json.loads(x)["query_id"] for p in (tmp_path / "j").glob("*.json") for x in p.read_text().splitlines()] == ["q1", "q2"]
    target = str(tmp_path / "t")
    fragments.write_staged(df, target)
    with pytest.raises(ValueError):
        fragments.write_staged(df.limit(0), target, lambda r: r.count() > 0)
    assert spark.read.parquet(target).count() == 2
    fragments.write_sample(df, str(tmp_path / "c"), 1)


def test_questions(spark, tmp_path):
    (tmp_path / "q.txt").write_text("Título\nq001\tPrimera parte\n  y resto\nQ002: Segunda\n", encoding="utf-8")
    assert sorted(tuple(r) for r in questions.read_text(spark, str(tmp_path / "q.txt")).collect()) == [("q001", "Primera parte y resto"), ("q002", "Segunda")]
    (tmp_path / "q.jsonl").write_text('{"query_id":"q1","query":"","pregunta":"hola"}\n{"query_id":"q2"}\n')
    assert sorted(tuple(r) for r in questions.read_json(spark, str(tmp_path / "q.jsonl")).collect()) == [("q1", "hola"), ("q2", "")]


def test_graphml_round_trip(spark, tmp_path):
    n = spark.createDataFrame([("a & b", "A & B", "LOC", 1, ["c2", "c1"], ["d"]), ("x", None, None, None, [], [])], "node_id string, texto string, tipo string, fenomeno int, chunk_ids array<string>, doc_ids array<string>")
    e = spark.createDataFrame([("a & b", "x", "opera", ["c1"])], "src string, dst string, relacion string, chunk_ids array<string>")
    p = str(tmp_path / "g")
    graphml.write_graph(n, e, p)
    got = {r.node_id: r for r in graphml.read_nodes(spark, p).collect()}
    assert set(got) == {"a & b", "x"} and got["a & b"].chunk_ids == ["c1", "c2"] and got["a & b"].fenomeno == 1 and got["x"].texto is None
    assert [tuple(r) for r in graphml.read_edges(spark, p).collect()] == [("a & b", "x", "opera", ["c1"])]


def _msg(*parts):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    out = b""
    for k, v in parts:
        out += varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v
    return out


def tile(ident="m1"):
    values = [_msg((1, ident.encode())), _msg((7, 1)), _msg((5, 300))]
    feature = _msg((2, bytes([0, 0, 1, 1, 2, 2])), (3, 3))
    return _msg((3, _msg((1, b"au"), (3, b"au_ID_concatenated"), (3, b"au_eln"), (3, b"au_population"), *[(4, v) for v in values], (2, feature), (15, 2))))


def test_tiles(spark, tmp_path):
    d = tmp_path / "5" / "9"
    d.mkdir(parents=True)
    (d / "12.pbf").write_bytes(gzip.compress(tile()))
    (d / "13.pbf").write_bytes(b"x" * 28)
    (d / "14.pbf").write_bytes(b"\x1f\x8b" + b"y" * 80)
    r = tiles.read_tiles(spark, str(tmp_path)).collect()
    assert len(r) == 1 and (r[0].zoom, r[0].tile_x, r[0].tile_y, r[0].capa, r[0].tipo) == (5, 9, 12, "au", "Polygon")
    assert r[0].props == {"au_ID_concatenated": "m1", "au_eln": "true", "au_population": "300"}


def test_inventory_keys(spark):
    inv = spark.createDataFrame([("D1", "Amazon_Underworld", "raíz\\5\\9", "12_a.pbf"), ("D2", "otro", "5/9", "1.pbf"), ("D3", "Amazon_Underworld", "5/9", "x.pdf")], "DOC_ID string, Observatorio string, Carpeta string, `Nombre estandarizado` string")
    assert [tuple(r) for r in tiles.inventory_keys(inv).collect()] == [("5/9/12_a.pbf", "5/9/12", "D1", "raíz/5/9/12_a.pbf")]


def test_landing_stream_is_idempotent(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.jsonl").write_text('{"chunk_id":"a","texto":"x"}\n{"chunk_id":"b","texto":"y"}\n')
    for k in (1, 2):
        landing.land(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        (src / "2.jsonl").write_text('{"chunk_id":"b","texto":"z"}\n{"chunk_id":"c","texto":"w"}\n')
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("chunk_id").select("chunk_id", F.col("texto")).collect()
    assert [tuple(r) for r in got] == [("a", "x"), ("b", "y"), ("c", "w")]
