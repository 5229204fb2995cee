import math
import random

import pytest
from pyspark.sql import functions as F

from riverloom.functions import text as T
from riverloom.functions import windows as W
from riverloom.operators import maps as M


def one(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (T.normalized, "Población km² (área)", "población km² área"),
        (T.without_articles, "el la Coronavirus", "Coronavirus"),
        (T.without_articles, "la los", "la los"),
        (T.relation, "El grupo Opera y ataca", "opera"),
        (T.relation, "nada", "relacionado_con"),
        (T.unmangled, "BogotÃ¡", "Bogotá"),
        (T.unmangled, "BogotÃ¡ —", "BogotÃ¡ —"),
        (T.thousands, "1234567", "1.234.567"),
        (T.thousands, "x", None),
        (T.truthy, "VERDADEIRO", True),
        (T.truthy, "sim", True),
        (T.truthy, " 1 ", True),
        (T.truthy, None, False),
        (T.truthy, "NO", False),
        (T.without_accents, "Ñandú Ação Übung", "Nandu Acao Ubung"),
        (M.with_variant, "Bolivar", "Bolívar (Bolivar)"),
        (T.phenomenon, "F3", 3),
        (T.phenomenon, "x", None),
        (T.extension, "a/b.c/d.PDF", "pdf"),
        (T.basename, "a\\b/c.txt", "c.txt"),
        (T.signature, "El Río Ancho crece", "X X X crece"),
        (T.declared_groups, "presencia de dos estructuras armadas", 2),
        (T.declared_groups, "presencia de la estructura local", 1),
        (T.declared_groups, "nada", None),
        (T.core, "Clan del Golfo (AGC)", "clan del golfo "),
        (T.missing, " NaN ", None),
        (T.entity, "  Gran   Río ", "gran río"),
        (T.clean, "a\u0007b   c", "ab c"),
    ],
)
def test_scalar(spark, f, value, expected):
    assert one(spark, f, value) == expected


def test_lists(spark):
    assert one(spark, T.popup_names, "- EMBF: Frente Rodrigo Cadete\n- Los Lobos\n- los lobos") == ["Frente Rodrigo Cadete (EMBF)", "Los Lobos"]
    assert one(spark, T.as_list, '["a", " ", "b"]') == ["a", "b"]
    assert one(spark, T.as_list, "nan") == []
    assert one(spark, T.as_list, "x") == ["x"]
    for items, expected in ((["a"], "a"), (["a", "b"], "a y b"), (["a", "b", "c"], "a, b y c"), ([], "")):
        assert one(spark, T.enumerated, items, "array<string>") == expected


def test_phrase(spark):
    rows = [("novel coronavirus", "el coronavirus", False), ("el coronavirus llegó", "el coronavirus", True), ("x", "", False), ("a.b", "a.b", True), ("acb", "a.b", False)]
    got = spark.createDataFrame(rows, "t string, p string, e boolean").select("e", T.contains_phrase(F.col("t"), F.col("p")).alias("g")).collect()
    assert all(r.e == r.g for r in got)


QUOTED = "Dijo “hola.” Luego el Dr. Pérez vino. ¿Qué? (Sí.) Fin"


def test_sentences(spark):
    expected = ["Dijo “hola.", "Luego el Dr. Pérez vino.", "¿Qué?", "(Sí.", "Fin"]
    assert one(spark, T.sentences, QUOTED) == expected == W.sentences(QUOTED)
    assert one(spark, T.sentences, "  ") == [""]


def _brute_windows(counts, most):
    """The nested-loop definition of greedy windows with an overlap of one sentence, over word counts."""
    out, cur, i = [], [], 0
    while i < len(counts):
        n = counts[i]
        if cur and sum(counts[j] for j in cur) + n > most:
            out.append(list(cur))
            if len(cur) >= 2:
                cur = [cur[-1]]
                if counts[cur[0]] + n > most:
                    out.append(list(cur))
                    cur = []
            else:
                cur = []
        if n > most:
            out.append([i])
        else:
            cur.append(i)
        i += 1
    if cur:
        out.append(cur)
    return out


def test_windows(spark):
    assert _brute_windows([4, 4, 4, 9], 10) == [[0, 1], [1, 2], [2], [3]]
    rng = random.Random(4)
    cases = [[4, 4, 4, 9], [12, 3]] + [[rng.randint(1, 14) for _ in range(rng.randint(2, 9))] for _ in range(40)]
    texts = [" ".join(" ".join([f"S{i}"] + ["x"] * (n - 2) + (["y."] if n > 1 else [])) + ("" if n > 1 else ".") for i, n in enumerate(c)) for c in cases]
    got = [r.w for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(T.windows(F.col("t"), 10).alias("w")).collect()]
    for c, t, g in zip(cases, texts, got):
        assert g == W.windows(t, 10)
        if sum(c) > 10:
            assert [[int(x[1:].rstrip(".")) for x in w.split() if x[0] == "S"] for w in g] == _brute_windows(c, 10)
            assert all(len(w.split()) <= 10 for w in g)


def test_trimmed(spark):
    cases = ["cola. Esta sí es completa y bastante larga, para que quede. Y otra sin", "Una sola.", "sin nada", "corto. Muy larga pero sin cierre con muchas palabras de sobra aquí", ""]
    for t in cases:
        assert one(spark, T.trimmed, t) == W.trimmed(t)
    assert W.trimmed(cases[0]) == "Esta sí es completa y bastante larga, para que quede."


def test_composed(spark):
    df = spark.createDataFrame([(1, "Bogotá"), (2, "plano"), (3, None)], "i int, t string")
    assert {r.i: r.t for r in T.composed(df, "t").collect()} == {1: "Bogotá", 2: "plano", 3: None}


def test_tile_centre(spark):
    r = spark.range(1).select(M.latitude(F.lit(3.0), F.lit(3.0)).alias("a"), M.longitude(F.lit(3.0), F.lit(3.0)).alias("o")).first()
    assert r.a == 21.94305 and math.isclose(r.o, -22.5)
