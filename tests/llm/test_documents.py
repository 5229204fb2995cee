"""Problems 8 and 9 on small fixtures."""

import random

from riverloom.llm import leaks, sentences

ITEM = "El barco Vega Repuru zarpó de Vega Bicoquil en 2002 con 86.372 cajas rumbo a Morezón y volvió 63 días más tarde. Cuando Tudután cerró el paso de Fasoyal quedaron 75 lanchas varadas y 332.179 litros de diésel junto a Río Quigerá. Según el texto anterior, ¿cuál de las siguientes afirmaciones es la más adecuada para el caso?"
ZH = "在鲁桑图莫哨所发现了34,628件刻有贝维莱里字样的零件和92张索桑纳维地图。工程师纳克伊伊为里菲贝莫设计了高46米的天线，但塔维纳加以42票否决。根据上文，下列哪一项说法最为恰当？"
PROSE = "La oficina revisó los datos del puerto. El comité cuestionó el plan y documentó el cierre de la frontera."


def test_leaks(spark):
    w = ITEM.split()
    altered = [*w[:19]]
    altered[7] = "casi"
    far = [*w[:20]]
    far[3], far[9], far[15] = "otro", "casi", "tal"
    docs = {
        1: f"{PROSE} {ITEM} {PROSE}", 2: f"{PROSE}\n{' '.join(w[:16]).upper()}\n{PROSE}", 3: f"{PROSE} {' '.join(altered)} {PROSE}", 4: f"{PROSE} {' '.join(w[:9])} {PROSE}", 5: PROSE, 6: None, 7: "",
        8: f"{PROSE} Según el texto anterior, ¿cuál de las siguientes afirmaciones es la más adecuada para el caso?", 9: f"{PROSE} {' '.join(far)} {PROSE}",
        10: f"区域背景。{ZH.split('。')[1]}。没有人回应！", 11: "工程师设计了天线。没有人回应！", 12: f"{PROSE} " + "x y z " * 3000 + " ".join(w[:20]).replace("ó", "o"),
    }
    d = spark.createDataFrame([(k, v, "a") for k, v in docs.items()] + [(1, docs[1], "b")], "doc_id bigint, text string, item_id string").repartition(3)
    e = spark.createDataFrame([(100, ITEM, "75"), (101, ZH, None), (102, None, None), (103, "", None)], "item_id bigint, text string, respuesta string")
    assert sorted(tuple(r) for r in leaks.found(d.drop("item_id"), e).collect()) == [(1, 100), (2, 100), (3, 100), (10, 101), (12, 100)]
    r = {x.doc_id: x for x in leaks.leak_report(d, e).collect()}
    assert r[1].respuesta and r[3].cambiadas == 1 and r[1].coseno > 0.9
    assert [x.items for x in leaks.leaked_documents(d, e).where("doc_id = 1").collect()] == [[100]]
    assert leaks.found(d.limit(0), e).count() == 0 and leaks.found(d, e.limit(0)).count() == 0


def test_alignment_equals_brute_force():
    rng = random.Random(5)
    item = leaks.Item(1, " ".join("w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(40)) + ". Pregunta final?", None)
    body = item.words
    for _ in range(300):
        a = rng.randrange(20)
        piece = body[a : a + rng.randint(5, 20)]
        for _ in range(rng.randint(0, 3)):
            piece[rng.randrange(len(piece))] = "otra"
        doc = ["x"] * rng.randint(0, 6) + piece + ["y"] * rng.randint(0, 6)
        brute = False
        for p in range(len(piece)):
            for q in range(p + leaks.LEAST, len(piece) + 1):
                diff = sum(piece[k] != body[a + k] for k in range(p, q))
                brute |= diff * leaks.CHANGED <= q - p and piece[p] == body[a + p] and piece[q - 1] == body[a + q - 1]
        assert bool(leaks.leaked(item, doc)) == brute


def test_alignment_with_repeated_words_equals_brute_force():
    """Function words that recur within the passage, words changed, left out and put in."""
    words = [*"abcdefg", "de", "hh", "ii", "de", *"klmn"]
    item = leaks.Item(1, " ".join(words), None)
    assert leaks.leaked(item, [*words[:7], "con", *words[8:]]) == (15, 1)

    def brute(body: list[str], doc: list[str]) -> tuple[int, int] | None:
        """Edit distance of each part of the passage, both ends kept, to any part of the document."""
        best = None
        for x0 in range(len(body)):
            row = [0] * (len(doc) + 1)
            for x1 in range(x0 + 1, len(body) + 1):
                w, before = body[x1 - 1], row
                row = [x1 - x0]
                for j, v in enumerate(doc):
                    row.append(min(before[j] + (v != w), before[j + 1] + 1, row[j] + 1))
                size, c = x1 - x0, min(row)
                if size >= leaks.LEAST and c * leaks.CHANGED <= size:
                    ends = min((before[j] for j, v in enumerate(doc) if v == w), default=99)
                    if ends == c and body[x0] in doc:
                        best = max(best or (0, 0), (size, -c))
        return (best[0], -best[1]) if best else None

    rng = random.Random(7)
    hits = 0
    for _ in range(400):
        body = [rng.choice(["de", "la", "y", *(f"w{chr(97 + k)}" for k in range(20))]) for _ in range(rng.randint(15, 34))]
        item = leaks.Item(1, "x", None)
        item.words, item.places = body, {}
        for i, w in enumerate(body):
            item.places.setdefault(w, []).append(i)
        doc = list(body)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(doc))
            doc[k : k + rng.randint(0, 1)] = [rng.choice(["de", "la", "otra"])][: rng.randint(0, 1)]
        doc = ["x1"] * rng.randint(0, 4) + doc + ["de", "y1"] * rng.randint(0, 3)
        got, want = leaks.leaked(item, doc), brute(body, doc)
        assert bool(got) == bool(want) and (not got or got[1] * leaks.CHANGED <= got[0] and got[0] <= want[0])
        hits += bool(got)
    assert 50 < hits < 400


def test_alignment_in_solid_scripts():
    """A changed character in the middle of a unit of ten leaves runs of five at most."""
    unit = "甲乙丙丁戊己庚辛壬癸"
    item = leaks.Item(1, unit + "。下列哪一项说法最为恰当？", None)
    assert item.solid and item.bounds[0] == (0, 10)
    assert leaks.leaked(item, list("区域" + unit[:4] + "子" + unit[5:] + "背景")) == (10, 1)


CASES = [
    ["El Dr. Pérez visitó la Av. Central con 20 hombres.", "La tasa pasó de 31,4 a 10,7 por ciento."], ["—¿Hubo aviso previo? —preguntó el delegado de Quito.", "«No hay garantías», dijo la vocera."],
    ["La patrulla llegó a las 2 p. m.", "El equipo dudó… pero al final aceptó."], ["We had no time, e.g. for the U.S. and others.", "What now?!", "(See annex 4.)"], ["Am 10. Mai 2014 kam Dr. Weiß.", "„Es gibt keine Gewähr“, sagte sie."],
    ["В 2003 г. совет отметил нехватку.", "Никто не ответил!"], ["“没有任何保证。”发言人说。", "“为什么？”代表问道，“没有人通知我们。”", "没有人回应！"], ["「保証はありません。」と広報担当は述べた。", "本当なのか！？"],
    ["لم يجب أحد!", "قال د. سالم إن العمل بدأ."], ["डॉ. शर्मा ने दौरा किया।", "किसी ने जवाब नहीं दिया!"],
]


def test_units():
    t = sentences.fitted()
    for parts in CASES:
        text = ("" if parts[0][0] > "⹿" or parts[0][0] in "“「" and parts[0][1] > "⹿" else " ").join(parts)
        assert [text[a:b] for a, b in t.units(text)] == parts
    text = "Contexto regional\n\nLa oficina revisó los datos del puerto y de la\nciudad de Lima. Sin cierre final"
    assert [text[a:b] for a, b in t.units(text)] == ["Contexto regional", "La oficina revisó los datos del puerto y de la\nciudad de Lima.", "Sin cierre final"]
    assert t.units("") == [] and t.units(" \n ") == []


def test_held_out_boundaries():
    """Texts put together with another seed: at least 98 of 100 ends, and as few false ones."""
    t = sentences.fitted()
    hit = extra = missed = 0
    for text, gold in sentences.training(300, seed=77):
        own = {b for _, b in t.units(text)}
        want = {len(text[:e].rstrip()) for e in gold}
        hit, extra, missed = hit + len(own & want), extra + len(own - want), missed + len(want - own)
    assert hit / (hit + missed) > 0.98 and hit / (hit + extra) > 0.98


def test_unit_rows(spark):
    rows = [(1, "Uno. Dos."), (1, "Uno. Dos."), (2, None), (3, "  "), (4, "Palabra " * 20000 + "fin.")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, inicio int")
    got = sorted(tuple(r) for r in sentences.sentence_units(df).collect())
    assert got == [(1, 0, 4), (1, 5, 9), (4, 0, 160004)]
    assert sentences.sentence_units(df.limit(0)).count() == 0
