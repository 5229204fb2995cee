"""Problems 1 to 5 on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from riverloom.llm import encoding, language, quality, residue, scans

ES = ["La oficina revisó los datos del puerto.", "El comité cuestionó el plan de la ciudad y documentó el cierre.", "La red de periodistas describió la falta de personal en el río."]
EN = ["The office reviewed the data of the harbour.", "The committee questioned the plan of the city and recorded the closure.", "A network of reporters described the lack of staff on the river."]
FR = ["La mairie a vérifié les données du port.", "Le comité a contesté le plan de la ville et a décrit la fermeture.", "Le réseau de journalistes a décrit le manque de personnel sur le fleuve."]
PT = ["A prefeitura revisou os dados do porto.", "O comitê questionou o plano da cidade e registrou o fechamento.", "A rede de jornalistas descreveu a falta de pessoal no rio."]
DE = ["Die Verwaltung prüfte die Daten des Hafens.", "Der Ausschuss kritisierte den Plan der Stadt und beschrieb die Schließung.", "Das Netz der Reporter beschrieb den Mangel an Personal am Fluss."]
META = "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string, observatorio string, idioma string, pagina_inicio int, clase string"


def frame(spark, rows, **defaults):
    base = {"doc_id": "d", "fuente": "Nota_de_campo_Villa_Alta_2010_1.pdf", "formato": "html", "fenomeno": 1, "posicion": 0, "num_tokens": 9, "observatorio": "taller_de_datos", "idioma": "es", "pagina_inicio": None, "clase": "x"} | defaults
    cols = [c.split()[0] for c in META.split(", ")]
    return spark.createDataFrame([tuple((base | r)[c] for c in cols) for r in rows], META)


def corpus(n=120):
    rng = random.Random(1)
    out = []
    for i in range(n):
        pool, code = [(ES, "es"), (EN, "en"), (FR, "fr"), (PT, "pt"), (DE, "de")][i % 5]
        out.append({"chunk_id": f"k{i}", "texto": " ".join(rng.choices(pool, k=4)), "idioma": code})
    return out


def test_labels():
    for s, k in {" ES": "es", "español": "es", "es-CO": "es", "en_GB": "en", "Português": "pt", "fra": "fr", "Deutsch": "de", "und": None, "??": None, "": None, None: None, "xx": None}.items():
        assert language.label(s) == k


def test_languages(spark):
    extra = [
        {"chunk_id": "mixed", "texto": " ".join(ES + EN[:1]), "idioma": "es"}, {"chunk_id": "wrong", "texto": " ".join(FR), "idioma": "de"}, {"chunk_id": "none", "texto": " ".join(PT), "idioma": None},
        {"chunk_id": "right", "texto": " ".join(DE), "idioma": "Deutsch"}, {"chunk_id": "quote", "texto": " ".join(ES) + " El lema era “open data”.", "idioma": "es"},
        {"chunk_id": "null", "texto": None, "idioma": None}, {"chunk_id": "blank", "texto": " \n", "idioma": None}, {"chunk_id": "table", "texto": "| a | 2001 | 1.234 | 5,6 |\n| b | 2002 | 3.456 | 7,8 |", "idioma": None},
        {"chunk_id": "wrong", "texto": " ".join(FR), "idioma": "de"},
    ]
    df = frame(spark, corpus() + extra)
    got = sorted((r.chunk_id, r.idioma) for r in language.found(df).where(~F.col("chunk_id").rlike("^k")).collect())
    assert got == [("mixed", "en"), ("mixed", "es"), ("none", "pt"), ("wrong", "fr")]
    assert language.found(df).where(F.col("chunk_id").rlike("^k")).count() == 0
    full = {r.chunk_id: r for r in language.languages(df).collect()}
    assert [(t.idioma) for t in full["mixed"].tramos] == ["es", "en"] and full["null"].idioma is None and full["table"].excluido and full["right"].confianza > 0.9
    assert language.found(df.limit(0)).count() == 0


def test_spans_and_unknown_languages():
    model = language.LanguageModel([r["texto"] for r in corpus(300)])
    text = "La oficina revisó los datos del puerto and the committee questioned the plan of the city and recorded the closure y el comité cuestionó el plan de la ciudad."
    r = language.analyse([text], model, True)[0]
    assert [x[0] for x in r["segments"]] == ["es", "en", "es"] and all(0.5 < x[3] <= 1 for x in r["segments"])
    _, a, b, _ = r["segments"][1]
    assert text[a:b].startswith("and the committee") and text[a:b].endswith("closure")
    foreign = ["Il sindaco ha promesso di riparare questa strada prima della primavera.", "Belediye başkanı yolu bahardan önce onaracağına söz verdi.", "De burgemeester beloofde deze weg vóór het voorjaar te herstellen.", "Burmistrz obiecał naprawić drogę przed wiosną."]
    assert [x["main"] for x in language.analyse(foreign, model, True)] == ["und"] * 4
    assert language.analyse(["", " 12 "], model, True)[0]["main"] is None


def test_held_out_language_accuracy():
    train = [r["texto"] for r in corpus(300)]
    model = language.LanguageModel(train)
    held = {"es": "En esta región los pescadores no tienen agua limpia desde hace años.", "en": "People in this area have not had clean water for years.", "pt": "As pessoas desta região não têm água limpa há muitos anos.", "fr": "Les habitants de cette région n’ont pas d’eau propre depuis des années.", "de": "Die Menschen in dieser Gegend haben seit Jahren kein sauberes Wasser."}
    assert [r["main"] for r in language.analyse(list(held.values()), model)] == list(held)
    assert [r["main"] for r in language.analyse(["Никто не ответил на вопрос.", "没有人回应这个问题。", ""], model)] == ["ru", "zh", None]


RESIDUE = [
    "Error 404. La página solicitada no existe o fue movida.", "El enlace no se pudo cargar.", "Este mapa no funciona sin scripts activos.", "[Insertar aquí el resumen ejecutivo]", "Lorem ipsum dolor sit amet, consectetur adipiscing elit.",
    "Informe de {{resumen}} correspondiente a {{ fuente }}.", "La oficina revisó %nombre% del puerto y la comisión confirmó ${autor} de la ciudad.", "El municipio de null reportó null eventos hasta null.", "THE PAGE WAS NOT FOUND.",
]
PROSE = [
    "El portal mostró un error 404 durante la jornada, y la oficina publicó los datos al día siguiente.", "El diseñador recordó que el clásico lorem ipsum no significa nada.", "El conjunto {a, b, c} agrupa los sensores.",
    "El instructivo pedía cambiar «[nombre]» por el de cada vereda.", "La oficina revisó los datos del puerto.",
]


def test_residue(spark):
    rows = [{"chunk_id": f"r{i}", "texto": f"{ES[0]} {t}"} for i, t in enumerate(RESIDUE)] + [{"chunk_id": f"p{i}", "texto": t} for i, t in enumerate(PROSE)]
    df = frame(spark, corpus(900) + rows + rows[:1] + [{"chunk_id": "n", "texto": None}, {"chunk_id": "e", "texto": ""}])
    got = sorted(r.chunk_id for r in residue.found(df).collect())
    assert got == [f"r{i}" for i in range(len(RESIDUE))]
    kept = residue.keep(df)
    assert kept.count() == df.count() - len(RESIDUE) - 1 and kept.columns[-1] == "clase"
    assert residue.found(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (" ".join(ES), "prosa"), (" ".join(DE), "prosa"), ("- mapa\n- radio\n- motor, bomba\n- sensor (3)", "lista"), ("1. mapa\n2. radio\n3. motor", "lista"), ("Contexto ........ 3\nHallazgos ........ 7\nAnexos ........ 9", "lista"),
        ("Ruiz, A. (2001). Contexto regional. Vol. 3, pp. 1-9.\nLima, B. (2003). Bilan. Vol. 8, pp. 3-4.", "lista"), ("Ana Ruiz · Beto Lima · Caro Paz · Dora Gil · Eva Sol · Fito Roa", "lista"),
        ("| a | 2001 | 1.234 |\n| b | 2002 | 3.456 |", "tabla"), ("a;2001;1.234;5,6\nb;2002;3.456;7,8", "tabla"), ("municipio: Alto  casos: 12  tasa: 3,4\nmunicipio: Bajo  casos: 15  tasa: 1,2", "tabla"),
        ("Alto 2001 1.234 5,6 Bajo 2002 3.456 7,8 Caro 2003 8.765 n/d", "tabla"), ("asdfasdf qweqwe zxczxc jkljkl asdf qwe", "basura"), ("(cid:12) (cid:99) (cid:4) (cid:81)", "basura"), ("jajajajajajajajajajaja", "basura"),
        ("8d 4f 00 a1 bb c2 9e 10 44 d3", "basura"), ("¶†#=+ □§◊ ~|=<> ‡‡##+== ^^~", "basura"), (" ".join(ES) + "\n- mapa\n- radio", "prosa"), ("", "vacio"), ("aaa bbb ccc ddd eee", "basura"),
    ],
)
def test_kinds(text, kind):
    assert quality.kinds([text], [False])[0][0] == kind


def test_statistics(spark):
    df = frame(spark, corpus(40) + [{"chunk_id": "l", "texto": "- mapa\n- radio\n- motor"}, {"chunk_id": "l", "texto": "- mapa\n- radio\n- motor"}, {"chunk_id": "n", "texto": None}, {"chunk_id": "big", "texto": ES[0] * 3000}])
    r = {x.chunk_id: x for x in quality.text_statistics(df).collect()}
    assert r["l"].vinetas == 1.0 and r["l"].lineas == 3 and r["l"].palabras == 6 and r["n"].clase == "vacio" and r["big"].clase == "prosa"
    assert [tuple(x) for x in quality.found(df).collect()] == [("l", "lista")]


def test_published_rules():
    """Every failed rule is a reason of its own."""
    texts = ["- mapa\n- radio\n- motor", " ".join(ES) * 8, "8 4 5 9 #", "… … … … ab"]
    stats = quality.statistics(texts)
    why = [{w.split()[0] for w in quality.failures(stats, i)} for i in range(4)]
    assert why[0] == {"palabras", "largo_medio", "vinetas", "alfabeticas", "frecuentes", "fin_puntuacion", "lineas_cortas"} - {"largo_medio"} or "vinetas" in why[0]
    assert why[1] == set() and {"signos_palabra", "alfabeticas", "frecuentes", "largo_medio"} <= why[2] and "signos_palabra" in why[3]


def damaged(s, wrong, right="utf-8"):
    return s.encode(right).decode(wrong)


def test_encoding_search():
    s = "El comité académico confirmó la pérdida de bosque ribereño en Quecará y volvió a señalar el tráfico."
    for t in (damaged(s, "cp1252"), damaged(s, "cp437"), damaged(s, "mac_roman"), damaged(s, "cp1251"), damaged(s, "cp850", "latin-1"), damaged(s, "latin-1", "cp850"), damaged(damaged(s, "cp1252"), "cp1252")):
        state, fixed, ops = encoding.analyse(t)
        assert (state, fixed) == ("reparado", s), t
    assert encoding.analyse(s) is None and encoding.analyse("") is None
    assert encoding.analyse("Qu&eacute; pas&oacute; en Bogot&aacute;")[1] == "Qué pasó en Bogotá"
    assert encoding.analyse("El comit? acad?mico confirm? la p?rdida.")[0] == "perdido"
    assert encoding.analyse("El comit� habló")[0] == "perdido"
    for clean in ("¿Qué pasó? ¿Por qué?", "A faixa dizia «NÃO HÁ AMANHû em Lima.", "A faixa dizia «NÃO HÁ AMANHÃ» em Lima.", "Größe und Straße, weiß", "km² y 5 °C — “así”…", "Никто не ответил", "¿Fue ayer?Sí", "tıabaja con†rol"):
        assert encoding.analyse(clean) is None, clean


# Names of twenty-odd Latin-script languages.
NAMES = "Miloš Škoda Čapek Žižka Dvořák Łódź Wałęsa Żółć Søren Bjørn Ødegård Åsa Ærø Erdoğan İstanbul Çelik Şahin Ősz Győr Ștefan Țepeș Đorđević Ćosić Šešelj Jānis Ģirts Ąžuolas Šiauliai Tõnu Þórr Eiður Sæmundur Ciarán Ħamrun Nguyễn Đặng Gašper Župančič Höfði"


def test_sound_text_stays():
    for n in NAMES.split():
        for s in (n, f"La señora {n} llegó a la reunión.", f"Según {n} y Pérez, la región perdió más bosque."):
            assert encoding.analyse(s) is None, s
    for s in ("Why? because he left.", "Was ist das? fragte er.", "Qui vient? demanda-t-il.", "La señora Bjørn Ødegård llegó."):
        assert encoding.analyse(s) is None, s
    assert encoding.analyse("La comit? habló de la regi?n.")[0] == "perdido"


def test_encoding_rows(spark):
    bad = damaged("Según la guía, llegó", "cp1252")
    rows = [{"chunk_id": "t", "texto": bad}, {"chunk_id": "t", "texto": bad}, {"chunk_id": "f", "texto": None, "fuente": damaged("Crónica_del_río_1.pdf", "cp1252")}, {"chunk_id": "q", "texto": "x", "fuente": "Cr?nica_del_r?o.pdf"}, {"chunk_id": "ok", "texto": "Según", "fuente": None}]
    df = frame(spark, rows)
    assert sorted(tuple(r) for r in encoding.found(df).collect()) == [("f", "fuente"), ("q", "fuente"), ("t", "texto")]
    fixed = {r.chunk_id: (r.texto, r.fuente) for r in encoding.restore(df).collect()}
    assert fixed["t"][0] == "Según la guía, llegó" and fixed["f"][1] == "Crónica_del_río_1.pdf" and fixed["ok"] == ("Según", None)
    assert encoding.found(df.limit(0)).count() == 0


def test_scans(spark):
    words = " ".join(ES) + " El comité documentó la captura de un cargamento."
    clean = [{"chunk_id": f"c{i}", "texto": f"{words} {t['texto']} Se pidió un enfoque técnico-jurídico."} for i, t in enumerate(corpus(200))]
    rows = [
        {"chunk_id": "hyphen", "texto": "La oficina revisó los da-\ntos del puerto y el comité\ndocumentó la captura."}, {"chunk_id": "soft", "texto": "La oficina revisó los da¬\ntos del puerto y el comité\ndocumentó la captura."},
        {"chunk_id": "compound", "texto": "Se pidió un enfoque técnico-\njurídico. La oficina revisó\nlos datos del puerto."}, {"chunk_id": "char", "texto": "La oficina revisó los dat0s del pueıto y el cornité d0cumentó la capt|ura del puerto."},
        {"chunk_id": "head", "texto": "La oficina revisó los datos del\nTALLER DE DATOS\npuerto y el comité documentó la\ncaptura de un cargamento."}, {"chunk_id": "page", "texto": "La oficina revisó los datos del\n- 12 -\npuerto y el comité documentó la\ncaptura de un cargamento."},
        {"chunk_id": "both", "texto": "Nota de campo – Villa Alta   14\nLa oficina revisó los datos del puerto\ny el comité documentó la captura."}, {"chunk_id": "plain", "texto": "La oficina revisó los datos del\npuerto y el comité documentó la\ncaptura."},
        {"chunk_id": "numbers", "texto": "La oficina revisó los datos del\npuerto y el comité documentó la captura.\n1.012\n74.519"}, {"chunk_id": "null", "texto": None}, {"chunk_id": "list", "texto": "- mapa\n- radio\n- TALLER DE DATOS\n- 12"},
    ]
    pdf = frame(spark, rows + rows[:1], formato=" PDF")
    df = frame(spark, clean).unionByName(pdf)
    got = sorted(tuple(r) for r in scans.found(df).collect())
    assert got == [("both", "encabezado"), ("both", "pagina"), ("char", "caracter"), ("head", "encabezado"), ("hyphen", "guion"), ("page", "pagina"), ("soft", "guion")]
    text = {r.chunk_id: r.texto for r in scans.repaired(df).collect()}
    assert text["hyphen"].startswith("La oficina revisó los datos del puerto") and "TALLER" not in text["head"] and "12" not in text["page"]
    assert text["char"].startswith("La oficina revisó los datos del puerto y el comité documentó")
    assert scans.found(df.limit(0)).count() == 0


def test_broken_words_beyond_the_known_ones(spark, monkeypatch):
    """What is a broken word or a compound doesn't hang on the frequent words nor on the sample."""
    monkeypatch.setattr(scans, "KNOWN_WORDS", 60)
    rare = ["El informe describe un sobrevuelo zonal.", "Un vuelo cubre el puerto sobre el mar, y otro vuelo llega sobre el mar."]
    clean = [{"chunk_id": f"c{i}", "texto": f"{t['texto']} {rare[1]} Un plan civico de orden militar."} for i, t in enumerate(corpus(200))]
    clean += [{"chunk_id": f"r{i}", "texto": t} for i, t in enumerate([rare[0], "Un acuerdo zivico-molitar firme.", "Un texto contraofensivas nuevo."])]
    rows = [
        {"chunk_id": "broken", "texto": "La oficina revisó los datos sobre-\nvuelo del puerto y el comité\ncuestionó el plan de la ciudad."},
        {"chunk_id": "compound", "texto": "La oficina revisó el plan zivico-\nmolitar de la ciudad y el comité\ncuestionó el plan de la ciudad."},
        {"chunk_id": "own", "texto": "La oficina revisó el plan civico-\nmilitar de la ciudad y el comité\ncuestionó el plan de la ciudad."},
        {"chunk_id": "twice", "texto": "La oficina revisó los datos del plan contra-\nofen-\nsivas de la ciudad, y el comité\ncuestionó el plan de la ciudad."},
    ]
    df = frame(spark, clean).unionByName(frame(spark, rows, formato="pdf"))
    got = sorted((r.chunk_id, r.clase) for r in scans.found(df, 20).collect() if r.clase == "guion")
    assert got == [("broken", "guion"), ("twice", "guion")]
    text = {r.chunk_id: r.texto for r in scans.repaired(df, 20).collect()}
    assert "datos sobrevuelo del" in text["broken"] and "zivico-molitar" in text["compound"] and "civico-militar" in text["own"] and "contraofensivas" in text["twice"]


def test_texts_with_common_words_are_read_by_lines():
    """Tables and lists whose cells are full of function words."""
    table = "tasa de la zona  1.234  5.678\ncasos en el mes  2.345  6.789\nuso de la red  3.456  7.891"
    mixed = "Los datos de la zona y de la red son los que siguen en la lista:\n- mapa de la zona\n" + "y el plan de la oficina para el puerto de la ciudad es el del mes\n" * 3
    assert quality.kinds([table], [False])[0][0] == "tabla"
    assert quality.kinds([mixed], [False])[0][1][0].startswith("prosa ")


def test_wide_headers_are_scored():
    """A header with function words that is the widest line goes through the classifier too."""
    header = "Observatorio de la Cuenca Alta"
    model = scans.LineModel(scans.train_lines([(" ".join(ES), None, None)] * 20), {})
    *_, tests, _ = model._lines(f"La oficina revisó los datos\n{header}\ndel puerto y el comité", None, "observatorio_de_la_cuenca_alta")
    assert 1 in [i for i, _ in tests]


def test_language_fit_counts_every_fragment(spark):
    """No sample: rates of the distributed fit equal those of the fit on all texts at once, however the table is cut."""
    rows = corpus(7000) + [{"chunk_id": f"rare{i}", "texto": f"{EN[0]} The quillowhisk of the river was seen by {w}."} for i, w in enumerate(["alpha", "beta", "gamma"])] + [{"chunk_id": "n", "texto": None}]
    df = frame(spark, rows).select("chunk_id", "texto")
    whole = language.LanguageModel([r["texto"] for r in rows if r["texto"]])
    assert "quillowhisk" in whole.rates["en"] and "beta" in whole.rates["en"]
    for cut in (df.repartition(3), df.repartition(7, "texto")):
        fitted = language.LanguageModel(counted=language.count_words(cut))
        assert fitted.rates == whole.rates and fitted.grams == whole.grams
    none = language.LanguageModel(counted=language.count_words(df.limit(0)))
    assert none.rates == language.LanguageModel([]).rates and not any(none.grams.values())


def test_known_words_dont_hang_on_the_size_of_the_table():
    """A word seen once among very many says nothing, and so counts as unseen."""
    texts = [r["texto"] for r in corpus(300)]
    small, large = language.LanguageModel([*texts, EN[0] + " The zorvath of the river was seen."]), language.LanguageModel([*texts * 150, EN[0] + " The zorvath of the river was seen."])
    assert "zorvath" in small.rates["en"] and "zorvath" not in large.rates["en"] and "river" in large.rates["en"]


def test_tokens_are_those_of_the_pattern():
    rng = random.Random(3)
    texts = ["".join(rng.choice('aBé²ª5_.!…?\n\n \t\x0b\x85"»)]。中ñİ\0😀') for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    words, text, first = language.tokens(texts)
    want = []
    for i, t in enumerate(texts):
        fresh = True
        for w in language.TOKEN.findall(t):
            if w[0].isalpha():
                want.append((w, i, fresh))
            fresh = not w[0].isalpha()
    assert list(zip(words, text.tolist(), first.tolist())) == want


class Lookups(dict):
    """A dict that counts what is looked up."""

    n = 0

    def __getitem__(self, key):
        self.n += 1
        return super().__getitem__(key)


def test_each_distinct_word_is_looked_up_once():
    """Counting and scoring hang on the distinct words of a batch, not on all its words."""
    texts = [*ES, *EN] * 400
    distinct = len({w for t in texts for w in language.TOKEN.findall(t)})
    counts, model = language.WordCounts(), language.LanguageModel(texts)
    counts.ids, model.memo = Lookups(), Lookups()
    counts.add(texts)
    found = language.analyse(texts, model)
    assert counts.ids.n <= 2 * distinct and model.memo.n <= 2 * distinct
    words, n = counts.rows()
    assert n[words.index("office")].tolist() == [0, 400, 0, 0, 0]
    assert [x["main"] for x in found] == ["es"] * 3 + ["en"] * 3 + [x["main"] for x in found[6:]] and found[:6] * 400 == found
    assert language.coded(["", " 12 ", "\n"])[0] == [] and len(language.coded([])[1]) == 0


def test_digits_and_hexadecimal_tokens():
    assert all(quality._digits(chr(c)) == chr(c).isdigit() for c in range(0x110000))
    for text in ("8d 4f 00 a1 z bb c2 9e 10 44", "8d 4f 00 a1 z z c2 9e 10 44", "8d 4f 00 a1 z z z 9e 10 44", "z z z a1 b2"):
        parts = text.split()
        assert quality._mostly_hex(parts) == (sum(bool(quality._HEX.match(t)) for t in parts) >= 0.8 * len(parts))
