"""Map features to municipalities to text fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Flags of a feature and the groups they stand for, in order.
GROUPS = {
    "au_emc": "Estado Mayor Central (disidencias FARC-EP)", "au_embf": "Estado Mayor de Bloques y Frentes (disidencias FARC-EP)", "au_eln": "Ejército de Liberación Nacional (ELN)",
    "au_c_d_f": "Clan del Golfo / Autodefensas Gaitanistas de Colombia (AGC)", "au_seg_marq": "Segunda Marquetalia", "au_cv": "Comando Vermelho (CV)",
    "au_pcc": "Primeiro Comando da Capital (PCC)", "au_choneros": "Los Choneros", "au_lobos": "Los Lobos", "au_others": "Otros grupos armados",
}
# Place names that lack their accents.
CORRECTIONS = {
    "Bolivar": "Bolívar", "Vaupes": "Vaupés", "Caqueta": "Caquetá", "Guainia": "Guainía", "Cordoba": "Córdoba", "Bogota": "Bogotá", "Boyaca": "Boyacá", "Atlantico": "Atlántico",
    "Narino": "Nariño", "Sucumbios": "Sucumbíos", "La Joya De Los Sachas": "La Joya de los Sachas", "Peru": "Perú", "San Martin": "San Martín", "Junin": "Junín", "Huanuco": "Huánuco",
    "Rondonia": "Rondônia", "Para": "Pará", "Maranhao": "Maranhão", "Piaui": "Piauí", "Ceara": "Ceará", "Goias": "Goiás", "Potosi": "Potosí",
}
# How each country is spoken of.
COUNTRY = {
    # country: (in English, region, region in English, division, division in English)
    "Colombia": ("Colombia", "la Amazonía colombiana", "the Colombian Amazon", "del departamento de", "Department"),
    "Brasil": ("Brazil", "la Amazonía brasileña", "the Brazilian Amazon", "del estado de", "State"),
    "Venezuela": ("Venezuela", "la región amazónica venezolana", "the Venezuelan Amazon", "del estado", "State"),
    "Ecuador": ("Ecuador", "la Amazonía ecuatoriana", "the Ecuadorian Amazon", "de la provincia de", "Province"),
    "Perú": ("Peru", "la Amazonía peruana", "the Peruvian Amazon", "del departamento de", "Department"),
    "Bolivia": ("Bolivia", "la Amazonía boliviana", "the Bolivian Amazon", "del departamento de", "Department"),
}
NO_ARTICLE = ("Roraima", "Rondônia", "Rondonia")


def latitude(z: Column, y: Column) -> Column:
    """V7: latitude of a tile's centre."""
    n = F.pow(F.lit(2.0), z)
    return F.round(F.degrees(F.atan(F.sinh(F.lit(3.141592653589793) * (1 - 2 * (y + 0.5) / n)))), 5)


def longitude(z: Column, x: Column) -> Column:
    return F.round((x + 0.5) / F.pow(F.lit(2.0), z) * 360 - 180, 5)


def _get(name: str) -> Column:
    return F.element_at("props", F.lit(name))


def _first(*names: str) -> Column:
    return F.coalesce(*[F.nullif(_get(n), F.lit("")) for n in names])


def municipalities(features: DataFrame) -> DataFrame:
    """(ruta, zoom, tile_x, tile_y, capa, tipo, props) -> typed columns; features without an id are borders and dropped."""
    groups = F.filter(F.array(*[F.when(T.truthy(_get(k)), F.lit(v)) for k, v in GROUPS.items()]), lambda x: x.isNotNull())
    return features.where(_first("au_ID_concatenated").isNotNull()).select(
        T.clean(_get("au_ID_concatenated")).alias("id_municipio"), T.clean(_get("au_country")).alias("pais"),
        T.clean(_first("au_level1", "b_ADM1_ES")).alias("nivel1"), T.clean(_first("au_level2", "b_ADM2_ES")).alias("nivel2"),
        T.clean(_get("b_ADM1_PT")).alias("nivel1_pt"), T.clean(_get("b_ADM2_PT")).alias("nivel2_pt"), _get("b_ADM1_PCODE").alias("pcode_adm1"), _get("b_ADM2_PCODE").alias("pcode_adm2"),
        _get("au_population").try_cast("double").alias("poblacion"), _get("au_area km").try_cast("double").alias("area_km2"), groups.alias("grupos"), F.size(groups).alias("n_grupos"),
        T.truthy(_get("au_no_info")).alias("sin_informacion"), T.truthy(_get("au_invest. with presence")).alias("investigado"),
        T.clean(_get("au_popup_window_es"), True).alias("popup_es"), T.clean(_get("au_popup_window_en"), True).alias("popup_en"), T.clean(_get("au_popup_window_pt"), True).alias("popup_pt"),
        F.col("tipo").alias("geometria"), "zoom", "tile_x", "tile_y", "capa", "ruta",
        latitude(F.col("zoom"), F.col("tile_y")).alias("lat_tesela"), longitude(F.col("zoom"), F.col("tile_x")).alias("lon_tesela"),
    )


def deduplicated(rows: DataFrame, source: str = "ruta") -> DataFrame:
    """One row a municipality, that of the lowest zoom, with all its sources. Combined before the shuffle."""
    rest = [c for c in rows.columns if c != "id_municipio"]
    first = F.min_by(F.struct(*rest), F.struct("zoom", "tile_x", "tile_y", source))
    g = rows.groupBy("id_municipio").agg(first.alias("r"), F.array_sort(F.collect_set(source)).alias("fuentes_todas"), F.count(F.lit(1)).alias("n_apariciones"))
    return g.select("id_municipio", *[F.col(f"r.{c}").alias(c) for c in rest], "fuentes_todas", "n_apariciones")


def tile_identity(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """Document and source of a tile from the inventory (clave, doc_id, fuente), else from its path, else dropped."""
    key = F.concat_ws("/", "zoom", "tile_x", T.basename(F.col("ruta")))
    r = rows.withColumn("clave", key).join(inventory.groupBy("clave").agg(F.max_by("doc_id", "fuente").alias("doc_id"), F.max("fuente").alias("fuente")), "clave", "left")
    parsed = F.regexp_extract("ruta", r"(\d+)/(\d+)/[^/]*?(\d+)[^/]*$", 0)
    made = F.when(parsed != "", F.concat(F.lit("tesela_"), F.regexp_replace(F.regexp_replace(parsed, r"\.[^.]*$", ""), "/", "_")))
    return r.withColumns({"doc_id": F.coalesce("doc_id", made), "fuente": F.coalesce("fuente", F.col("ruta"))}).where("doc_id is not null")


def _lookup(c: Column, i: int, default: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in COUNTRY.items():
        out = F.when(c == k, F.lit(v[i])).otherwise(out)
    return F.coalesce(out, default)


def corrected(c: Column) -> Column:
    """The known corrections."""
    t = T.missing(F.trim(c))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in CORRECTIONS.items() for x in kv]), t), t)


def with_variant(c: Column) -> Column:
    """``Bolívar (Bolivar)`` where the accents make a difference."""
    t = corrected(c)
    plain = T.without_accents(t)
    return F.when(t != plain, F.concat(t, F.lit(" ("), plain, F.lit(")"))).otherwise(t)


# The wording of the texts that are made of municipalities; {} takes a value.
SAY = {
    "es_pt": "{} é um município do estado {} {}, Brasil", "es_pt_variante": "{} é um município do estado {} {}, Brasil — en español, {}, {} {} —", "es": "{} es un municipio {} {}, {}",
    "poblacion": "una población de {} habitantes", "area": "una extensión de {} km²", "poblacion_pt": "uma população de {} habitantes", "area_pt": "uma extensão de {} km²",
    "cifras": ", con {} en {}.", "sin_cifras": ", en {}.", "cifras_pt": ", com {} na Amazônia brasileira.", "sin_cifras_pt": ", na Amazônia brasileira.",
    "segun": "Según el observatorio Amazon Underworld, {} se documenta la presencia de ", "aqui_pt": "en este municipio de {}", "aqui": "en este municipio", "territorio": "en este territorio",
    "una": "una estructura armada", "dos": "dos estructuras armadas", "tres": "tres estructuras armadas", "varias": "{} estructuras armadas",
    "local": "la estructura local", "locales": "las estructuras locales", "tambien": "También se identifica la estructura local", "tambien_varias": "También se identifican las estructuras locales",
    "nada": "El observatorio Amazon Underworld no registra información verificada sobre presencia de grupos armados {}. La ausencia de registro no equivale a ausencia de actividad: refleja los límites de cobertura del observatorio.",
    "terreno": "El municipio fue objeto de investigación directa en terreno por parte del observatorio.", "sin_terreno": "El municipio no fue objeto de investigación directa en terreno.",
    "en_nada": "No verified information on armed group presence is available for {}, in {}.", "en": "Armed group presence in {}, in {}, is documented by the Amazon Underworld observatory.",
}


def group_lists(row_groups: Column, popup: Column) -> tuple[Column, Column]:
    """Groups by flag without the general label where the pop-up names groups, and names that only the pop-up has."""
    named = T.popup_names(popup)
    groups = F.when(F.size(named) > 0, F.filter(row_groups, lambda g: g != GROUPS["au_others"])).otherwise(row_groups)
    known = F.transform(groups, T.core)
    return groups, F.filter(named, lambda x: ~F.array_contains(known, F.trim(T.core(x))) & ~F.exists(known, lambda k: F.trim(k) == F.trim(T.core(x))))


def municipality_text(rows: DataFrame, portuguese: bool = True, english: bool = True) -> DataFrame:
    """Adds ``texto``: opening with figures, groups, local structures, field work, an English anchor."""
    pais = F.coalesce(corrected(F.col("pais")), F.lit("país no identificado"))
    muni, depto = with_variant(F.col("nivel2")), with_variant(F.col("nivel1"))
    muni1, depto1 = corrected(F.col("nivel2")), corrected(F.col("nivel1"))
    muni_pt, depto_pt = corrected(F.col("nivel2_pt")), corrected(F.col("nivel1_pt"))
    region = _lookup(pais, 1, F.lit("la cuenca amazónica"))
    division = _lookup(pais, 3, F.lit("del departamento de"))
    pt = F.coalesce(F.lit(portuguese) & (pais == "Brasil") & muni_pt.isNotNull() & depto_pt.isNotNull(), F.lit(False))
    prep = F.when(depto_pt.isin(*NO_ARTICLE), "de").otherwise("do")
    same = (muni_pt == muni1) & (depto_pt == depto1)

    def say(template: str, *parts: Column) -> Column:
        pieces = template.split("{}")
        out = [F.lit(pieces[0])]
        for p, lit in zip(parts, pieces[1:]):
            out += [F.coalesce(p, F.lit("")), F.lit(lit)]
        return F.concat(*out)

    opening = F.when(
        pt,
        F.when(same, say(SAY["es_pt"], muni, prep, depto)).otherwise(
            say(SAY["es_pt_variante"], muni_pt, prep, depto_pt, muni, division, depto)
        ),
    ).otherwise(say(SAY["es"], muni, division, depto, pais))
    people, area = T.thousands(F.nullif(F.col("poblacion"), F.lit(0.0))), T.thousands(F.bround("area_km2"))
    present = lambda a: F.filter(a, lambda x: x.isNotNull())
    es = present(F.array(F.when(people.isNotNull(), say(SAY["poblacion"], people)), F.when(area.isNotNull(), say(SAY["area"], area))))
    br = present(F.array(F.when(people.isNotNull(), say(SAY["poblacion_pt"], people)), F.when(area.isNotNull(), say(SAY["area_pt"], area))))
    tail = F.when(pt, F.when(F.size(br) > 0, say(SAY["cifras_pt"], T.enumerated(br, "e"))).otherwise(F.lit(SAY["sin_cifras_pt"]))).otherwise(
        F.when(F.size(es) > 0, say(SAY["cifras"], T.enumerated(es), region)).otherwise(say(SAY["sin_cifras"], region))
    )
    groups, local = group_lists(F.col("grupos"), F.col("popup_es"))
    n, k = F.size(groups), F.size(local)
    where = F.when(pt, say(SAY["aqui_pt"], region)).otherwise(F.lit(SAY["territorio"]))
    amount = F.when(n == 1, SAY["una"]).when(n == 2, SAY["dos"]).when(n == 3, SAY["tres"]).otherwise(say(SAY["varias"], n.cast("string")))
    according = say(SAY["segun"], where)
    armed = F.when(n > 0, F.concat(according, amount, F.lit(": "), T.enumerated(groups), F.lit(".")))
    lead = F.when(n > 0, F.when(k == 1, SAY["tambien"]).otherwise(SAY["tambien_varias"])).otherwise(
        F.concat(according, F.when(k == 1, SAY["local"]).otherwise(SAY["locales"]))
    )
    locals_ = F.when(k > 0, F.concat(lead, F.lit(" "), T.enumerated(local), F.lit(".")))
    here = F.when(pt, say(SAY["aqui_pt"], region)).otherwise(F.lit(SAY["aqui"]))
    none = (n == 0) & (k == 0)
    nothing = F.when(
        none,
        say(
            SAY["nada"],
            here,
        ),
    )
    field = F.when(F.col("investigado"), SAY["terreno"]).when(
        ~none, SAY["sin_terreno"]
    )
    place = say("{}, {} {}, {}", muni1, depto1, _lookup(pais, 4, F.lit("Department")), _lookup(pais, 0, pais))
    region_en = _lookup(pais, 2, F.lit("the Amazon basin"))
    anchor = F.when(none, say(SAY["en_nada"], place, region_en)).otherwise(
        say(SAY["en"], place, region_en)
    )
    parts = [F.concat(opening, tail), armed, locals_, nothing, field] + ([anchor] if english else [])
    return rows.withColumn("texto", F.concat_ws(" ", *parts))


def chunks(rows: DataFrame) -> DataFrame:
    """Fragments of municipalities with ids that are unique in their tile."""
    w = Window.partitionBy("zoom", "tile_x", "tile_y").orderBy("id_municipio")
    t = municipality_text(rows).withColumn("posicion", F.row_number().over(w) - 1)
    languages = F.when(F.col("pais") == "Brasil", F.array(F.lit("pt"), F.lit("es"), F.lit("en"))).otherwise(F.array(F.lit("es"), F.lit("en")))
    n = F.size(T.words(F.col("texto")))
    return t.select(
        "doc_id", F.concat_ws("_", "doc_id", F.lit("chunk"), "posicion").alias("chunk_id"), "fuente", F.lit("pbf").alias("formato"), F.lit(3).alias("fenomeno"), "posicion", n.alias("num_tokens"),
        "texto", "id_municipio", "pais", "nivel1", "nivel2", "n_grupos", languages.alias("idiomas"), "zoom", n.alias("n_palabras"),
    )
