"""Queries of the map operators, over features made from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import maps as M
from ..operators import quality as QC
from ..session import load


def tile_centroid(s, d):
    z = (F.col("c_custkey") % 10 + 1).cast("double")
    x, y = F.col("c_custkey") % 7, F.col("c_nationkey") % 2
    c = load(s, d, "customer")
    return c.select("c_custkey", M.latitude(z, y.cast("double")).alias("lat"), M.longitude(z, x.cast("double")).alias("lon"))


def municipality_dedup(s, d):
    o = load(s, d, "orders").select(
        F.col("o_custkey").alias("id_municipio"), (F.col("o_orderkey") % 5).alias("zoom"), (F.col("o_orderkey") % 11).alias("tile_x"), (F.col("o_orderkey") % 13).alias("tile_y"),
        F.concat_ws("/", "o_orderpriority", "o_orderkey").alias("ruta"), F.col("o_orderpriority").alias("capa"),
    )
    r = M.deduplicated(o)
    return r.select("id_municipio", "zoom", "tile_x", "tile_y", "capa", "n_apariciones", F.array_join("fuentes_todas", "|").alias("fuentes"))


def _features(s, d):
    """Features with properties from the suppliers: one country each, flags from the keys."""
    n = F.col("s_suppkey")
    country = F.element_at(F.array(*[F.lit(x) for x in ("Colombia", "Brasil", "Peru", "Ecuador", "Venezuela", "Bolivia")]), (n % 6 + 1).cast("int"))
    flags = [x for i, k in enumerate(M.GROUPS) for x in (F.lit(k), F.when(n % (i + 2) == 0, F.lit("VERDADERO")).otherwise("FALSO"))]
    props = F.create_map(
        F.lit("au_ID_concatenated"), F.concat(F.lit("m"), n.cast("string")), F.lit("au_country"), country, F.lit("au_level1"), F.lit("Bolivar"), F.lit("au_level2"), F.col("s_name"),
        F.lit("b_ADM1_PT"), F.when(n % 6 == 1, F.lit("Roraima")), F.lit("b_ADM2_PT"), F.when(n % 6 == 1, F.col("s_name")), F.lit("au_population"), F.when(n % 4 > 0, (n * 1013).cast("string")),
        F.lit("au_area km"), F.when(n % 3 > 0, (n * 7.5).cast("string")), F.lit("au_popup_window_es"), F.when(n % 5 == 0, F.lit("- EMBF: Frente Uno\n- Los Lobos")), F.lit("au_invest. with presence"),
        F.when(n % 2 == 0, F.lit("SIM")), *flags,
    )
    return load(s, d, "supplier").select(
        F.concat(F.lit("5/9/"), n.cast("string"), F.lit(".pbf")).alias("ruta"), F.lit(5).alias("zoom"), (n % 9).cast("int").alias("tile_x"), (n % 4).cast("int").alias("tile_y"), F.lit("au").alias("capa"),
        F.lit("Polygon").alias("tipo"), props.alias("props"),
    )


def bool_flags(s, d):
    m = M.municipalities(_features(s, d))
    return m.select("id_municipio", F.array_join("grupos", "|").alias("grupos"), F.col("n_grupos").cast("bigint").alias("n_grupos"), "investigado")


def municipality_chunks(s, d):
    m = M.municipalities(_features(s, d)).withColumn("doc_id", F.lit("AU-1")).withColumn("fuente", F.col("ruta"))
    return M.chunks(m).drop("idiomas")


def map_quality(s, d):
    m = M.municipalities(_features(s, d)).withColumn("doc_id", F.lit("AU-1")).withColumn("fuente", F.col("ruta"))
    return QC.report(QC.municipalities(m, 100), QC.map_texts(M.chunks(m)))


def tile_identity(s, d):
    """Documents of tiles by an inventory that knows every third tile, else by their path."""
    n = F.col("s_suppkey")
    inventory = load(s, d, "supplier").where(n % 3 == 0).select(
        F.concat(F.lit("5/"), (n % 9).cast("string"), F.lit("/"), n.cast("string"), F.lit(".pbf")).alias("clave"), F.concat(F.lit("AU-"), n.cast("string")).alias("doc_id"), F.col("s_name").alias("fuente")
    )
    return M.tile_identity(_features(s, d).select("ruta", "zoom", "tile_x"), inventory).select("ruta", "doc_id", "fuente")


def zoom_distribution(s, d):
    """Municipalities kept at each zoom, and their share."""
    g = municipality_dedup(s, d).groupBy("zoom").agg(F.count(F.lit(1)).alias("municipios"), F.sum("n_apariciones").alias("apariciones"))
    return g.select("zoom", "municipios", "apariciones")


_FLAGS = ", ".join(f"case when s_suppkey % {i + 2} = 0 then '{v}' end" for i, v in enumerate(M.GROUPS.values()))
QUERIES = {
    "tile_centroid": (
        tile_centroid,
        """select c_custkey, round(degrees(atan(sinh(3.141592653589793::double * (1 - 2 * ((c_nationkey % 2) + 0.5::double) / pow(2::double, c_custkey % 10 + 1))))), 5) as lat,
        round(((c_custkey % 7) + 0.5::double) / pow(2::double, c_custkey % 10 + 1) * 360 - 180, 5) as lon from customer""",
    ),
    "municipality_dedup": (
        municipality_dedup,
        """with o as (select o_custkey as id_municipio, o_orderkey % 5 as zoom, o_orderkey % 11 as tile_x, o_orderkey % 13 as tile_y, o_orderpriority || '/' || o_orderkey as ruta, o_orderpriority as capa from orders),
        a as (select *, row_number() over (partition by id_municipio order by zoom, tile_x, tile_y, ruta) as rn, count(*) over (partition by id_municipio) as n from o),
        s as (select id_municipio, array_to_string(list_sort(list(distinct ruta)), '|') as fuentes from o group by 1)
        select a.id_municipio, zoom, tile_x, tile_y, capa, n as n_apariciones, fuentes from a join s using (id_municipio) where rn = 1""",
    ),
    "tile_identity": (
        tile_identity,
        """select '5/9/' || s_suppkey || '.pbf' as ruta, case when s_suppkey % 3 = 0 then 'AU-' || s_suppkey else 'tesela_5_9_' || s_suppkey end as doc_id,
        case when s_suppkey % 3 = 0 then s_name else '5/9/' || s_suppkey || '.pbf' end as fuente from supplier""",
    ),
    "zoom_distribution": (
        zoom_distribution,
        """with o as (select o_custkey as id_municipio, o_orderkey % 5 as zoom, o_orderkey % 11 as tile_x, o_orderkey % 13 as tile_y, o_orderpriority || '/' || o_orderkey as ruta from orders),
        a as (select *, row_number() over (partition by id_municipio order by zoom, tile_x, tile_y, ruta) as rn, count(*) over (partition by id_municipio) as n from o)
        select zoom, count(*) as municipios, sum(n)::bigint as apariciones from a where rn = 1 group by zoom""",
    ),
    "bool_flags": (
        bool_flags,
        f"""with g as (select s_suppkey, list_filter([{_FLAGS}], lambda x: x is not null) as l from supplier)
        select 'm' || s_suppkey as id_municipio, array_to_string(l, '|') as grupos, len(l) as n_grupos, s_suppkey % 2 = 0 as investigado from g""",
    ),
    "municipality_chunks": (municipality_chunks, None),
    "map_quality": (map_quality, None),
}
