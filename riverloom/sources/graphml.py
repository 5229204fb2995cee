"""GraphML through Spark's XML source and as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import XML_EDGE, XML_KEY, XML_NODE


def _keys(spark: SparkSession, path: str) -> dict[tuple[str, str], str]:
    """(for, name) -> id of the file's declared attributes, a handful."""
    rows = spark.read.format("xml").option("rowTag", "key").schema(XML_KEY).load(path).collect()
    return {(r["_for"], r["_attr.name"]): r["_id"] for r in rows}


def _value(keys: dict, kind: str, name: str) -> Column:
    key = keys.get((kind, name), name)
    return F.get(F.filter("data", lambda d: d["_key"] == key), F.lit(0))["_VALUE"]


def _set(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x != "")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes with their attributes; of nodes that share an id the first in the file stays."""
    k = _keys(spark, path)
    raw = spark.read.format("xml").option("rowTag", "node").schema(XML_NODE).load(path)
    rows = raw.select(
        F.col("_id").alias("node_id"), _value(k, "node", "texto").alias("texto"), _value(k, "node", "tipo").alias("tipo"), _value(k, "node", "fenomeno").try_cast("int").alias("fenomeno"),
        _set(_value(k, "node", "chunk_ids")).alias("chunk_ids"), _set(_value(k, "node", "doc_ids")).alias("doc_ids"),
    )
    rest = [c for c in rows.columns if c != "node_id"]
    g = rows.withColumn("_o", F.monotonically_increasing_id()).groupBy("node_id").agg(F.min_by(F.struct(*rest), "_o").alias("r"))
    return g.select("node_id", *[F.col(f"r.{c}").alias(c) for c in rest])


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """S7."""
    k = _keys(spark, path)
    raw = spark.read.format("xml").option("rowTag", "edge").schema(XML_EDGE).load(path)
    return raw.select(F.col("_source").alias("src"), F.col("_target").alias("dst"), _value(k, "edge", "relacion").alias("relacion"), _set(_value(k, "edge", "chunk_ids")).alias("chunk_ids"))


_NODE_KEYS, _EDGE_KEYS = ("texto", "tipo", "fenomeno", "chunk_ids", "doc_ids"), ("relacion", "chunk_ids")


def _escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def _data(rows: DataFrame, names: tuple[str, ...]) -> Column:
    out = []
    for n in names:
        v = F.array_join(F.array_sort(n), "|") if n.endswith("_ids") else F.col(n).cast("string")
        out.append(F.when(v.isNotNull(), F.concat(F.lit(f'<data key="{n}">'), _escape(v), F.lit("</data>"))))
    return F.concat_ws("", *out)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """K3: one GraphML file; sets become sorted strings joined by |. Lines are written by Spark in order: head, nodes, edges, end."""
    spark = nodes.sparkSession
    keys = "".join(f'<key id="{k}" for="{t}" attr.name="{k}" attr.type="string"/>' for t, ks in (("node", _NODE_KEYS),) for k in ks)
    keys += '<key id="e_relacion" for="edge" attr.name="relacion" attr.type="string"/><key id="e_chunk_ids" for="edge" attr.name="chunk_ids" attr.type="string"/>'
    head = f'<?xml version="1.0" encoding="UTF-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns">{keys}<graph edgedefault="directed">'
    n = nodes.select(F.lit(1).alias("o"), F.concat(F.lit('<node id="'), _escape(F.col("node_id")), F.lit('">'), _data(nodes, _NODE_KEYS), F.lit("</node>")).alias("value"))
    e_data = F.replace(F.replace(_data(edges, _EDGE_KEYS), F.lit('key="relacion"'), F.lit('key="e_relacion"')), F.lit('key="chunk_ids"'), F.lit('key="e_chunk_ids"'))
    e = edges.select(F.lit(2).alias("o"), F.concat(F.lit('<edge source="'), _escape(F.col("src")), F.lit('" target="'), _escape(F.col("dst")), F.lit('">'), e_data, F.lit("</edge>")).alias("value"))
    ends = spark.createDataFrame([(0, head), (3, "</graph></graphml>")], "o int, value string")
    ends.unionByName(n).unionByName(e).orderBy("o", "value").select("value").coalesce(1).write.mode("overwrite").text(path)
