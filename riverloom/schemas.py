"""Schemas of the engine's relations."""

from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


FRAGMENT = _struct(
    ("doc_id", _S), ("chunk_id", _S), ("fuente", _S), ("formato", _S), ("fenomeno", _I), ("posicion", _I), ("num_tokens", _I), ("texto", _S),
    ("ruta_fuente", _S), ("observatorio", _S), ("pagina_inicio", _I), ("pagina_fin", _I),
)
MANDATORY = ("doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto")
#: Both dialects of fragment files in one schema.
FRAGMENT_ANY = T.StructType(
    FRAGMENT.fields
    + _struct(("text", _S), ("phenomenon", _S), ("source_path", _S), ("word_count", _I), ("observatory", _S), ("page_start", _I), ("page_end", _I), ("_corrupt_record", _S)).fields
)
QUERY = _struct(("query_id", _S), ("consulta", _S))
NODE = _struct(("node_id", _S), ("texto", _S), ("tipo", _S), ("fenomeno", _I), ("chunk_ids", T.ArrayType(_S)), ("doc_ids", T.ArrayType(_S)))
EDGE = _struct(("src", _S), ("dst", _S), ("relacion", _S), ("chunk_ids", T.ArrayType(_S)))
_DATA = T.ArrayType(_struct(("_VALUE", _S), ("_key", _S)))
XML_NODE = _struct(("_id", _S), ("data", _DATA))
XML_EDGE = _struct(("_source", _S), ("_target", _S), ("data", _DATA))
XML_KEY = _struct(("_id", _S), ("_for", _S), ("_attr.name", _S), ("_attr.type", _S))
