"""Mapbox vector tiles (2.1) and the file inventory."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

TILE_BYTES = 50
_KINDS = {1: "Point", 2: "LineString", 3: "Polygon"}


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message; truncated data raises."""
    i, n = 0, len(data)

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while i < n:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = 8 if kind == 1 else 4 if kind == 5 else varint() if kind == 2 else -1
            if size < 0 or i + size > n:
                raise ValueError("bad tile")
            yield tag >> 3, data[i : i + size]
            i += size


def _value(data: bytes) -> str | None:
    """A tile value as text."""
    for k, v in fields(data):
        if k == 1:
            return bytes(v).decode("utf-8", "replace")
        if k in (2, 3):
            x = struct.unpack("<f" if k == 2 else "<d", v)[0]
            return str(int(x)) if x == int(x) else repr(x)
        if k in (4, 5):
            return str(v - (1 << 64) if v >= 1 << 63 else v)
        if k == 6:
            return str((v >> 1) ^ -(v & 1))
        if k == 7:
            return "true" if v else "false"
    return None


def decode_tile(data: bytes) -> list[tuple[str, str | None, dict[str, str]]] | None:
    """(layer, geometry type, properties) of each feature; None for a tile that is too small or can't be read."""
    if len(data) < TILE_BYTES:
        return None
    try:
        if data[:2] == b"\x1f\x8b":
            data = gzip.decompress(data)
        out = []
        for k, layer in fields(data):
            if k != 3:
                continue
            name, keys, values, features = "", [], [], []
            for j, v in fields(layer):
                if j == 1:
                    name = v.decode("utf-8", "replace")
                elif j == 2:
                    features.append(v)
                elif j == 3:
                    keys.append(v.decode("utf-8", "replace"))
                elif j == 4:
                    values.append(_value(v))
            for f in features:
                kind, tags = None, []
                for j, v in fields(f):
                    if j == 3:
                        kind = _KINDS.get(v)
                    elif j == 2:
                        at = 0
                        while at < len(v):
                            x = shift = 0
                            while True:
                                b = v[at]
                                at += 1
                                x |= (b & 0x7F) << shift
                                if b < 0x80:
                                    break
                                shift += 7
                            tags.append(x)
                props = {keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2]) if values[b] is not None}
                out.append((name, kind, props))
        return out
    except (IndexError, ValueError, OSError, EOFError, struct.error):
        return None


def read_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Features of every .pbf under ``folder`` -> (ruta, zoom, tile_x, tile_y, capa, tipo, props).

    Coordinates come from the path ``.../z/x/y.pbf``. Tiles under TILE_BYTES and unreadable ones give no row.
    """
    ship(spark)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pbf").load(folder).select("path", "content")
    schema = "ruta string, capa string, tipo string, props map<string,string>"
    kind = pa.schema([("ruta", pa.string()), ("capa", pa.string()), ("tipo", pa.string()), ("props", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p, *f) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for f in decode_tile(c) or ()]
            columns = [[r[i] for r in rows] for i in range(3)] + [[list(r[3].items()) for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, kind)], schema=kind)

    rows = raw.mapInArrow(run, schema)
    part = lambda i: F.regexp_extract("ruta", r"(\d+)/(\d+)/[^/\d]*(\d+)[^/]*$", i).try_cast("int")
    return rows.select("ruta", part(1).alias("zoom"), part(2).alias("tile_x"), part(3).alias("tile_y"), "capa", "tipo", "props")


def inventory_keys(inventory: DataFrame, observatory: str = "Amazon_Underworld") -> DataFrame:
    """(clave, clave_xyz, doc_id, fuente) of the tiles in an inventory with either spelling of its columns.

    Keys are z/x/name and z/x/y from the last two folders and the first digits of the name.
    """
    low = {c.lower().replace(" ", "_"): c for c in inventory.columns}
    rows = inventory.select(*[F.col(f"`{low[c]}`").alias(c) for c in ("doc_id", "observatorio", "carpeta", "nombre_estandarizado")])
    rows = rows.where((F.col("observatorio") == observatory) & F.lower("nombre_estandarizado").endswith(".pbf"))
    parts = F.split(F.regexp_replace(F.regexp_replace("carpeta", r"\\", "/"), "/+$", ""), "/")
    z, x = F.element_at(parts, -2), F.element_at(parts, -1)
    y = F.regexp_extract("nombre_estandarizado", r"(\d+)", 1)
    return rows.where(F.size(parts) >= 2).select(
        F.concat_ws("/", z, x, "nombre_estandarizado").alias("clave"), F.concat_ws("/", z, x, y).alias("clave_xyz"), "doc_id", F.concat_ws("/", F.array_join(parts, "/"), "nombre_estandarizado").alias("fuente")
    )


def read_inventory(spark: SparkSession, path: str, sheet: str = "Inventario de Archivos") -> DataFrame:
    """A spreadsheet (through pandas, on the driver: an inventory is one sheet), CSV or Parquet."""
    if path.endswith((".xlsx", ".xls")):
        try:
            import pandas as pd

            return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet, dtype=str))
        except ImportError as e:
            raise RuntimeError("spreadsheets need the optional package openpyxl") from e
    return spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
