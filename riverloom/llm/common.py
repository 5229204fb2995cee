"""Shared helpers of the training-data operators."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship, stored

TOKENIZER_DIR = "/opt/tokenizers"


#: Input under so many bytes is spread over all cores first; larger input has enough partitions of its own.
SPREAD_BYTES = 16 << 20


def spread(df: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """A small table, often one file and so one task, over as many partitions as there are cores. Judged by the plan's size alone, or by that of the table ``of`` which ``df`` has columns."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str((of or df)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < SPREAD_BYTES else df


def tokenizer_bytes(file: str, tokenizer_dir: str | None = None) -> bytes:
    with open(os.path.join(tokenizer_dir or TOKENIZER_DIR, file), "rb") as f:
        return f.read()


def map_columns(df: DataFrame, columns: list[str], schema: str, f: Callable[[dict[str, list]], dict[str, list]]) -> DataFrame:
    """Run ``f`` over Arrow batches as dicts of Python lists; only ``columns`` cross to Python."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = f({c: b.column(i).to_pylist() for i, c in enumerate(columns)})
            yield pa.RecordBatch.from_arrays([pa.array(out[x.name], type=x.type) for x in target], schema=target)

    return spread(df.select(*[F.col(c) for c in columns])).mapInArrow(run, schema)


#: Numbers in a block of ``sum_arrays``.
BLOCK = 1 << 13


def sum_arrays(df: DataFrame, columns: list[str], f: Callable[[dict[str, list]], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of ``f`` over all Arrow batches of these columns, an array of whole numbers of this shape.

    Each partition adds up its own; blocks of the array are then added by shuffle, so that no task and not the driver
    holds more than a few arrays, however many partitions there are.
    """
    ship(df.sparkSession)
    n = math.prod(shape)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype=np.int64)
        for b in batches:
            total += f({c: b.column(i).to_pylist() for i, c in enumerate(columns)}).ravel()
        for k in range(0, n, BLOCK):
            if (x := total[k : k + BLOCK]).any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k // BLOCK], pa.int32()), "numbers": pa.array([x.tobytes()], pa.binary())})

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(x, dtype=np.int64)
        for k, x in total.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "numbers": pa.array([x.tobytes()], pa.binary())})

    schema = "block int, numbers binary"
    out = np.zeros(n, dtype=np.int64)
    for r in spread(df.select(columns), df).mapInArrow(within, schema).repartition("block").mapInArrow(over, schema).collect():
        x = np.frombuffer(r.numbers, dtype=np.int64)
        out[r.block * BLOCK : r.block * BLOCK + len(x)] = x
    return out.reshape(shape)


__all__ = ["cut", "map_columns", "spread", "stored", "sum_arrays", "tokenizer_bytes"]
