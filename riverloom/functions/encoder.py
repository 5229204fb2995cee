"""Text encoders behind one protocol. The offline default hashes tokens; a model can take its place."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship

_NOT_WORD = re.compile(r"[^\w\s]")


class Encoder(Protocol):
    def encode(self, texts: list[str]) -> np.ndarray:
        """One unit vector a text; rows of a batch in order."""


class HashEncoder:
    """Token counts in md5 buckets, unit length; a text without tokens gives the zero vector."""

    def __init__(self, size: int = 64, prefix: str = ""):
        self.size, self.prefix = size, prefix
        self.memo: dict[str, int] = {}

    def bucket(self, token: str) -> int:
        b = self.memo.get(token)
        if b is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            b = self.memo[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.size
        return b

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size))
        for i, t in enumerate(texts):
            tokens = _NOT_WORD.sub(" ", (self.prefix + t).lower()).split()
            if tokens:
                out[i] = np.bincount([self.bucket(x) for x in tokens], minlength=self.size)
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, n, out=out, where=n > 0)


def encode(rows: DataFrame, key: str, text: str, encoder: Encoder | None = None) -> DataFrame:
    """(id, v) by Arrow batches; null texts are left out. The encoder is loaded once a worker."""
    ship(rows.sparkSession)
    enc = encoder or HashEncoder()
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = enc.encode(b.column(1).to_pylist())
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32)), pa.array(v.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), values], names=["id", "v"])

    return rows.select(key, text).where(f"{text} is not null").mapInArrow(run, f"id {kind}, v array<double>")
