"""Session helpers: ship the package to the workers and read tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark context, wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_riverloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(prefix="riverloom-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name) / p.relative_to(root))
    sc.addPyFile(name)
    sc._riverloom_shipped = True


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder: the context's, else the session's ``spark.checkpoint.dir``.

    Where neither is set, a run within one process (``local[n]``, as in tests) makes a folder of its own; a cluster raises.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            folder = tempfile.mkdtemp(prefix="riverloom-")
        if not folder:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's shared checkpoint folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of the shared folder: cuts the lineage as ``cut`` does, and later reads take only the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 50_000) -> DataFrame:
    """``df`` with a broadcast hint where it has at most ``most`` rows; beyond that Spark joins it by shuffle or in blocks.

    For question sets and lookups whose size nothing else bounds: the count stops after ``most`` rows.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if small_enough(df, most) else df


def small_enough(df: DataFrame, most: int = 50_000) -> bool:
    """At most ``most`` rows; the count stops after them."""
    return df.limit(most + 1).count() <= most


def spread(df: DataFrame, under: int = 16 << 20) -> DataFrame:
    """A small table, often one file and so one task, over as many partitions as there are cores; judged by the plan's size alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < under else df
