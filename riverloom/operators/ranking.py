"""Running numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def numbered(rows: DataFrame, group: str, order: list[Column | str], name: str, total: str | None = None) -> DataFrame:
    """Adds ``name``, the running number from 0 within ``group`` by ``order``, and ``total``, the group's rows.

    A window over the group would bring all of a hot group to one task. Here the rows are range-partitioned
    by group and order, so that a hot group spreads over tasks; each task numbers its own rows, and the
    counts of the tasks before it (one small row a group and task) are added. ``order`` must be unique
    within the group. A null group is a group.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    kept = rows.columns
    tagged = cut(rows.repartitionByRange(F.col(group), *keys).withColumn("_p", F.spark_partition_id()))
    local = tagged.withColumn("_n", F.row_number().over(Window.partitionBy("_p", group).orderBy(*keys)) - 1)
    counts = tagged.groupBy(F.col(group).alias("_g"), F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_g").orderBy("_q")
    before = F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_g", "_q", before.alias("_before"), F.sum("_c").over(Window.partitionBy("_g")).alias("_total"))
    joined = local.join(offsets, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    out = joined.withColumn(name, (F.col("_n") + F.col("_before")).cast("bigint"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.select(*kept, name, *([total] if total else []))
