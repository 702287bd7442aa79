"""Global positions and running sums in a total order, without one task.

A window with ``orderBy`` and no ``partitionBy`` moves every row to a single
partition. Here the rows are range-partitioned on the order key instead, each
sorted partition is numbered locally (and locally summed), the per-partition
totals (one row per partition, so bounded by the partition count) are turned
into offsets, and the offsets are broadcast back. The sorted layout is pinned
with a reliable checkpoint so both branches see the same partition ids.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_PID = "_ord_pid"
_LOC = "_ord_loc"


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_index(
    df: DataFrame,
    order: Sequence,
    idx_col: str = "idx",
    sums: Sequence[tuple[str, str]] = (),
    num_partitions: int | None = None,
    pin: bool = True,
) -> DataFrame:
    """Add ``idx_col`` = 0-based position in ``order`` (which must be a total,
    unique order) and, for each ``(src, dst)`` in ``sums``, ``dst`` = inclusive
    running sum of ``src`` (integral columns) in that order.

    Pass narrow frames: the local step runs as one vectorised pass per
    partition.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ocols = _order_cols(order)
    ranged = df.repartitionByRange(n, *ocols).sortWithinPartitions(*ocols)

    sums = list(sums)
    out_fields = list(ranged.schema.fields) + [
        T.StructField(_PID, T.IntegerType(), False),
        T.StructField(_LOC, T.LongType(), False),
    ] + [T.StructField(f"_ord_cum_{dst}", T.LongType(), True) for _, dst in sums]
    out_schema = T.StructType(out_fields)

    def number_partition(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        base = 0
        carry = [0] * len(sums)
        for pdf in batches:
            m = len(pdf)
            if m == 0:
                continue
            pdf[_PID] = np.int32(pid)
            pdf[_LOC] = np.arange(base, base + m, dtype=np.int64)
            base += m
            for j, (src, dst) in enumerate(sums):
                c = pdf[src].fillna(0).astype(np.int64).cumsum() + carry[j]
                carry[j] = int(c.iloc[-1])
                pdf[f"_ord_cum_{dst}"] = c
            yield pdf

    local = ranged.mapInPandas(number_partition, out_schema)
    if pin:
        local = materialize(local)

    stat_aggs = [F.count(F.lit(1)).alias("_ord_n")] + [
        F.sum(F.col(src).cast("long")).alias(f"_ord_tot_{dst}") for src, dst in sums
    ]
    stats = local.groupBy(_PID).agg(*stat_aggs)
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the single-partition window here is bounded by n
    offsets = stats.select(
        _PID,
        F.coalesce(F.sum("_ord_n").over(before), F.lit(0)).alias("_ord_off_n"),
        *[
            F.coalesce(F.sum(f"_ord_tot_{dst}").over(before), F.lit(0)).alias(f"_ord_off_{dst}")
            for _, dst in sums
        ],
    )
    out = local.join(F.broadcast(offsets), _PID)
    out = out.withColumn(idx_col, (F.col("_ord_off_n") + F.col(_LOC)).cast("long"))
    for _, dst in sums:
        out = out.withColumn(dst, (F.col(f"_ord_off_{dst}") + F.col(f"_ord_cum_{dst}")).cast("long"))
    drop = [_PID, _LOC, "_ord_off_n"] + [f"_ord_off_{d}" for _, d in sums] + [f"_ord_cum_{d}" for _, d in sums]
    return out.drop(*drop)
