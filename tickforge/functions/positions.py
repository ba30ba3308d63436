"""Row numbers without a window: places in a sorted table whose keys may be of any size.

A window by key sorts each key in one task.  Here rows are dealt by ranges of (keys, order), so that a key takes as many
tasks as it has rows for; each partition counts its own rows, and what stands before it comes from counts of partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import saved


def _numbered(keys: list[str]):
    """Adds _at, the 0-based place of a row in its partition's run of equal keys; the batches come sorted."""

    def changes(x: pa.Array) -> np.ndarray:
        codes = x.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        return codes[1:] != codes[:-1]

    def run(batches):
        last, at = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                new[1:] |= changes(b.column(k))
            row = b.select(keys).slice(0, 1).to_pylist()[0] if keys else {}
            new[0] = row != last
            starts = np.flatnonzero(new)
            place = np.arange(b.num_rows) + (0 if new[0] else at)
            if len(starts):
                run_of = np.cumsum(new) - 1
                place = np.where(run_of >= 0, np.arange(b.num_rows) - starts[np.maximum(run_of, 0)], place)
            last, at = b.select(keys).slice(b.num_rows - 1, 1).to_pylist()[0] if keys else {}, int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pc.cast(pa.array(place), pa.int64())], names=[*b.schema.names, "_at"])

    return run


def sorted_places(df: DataFrame, keys: list[str], order: list[str], name: str = "row_idx", parts: int | None = None) -> DataFrame:
    """``df`` with ``name``, the 0-based place of each row among the rows of its keys, by ``order``; a written table.

    Nulls come first; rows that tie are ordered by a hash of all columns, so that equal input gives equal places.  No task
    holds a key whole: work and memory of a task are those of a range of rows.  What is broadcast has at most a row for each partition.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, *order, "_tie"]
    ranged = df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie").withColumn("_part", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", _at long"
    table = saved(ranged.mapInArrow(_numbered(keys), schema), "places")
    counts = table.groupBy("_part", *keys).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # of partitions
    offset = counts.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k_{k}") for k in keys], F.sum("_rows").over(earlier).alias("_before")).where("_before > 0")
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return table.join(F.broadcast(offset), same, "left").select(*df.columns, (F.col("_at") + F.coalesce("_before", F.lit(0))).alias(name))
