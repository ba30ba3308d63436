"""Sequences for networks, stored once.

A window of ``length`` rows up to each row repeats every row ``length`` times if windows are stored.  Here a row of the packed table
is a block: a matrix of its rows and of the ``length`` - 1 rows before it.  Windows are views of that matrix, made in the task that reads it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.positions import sorted_places
from ..sources.scratch import saved

#: Rows of a block.
ROWS = 4096


def pack(df: DataFrame, cols: list[str], length: int = 64, keys: tuple[str, ...] = ("symbol",), rows: int = ROWS, label: str | None = "y") -> DataFrame:
    """keys, _block, first (0-based place of the block's first own row), halo (rows before it), timestamps and labels of the own rows, values (float32, row by row).

    Missing values are NaN.  No task sorts a whole key; a block has at most ``rows`` + ``length`` - 1 rows.
    """
    rows = max(rows, length)
    named = df.select(*keys, "timestamp", (F.col(label).cast("int") if label else F.lit(None).cast("int")).alias("_y"), F.array(*[F.coalesce(F.col(c).cast("float"), F.lit(float("nan")).cast("float")) for c in cols]).alias("_x"))
    placed = sorted_places(named, list(keys), ["timestamp"], "_at")
    inside, block = F.col("_at") % rows, F.floor(F.col("_at") / rows)
    copied = F.array_compact(F.array(block, F.when(inside >= rows - (length - 1), block + 1)))
    dealt = placed.withColumn("_block", F.explode(copied)).withColumn("_own", F.col("_block") == block)
    g = dealt.groupBy(*keys, "_block").agg(F.array_sort(F.collect_list(F.struct("_at", "_own", "timestamp", "_y", "_x"))).alias("_rows"), F.count_if("_own").alias("_n")).where("_n > 0")
    own = F.filter("_rows", lambda r: r["_own"])
    return g.select(*keys, "_block", (F.col("_block") * rows).alias("first"), (F.size("_rows") - F.col("_n")).cast("int").alias("halo"), F.transform(own, lambda r: r["timestamp"]).alias("timestamps"), F.transform(own, lambda r: r["_y"]).alias("labels"), F.flatten(F.transform("_rows", lambda r: r["_x"])).alias("values"))


def views(b: pa.RecordBatch, i: int, width: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of row i of a batch of the packed table: which of its own rows have a whole window, and those windows (n x length x width), not copied."""
    x = b.column("values")[i].values.to_numpy().reshape(-1, width)
    halo, n = b.column("halo")[i].as_py(), len(b.column("timestamps")[i])
    if len(x) < length:
        return np.zeros(0, np.int64), np.zeros((0, length, width), np.float32)
    w = np.lib.stride_tricks.sliding_window_view(x, length, axis=0).transpose(0, 2, 1)
    ends = np.arange(len(w)) + length - 1 - halo
    return ends[ends >= 0], w[ends >= 0][:n]


def sequences_of(packed: DataFrame, width: int, length: int, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """keys, timestamp, row_idx, sequence (length x width): the windows written out, for checks and exports."""
    kinds = {f.name: f.dataType.simpleString() for f in packed.schema}
    element = kinds["timestamps"][6:-1]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                at, w = views(b, i, width, length)
                if len(at):
                    flat = np.ascontiguousarray(w, np.float32)
                    inner = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, width, dtype=np.int32), flat.ravel())
                    outer = pa.ListArray.from_arrays(np.arange(0, len(at) * length + 1, length, dtype=np.int32), inner)
                    same = [pa.array([b.column(k)[i].as_py()] * len(at), b.schema.field(k).type) for k in keys]
                    yield pa.RecordBatch.from_arrays([*same, b.column("timestamps")[i].values.take(pa.array(at)), pa.array(at + b.column("first")[i].as_py()), outer], names=[*keys, "timestamp", "row_idx", "sequence"])

    return packed.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"timestamp {element}, row_idx long, sequence array<array<float>>"]))


def packed(df: DataFrame, cols: list[str], length: int = 64, keys: tuple[str, ...] = ("symbol",), rows: int = ROWS, label: str | None = "y") -> DataFrame:
    """``pack``, written."""
    return saved(pack(df, cols, length, keys, rows, label), "sequences")
