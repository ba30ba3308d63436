"""Sinks.  All are distributed writers; summaries are the only rows that reach the driver."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FeatureConfig

#: Positions in one line of a split document, at most.
INDICES = 10_000


def mode(force: bool) -> str:
    """Existing output is left alone unless forced."""
    return "overwrite" if force else "ignore"


def write_bars(df: DataFrame, path: str, force: bool = False, codec: str = "snappy", by_symbol: bool = False, row_group_mb: int | None = None, dictionary: bool = True) -> None:
    """Parquet with statistics; row groups are bounded by size, since the format's writer does not count rows."""
    writer = df.write.mode(mode(force)).option("compression", codec).option("parquet.enable.dictionary", dictionary)
    if row_group_mb:
        writer = writer.option("parquet.block.size", row_group_mb << 20)
    (writer.partitionBy("symbol") if by_symbol else writer).parquet(path)


def float32(df: DataFrame) -> DataFrame:
    """float64 -> float32, at the sink only."""
    return df.select(*[F.col(f.name).cast("float").alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema])


def write_features(df: DataFrame, path: str, config: FeatureConfig = FeatureConfig(), force: bool = False) -> None:
    write_bars(float32(df) if config.float32 else df, path, force)


def write_folds(folder: str, metrics: DataFrame, predictions: DataFrame, importance: DataFrame | None = None, models: dict[int, object] | None = None, force: bool = False) -> None:
    """What training leaves of each fold: metrics (JSON), predictions (Parquet by fold), importance (JSON and CSV), fitted models."""
    metrics.write.mode(mode(force)).partitionBy("split_id").json(f"{folder}/metrics")
    predictions.write.mode(mode(force)).partitionBy("split_id").parquet(f"{folder}/predictions")
    if importance is not None:
        importance.write.mode(mode(force)).json(f"{folder}/importance")
        importance.write.mode(mode(force)).option("header", True).csv(f"{folder}/importance_csv")
    for fold, model in (models or {}).items():
        writer = model.write()
        (writer.overwrite() if force else writer).save(f"{folder}/models/fold={fold}")


def dataset_metadata(df: DataFrame) -> DataFrame:
    """One row: rows, columns, symbols, first and last time."""
    return df.agg(F.count("*").alias("n_rows"), F.array_sort(F.collect_set("symbol")).alias("symbols"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end")).withColumn("columns", F.lit(df.columns))


def write_dataset(df: DataFrame, path: str, force: bool = False) -> None:
    write_bars(float32(df), path, force)
    dataset_metadata(df).write.mode(mode(force)).json(path.removesuffix(".parquet") + "_metadata.json")


def write_splits(assigned: DataFrame, path: str, form: str = "indices", force: bool = False) -> None:
    """``assigned``: split_id, symbol, role, row_idx (and, for ``data``, all columns)."""
    if form == "indices":
        # A line holds a bounded stretch of indices, not all rows of a split and symbol.
        stretch = F.floor(F.col("row_idx") / INDICES).alias("_stretch")
        assigned.groupBy("split_id", "symbol", "role", stretch).agg(F.array_sort(F.collect_list("row_idx")).alias("indices")).drop("_stretch").write.mode(mode(force)).json(path)
    elif form == "nested":
        split_document(assigned).write.mode(mode(force)).json(path)
    elif form == "metadata":
        assigned.groupBy("split_id", "symbol", "role").agg(F.count("*").alias("samples"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end")).write.mode(mode(force)).json(path)
    elif form == "data":
        assigned.write.mode(mode(force)).partitionBy("split_id", "role").parquet(path)
    else:
        raise ValueError(f"unknown form of splits: {form}")


def split_document(assigned: DataFrame, windows: DataFrame | None = None, gap_days: float = 0.0) -> DataFrame:
    """One row a split, in the nested form that ``readers.read_split_document`` reads: split_id, metadata, splits (a map by symbol).

    ``assigned``: split_id, symbol, role, row_idx, timestamp.  Times are ISO texts; without ``windows`` those of a split are its rows' first and last ones.
    A row holds all positions of its split, as the form asks; for splits of very many rows there is the form ``indices``.
    """
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    t, aggs, entry = F.col("timestamp"), [], []
    for r in ("train", "val"):
        own = lambda x, r=r: F.when(F.col("role") == r, x)
        aggs += [F.array_sort(F.collect_list(own(F.col("row_idx").cast("long")))).alias(f"{r}_indices"), F.min(own(t)).alias(f"_{r}_a"), F.max(own(t)).alias(f"_{r}_b")]
        entry += [F.col(f"{r}_indices"), F.size(f"{r}_indices").cast("long").alias(f"{r}_samples"), F.struct(iso(F.col(f"_{r}_a")).alias("start"), iso(F.col(f"_{r}_b")).alias("end")).alias(f"{r}_date_range")]
    by_symbol = assigned.groupBy("split_id", "symbol").agg(*aggs)
    one = by_symbol.groupBy("split_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", F.struct(*entry).alias("s"))))).alias("splits"), F.array_sort(F.collect_set("symbol")).alias("symbols"),
        *[f(f"_{r}_{x}").alias(f"{r}_{n}") for r in ("train", "val") for x, n, f in (("a", "start", F.min), ("b", "end", F.max))],
    )
    if windows is not None:
        one = one.drop("train_start", "train_end", "val_start", "val_end").join(F.broadcast(windows), "split_id")  # a row for each split
    meta = F.struct(*[iso(F.col(c)).alias(c) for c in ("train_start", "train_end", "val_start", "val_end")], F.lit(float(gap_days)).alias("gap_days"), "symbols")
    return one.select("split_id", meta.alias("metadata"), "splits")


def output_name(path: str, stage: str, suffix: str = "_features") -> str:
    """The next stage's file name for this input."""
    stem = Path(path).stem
    if stage == "normalize":
        stem = stem.removesuffix("_cleaned").removesuffix("_original_backup")
    elif stage == "features":
        stem += suffix
    elif stage == "labels":
        stem += "_labels"
    elif stage == "dataset":
        stem = stem.removesuffix("_features") + "_dataset"
    else:
        raise ValueError(f"unknown stage: {stage}")
    return f"{stem}.parquet"
