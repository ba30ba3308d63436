"""Scans: CSV with an all-text schema, Parquet, directories, pairs of files, split documents."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import no_nan

BACKUP_MARKS = ("_backup", "_original")


def existing(spark: SparkSession, path: str, suffix: str) -> str:
    """The path, if it is there, in whatever file system Spark finds it, and has this suffix."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)
    if not path.endswith(suffix):
        raise ValueError(f"{path} is not a {suffix} file")
    return path


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns as text.  Give ``columns`` to spare the pass that reads the header."""
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    return no_nan(spark.read.parquet(existing(spark, path, ".parquet")))


def read_directory(spark: SparkSession, path: str, pattern: str = "*.parquet", skip: tuple[str, ...] = BACKUP_MARKS) -> DataFrame:
    """All files of a folder in one job, with ``file_name``; names with one of the marks are left out."""
    df = spark.read.option("pathGlobFilter", pattern).parquet(path).select("*", F.col("_metadata.file_name").alias("file_name"))
    for mark in skip:
        df = df.where(~F.contains("file_name", F.lit(mark)))
    return no_nan(df)


def pair_files(features: list[str], labels: list[str]) -> list[tuple[str, str]]:
    """Each feature file with the first label file whose name holds its base name; others are left out."""
    out = []
    for f in sorted(features):
        base = Path(f).stem.removesuffix("_features")
        if hit := next((x for x in sorted(labels) if base in Path(x).stem), None):
            out.append((f, hit))
    return out


def find_splits(folder: str, spark: SparkSession | None = None) -> str:
    """The first split document of a folder, in whatever file system Spark finds it."""
    spark = spark or SparkSession.active()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*_splits.json")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    if hit := next(iter(sorted(str(f.getPath().toString()) for f in found)), None):
        return hit
    raise FileNotFoundError(f"no *_splits.json in {folder}")


#: The names of the nested split document.
_RANGE = "struct<start:string, end:string>"
SPLIT_DOCUMENT = f"split_id int, metadata struct<train_start:string, train_end:string, val_start:string, val_end:string, gap_days:double, symbols:array<string>>, splits map<string, struct<train_indices:array<long>, val_indices:array<long>, train_samples:long, val_samples:long, train_date_range:{_RANGE}, val_date_range:{_RANGE}>>"


def read_split_document(spark: SparkSession, path: str) -> DataFrame:
    """The splits of a nested document: an array of splits in one file, or one split a line."""
    first = spark.read.text(path).where("trim(value) <> ''").first()
    array = first is not None and first["value"].lstrip().startswith("[")
    return spark.read.option("multiLine", array).schema(SPLIT_DOCUMENT).json(path)


def nested_positions(document: DataFrame) -> DataFrame:
    """(split_id, symbol, role, row_idx) of a nested document."""
    by_symbol = document.select("split_id", F.explode("splits").alias("symbol", "s"))
    role = lambda r: F.struct(F.lit(r).alias("role"), F.coalesce(F.col(f"s.{r}_indices"), F.array().cast("array<long>")).alias("i"))
    return by_symbol.select("split_id", "symbol", F.explode(F.array(role("train"), role("val"))).alias("r")).select("split_id", "symbol", "r.role", F.explode("r.i").alias("row_idx"))


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """(split_id, symbol, role, row_idx) of a split document, flat or nested."""
    if "splits" not in spark.read.text(path).where("value rlike '\"(splits|indices)\"'").select(F.regexp_extract("value", '"(splits|indices)"', 1)).first()[0]:
        return spark.read.json(path).select("split_id", "symbol", "role", F.explode("indices").alias("row_idx"))
    return nested_positions(read_split_document(spark, path))
