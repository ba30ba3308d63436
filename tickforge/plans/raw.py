"""A folder of raw CSV files of both formats to canonical bars, with a manifest of what is done.

Files are rows: one scan gives each file's header line, size and time; expressions over that table decide format, symbol, output
name and what is wrong.  Files with the same header are read together, so jobs follow the number of headers, not of files.  The
manifest is written last: after a failure the next run does again what has no line in it.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import SYMBOLS, clean, infer_symbol, normalize_bidask, normalize_ohlc
from ..schemas import BIDASK_RAW
from ..sources.readers import BACKUP_MARKS, existing
from ..sources.scratch import saved

#: Columns of the manifest.  status: done or failed.
MANIFEST = "name string, length long, modified timestamp, format string, symbol string, output string, rows_in long, rows_out long, status string, error string"


def _file_name() -> Column:
    """The name of the file that a row comes from, as it is on disk (Spark gives it as part of an address)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def scan(spark: SparkSession, folder: str, pattern: str = "*.csv", skip: tuple[str, ...] = BACKUP_MARKS) -> DataFrame:
    """path, name, length, modified, header of the folder's files but the backups; an empty file has no header."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)  # the contents are not read
    # Spark's scans leave out files of no bytes, its listing does not.
    names = spark.createDataFrame([(unquote(u.rsplit("/", 1)[1]),) for u in listed.inputFiles()], "name string")
    listed = listed.select("path", F.col("_metadata.file_path").alias("_uri"), _file_name().alias("name"), "length", F.col("modificationTime").alias("modified"))
    lines = spark.read.option("pathGlobFilter", pattern).text(folder).select("value", F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    header = lines.where("_block = 0").groupBy("_uri").agg(F.min_by("value", "_line").alias("header"))
    files = names.join(listed, "name", "left").join(header, "_uri", "left").drop("_uri").withColumn("length", F.coalesce("length", F.lit(0)))
    for mark in skip:
        files = files.where(~F.contains("name", F.lit(mark)))
    return files


def base_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), "_cleaned|_original_backup", "")


def planned(files: DataFrame) -> DataFrame:
    """``files`` with columns, format, symbol, output and error (missing if the file can be read)."""
    columns = F.transform(F.split(F.col("header"), ","), lambda c: F.trim(F.translate(c, '"﻿\r', "")))
    has = lambda names: F.forall(F.array(*map(F.lit, names)), lambda c: F.array_contains("columns", c))
    df = files.withColumn("columns", columns)
    kind = F.when(has([c for c in BIDASK_RAW if "Ch" not in c]), "bidask").when(has(["open", "high", "low", "close"]), "ohlc")
    times = has(["timestamp"]) | has(["time"]) | has(["Date", "Time"]) | has(["date"])
    df = df.withColumns({"format": kind, "symbol": infer_symbol(F.col("name")), "output": base_name(F.col("name"))})
    twice = F.size("columns") > F.size(F.array_distinct("columns"))
    error = (
        F.when(F.col("header").isNull() | (F.trim("header") == ""), "the file is empty").when(twice, "a column has a name twice").when(F.col("format").isNull(), "unknown format")
        .when(~times, "no column of times").when(F.col("symbol").isNull(), f"no known symbol ({', '.join(SYMBOLS)}) in the name")
    )
    return df.withColumn("error", error)


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """The files that the manifest does not have as done with the same size and time."""
    done = manifest.where("status = 'done'").select("name", "length", "modified").distinct()
    return files.join(done, ["name", "length", "modified"], "left_anti")


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    try:
        existing(spark, f"{out}/manifest.parquet", ".parquet")
    except FileNotFoundError:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest.parquet")


def normalize_folder(spark: SparkSession, folder: str, out: str, pattern: str = "*.csv", force: bool = False) -> DataFrame:
    """Writes ``out``/ohlc and ``out``/bidask, a partition ``output=<base name>`` for each file, and gives the manifest's new lines.

    Files that are done are left alone unless ``force``; a file that changed replaces its partition.  A broken file fails alone.
    Repeated rows go, and of rows with one time the first in the file stays.
    """
    files = planned(scan(spark, folder, pattern))
    files = saved(files if force else pending(files, read_manifest(spark, out)), "files")
    good = files.where("error is null")
    counts = None
    for kind in ("ohlc", "bidask"):
        parts = []
        own = good.where(F.col("format") == kind)
        for r in own.groupBy("columns").agg(F.collect_list("path").alias("paths")).orderBy(F.array_join("columns", ",")).collect():  # a row for each header
            raw = spark.read.schema(", ".join(f"`{c}` string" for c in r["columns"])).option("header", True).csv(r["paths"])
            name = _file_name()
            raw = raw.select("*", base_name(name).alias("output"), infer_symbol(name).alias("_symbol"), F.struct(F.col("_metadata.file_block_start").alias("a"), F.monotonically_increasing_id().alias("b")).alias("_order"))
            bars = normalize_ohlc(raw, F.col("_symbol"), ("output", "_order")) if kind == "ohlc" else normalize_bidask(raw, F.col("_symbol"), ("output", "_order"))
            read = raw.groupBy("output").agg(F.count("*").alias("rows_in"))
            parts.append((bars, read))
        if not parts:
            continue
        bars, read = parts[0]
        for b, n in parts[1:]:
            bars, read = bars.unionByName(b), read.unionByName(n)
        table = saved(clean(bars, "_order", ("output", "symbol")).drop("_order"), "bars")
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("output").parquet(f"{out}/{kind}")
        n = read.join(table.groupBy("output").agg(F.count("*").alias("rows_out")), "output", "left")
        counts = n if counts is None else counts.unionByName(n)
    nothing = spark.createDataFrame([], "output string, rows_in long, rows_out long")
    joined = files.join(nothing if counts is None else counts, "output", "left")
    status = F.when(F.col("error").isNull(), "done").otherwise("failed")
    number = lambda c: F.when(F.col("error").isNull(), F.coalesce(c, F.lit(0)))
    lines = joined.select("name", "length", "modified", "format", "symbol", "output", number("rows_in").alias("rows_in"), number("rows_out").alias("rows_out"), status.alias("status"), "error")
    lines = saved(lines, "manifest")
    lines.write.mode("append").parquet(f"{out}/manifest.parquet")
    return lines


def normalization_ratio(manifest: DataFrame) -> DataFrame:
    """One row: files done and failed, rows read and written, and their ratio."""
    one = manifest.agg(F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"))
    return one.withColumn("retention", F.try_divide("rows_out", "rows_in"))
