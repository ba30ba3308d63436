"""Tables that a plan writes for itself, to be read more than once."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_own: list[str] = []


def folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a local one only where it is unset, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="tickforge-"))
        path = _own[0]
    return path.rstrip("/")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, removed when the session's Python ends: what reads it twice computes it once."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def clear() -> None:
    while _written:
        spark, path = _written.pop()
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone
            return
