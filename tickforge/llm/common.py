"""Helpers that the operators of this subpackage share.

Identity of a document.  Operators that come back to a document after a shuffle
know it by ``(doc_id, hash of its text)``.  Repeated rows (same id, same text)
are one document and all get its result; rows with one id and different texts
are different documents.  A null id is an id like any other.
"""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name of the column that holds the 64-bit hash of a document's text.
TEXT_KEY = "_text_key"


_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where it is unset (tests on one machine)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not _own_dir:
            _own_dir.append("file://" + tempfile.mkdtemp(prefix="tickforge-"))
        path = _own_dir[0]
    return path.rstrip("/")


_written: list[tuple[SparkSession, str]] = []


def new_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; it is removed when the session's Python ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here, and a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tables() -> int:
    """How many intermediate tables there are."""
    return len(_written)


def clear_tables(since: int = 0, last: int = 0) -> None:
    """Remove the intermediate tables from number ``since`` on, but for the ``last`` ones; only for results that are no longer read."""
    while len(_written) > since + last:
        spark, path = _written.pop(since)
        try:
            remove_path(spark, path)
        except Exception:  # the session is gone, and its folder with it
            return


atexit.register(clear_tables)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_text_key(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the text's hash; other columns go, so that no name of theirs can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(TEXT_KEY, F.xxhash64("text"))


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left[TEXT_KEY] == right[TEXT_KEY])


def attach(docs: DataFrame, per_document: DataFrame, cols: list[str]) -> DataFrame:
    """Left join of what was computed for a document (one row for each) to ``docs`` (see with_text_key)."""
    right = per_document.select(F.col("doc_id").alias("_r_id"), F.col(TEXT_KEY).alias("_r_key"), *cols)
    return docs.join(right, docs["doc_id"].eqNullSafe(right["_r_id"]) & (docs[TEXT_KEY] == right["_r_key"]), "left").drop("_r_id", "_r_key")


#: A key is hot if it holds more than one row in HOT_SHARE, so there are at most HOT_SHARE hot keys, whatever the input.
HOT_SHARE = 1000


def lookup(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str], n: str, how: str = "left") -> DataFrame:
    """Join ``left`` (many rows a key) with ``right`` (one row a key, ``n`` = rows of that key in ``left``).

    The hot keys of ``right`` -- by the definition above at most HOT_SHARE rows, which is the proven bound of this
    broadcast -- are sent to all tasks.  The shuffle join for the rest is on the keys and a salt: 0 on the right and for
    cold rows, a hash of the whole row (the same if a lost task runs again) for rows that are answered already.  It comes
    from the rows, so that it stays part of the exchange's key and the rows of a hot key are dealt over all partitions.  ``right`` should be a written
    table, since it is read three times.
    """
    total, most = right.agg(F.sum(n), F.max(n)).first()
    limit = max((total or 0) // HOT_SHARE, 1000)
    of = lambda df, p: df.select(*[F.col(k).alias(f"{p}{k}") for k in keys], *[F.col(c).alias(f"{p}{c}") for c in cols], F.lit(True).alias(f"{p}hit"), F.col(n).alias(f"{p}_size"))
    if (most or 0) <= limit:  # no hot key: a plain join
        out = left.join(of(right, "_c_"), [F.col(k) == F.col(f"_c_{k}") for k in keys], "inner" if how == "inner" else "left")
        return out.select(*left.columns, *[F.col(f"_c_{c}").alias(c) for c in cols])
    # ``_c__size`` is at least 0, which the optimizer does not know: the salt cannot be folded into a constant.
    cold = of(right.where(F.col(n) <= limit), "_c_").withColumn("_c_salt", F.least(F.col("_c__size"), F.lit(0)).cast("int"))
    hot = of(right.where(F.col(n) > limit), "_h_")
    out = left.join(F.broadcast(hot), [F.col(k) == F.col(f"_h_{k}") for k in keys], "left")
    out = out.withColumn("_salt", F.when(F.col("_h_hit"), 1 + F.pmod(F.xxhash64(*left.columns), F.lit(4096)).cast("int")).otherwise(F.lit(0)))
    out = out.join(cold, [*[F.col(k) == F.col(f"_c_{k}") for k in keys], F.col("_salt") == F.col("_c_salt")], "left")
    if how == "inner":
        out = out.where(F.col("_h_hit") | F.col("_c_hit"))
    return out.select(*left.columns, *[F.coalesce(f"_h_{c}", f"_c_{c}").alias(c) for c in cols])


def released(run):
    """A task's generator that gives memory back to the system when it ends: Spark reuses its Python workers for later stages."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library: nothing to do
                pass

    return wrapped
