"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes that as Parquet in the shared folder and
reads it again as the next stage's input.  All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontaminate, line_dedup, near_join, packing, toxicity
from tickforge.llm.common import TEXT_KEY, clear_tables, materialize, read_table, tables, with_text_key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay.  A null or empty text gets the leak as its score; repeated rows are scored row by row; without labels, or of an empty table, all rows stay."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go; every document stays, with what is left of it (a null text stays null).  Repeated rows count once and are cut alike."""
    return line_dedup.cut_documents(docs, line_dedup.keep_bitmaps(docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays; of several with that id the one with the least hash."""
    classes = near_join.near_classes(with_text_key(docs))
    kept = classes.where("is_first").select(F.col("doc_id").alias("_id"), F.col(TEXT_KEY).alias("_key"))
    keyed = docs.withColumn(TEXT_KEY, F.xxhash64("text"))
    found = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_id"]) & (keyed[TEXT_KEY] == kept["_key"]), "left_semi")
    return found.dropDuplicates(["doc_id", TEXT_KEY]).drop(TEXT_KEY)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go, row by row; null and empty texts stay, as do all rows if either table is empty."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of what is left is packed: a null or empty text has its end id alone, repeated rows are packed once each, an empty table gives no piece."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_frequent_lines),
    ("near_join", one_of_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL can express neither the trained classifier nor the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before = tables()
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        clear_tables(before - min(k, 1), 1)  # what this stage wrote on its way, and the table that it read
    return STAGES[-1][1](spark, docs, sf_dir)
