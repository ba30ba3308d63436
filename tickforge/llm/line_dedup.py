"""Line deduplication by range partition and secondary sort.

Each line becomes a 128-bit hash of its key (the line, stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower
case).  The hashes are range-partitioned by (hash, document) and sorted by (hash, document, position), so that a very
common line is spread over many partitions.  One streaming pass over each partition decides all groups that lie inside
it with a buffer of at most ``min_docs`` documents' lines; the groups at a partition's two ends are decided from one
summary row an end (at most two for each partition, which bounds the broadcast).  What comes back are zlib-compressed
keep bitmaps, one for each document that loses a line.  No text is shuffled to find them; applying them joins each text
with its bitmap once.

Two rules: ``frequent`` drops every line whose key is found in ``min_docs`` documents or more; ``first`` keeps only
the first occurrence, by document id and position, of each key.

Defined results: a null or empty text is one empty line; the empty key is never dropped; repeated rows of a document
count once and are cut alike; other columns of the input are ignored by ``keep_bitmaps`` and kept by ``apply_bitmaps``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import once
from .common import TEXT_KEY, attach, materialize, partitions, read_table, released, with_text_key

MIN_DOCS = 10

_LINE = f"h1 long, h2 long, doc_id long, {TEXT_KEY} long, pos int"
_MARK = f"kind int, h1 long, h2 long, pid int, n long, doc_id long, {TEXT_KEY} long, pos int"
#: Kinds of mark: the line goes; it goes if its group, which other partitions hold too, is large; the summary of such a part.
GOES, OPEN, PART = 0, 1, 2


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\x0b\x0c\r").lower()  # bytes: A-Z only


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _explode_lines(batches):
    for batch in batches:
        ids, keys = batch.column("doc_id"), batch.column(TEXT_KEY)
        digests, counts, pos = [], [], []
        for text in _texts(batch.column("text")):
            before = len(pos)
            for i, line in enumerate(text.split(b"\n")):
                if key := line_key(line):
                    digests.append(xxhash.xxh3_128_digest(key))
                    pos.append(i)
            counts.append(len(pos) - before)
        row = pa.array(np.repeat(np.arange(len(counts)), counts))
        h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), ids.take(row), keys.take(row), pa.array(np.array(pos, np.int32))], names=["h1", "h2", "doc_id", TEXT_KEY, "pos"])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before; the first is True."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _decide(min_docs: int, first_only: bool):
    def run(batches):
        pid = TaskContext.get().partitionId()
        carry = None  # the rows of the last group so far that are not decided yet
        key, docs_in, head = None, 0, True  # of that group: its key, the documents before ``carry``'s end, whether it began the partition
        last_doc = None

        def marks(kind, h1, h2, n, ids, keys, pos):
            k = len(h1)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, kind, np.int32)), pa.array(h1), pa.array(h2), pa.array(np.full(k, pid, np.int32)), pa.array(np.broadcast_to(np.int64(n), k).copy()), ids, keys, pa.array(pos)],
                names=["kind", "h1", "h2", "pid", "n", "doc_id", TEXT_KEY, "pos"],
            )

        def rows_of(kind, t):
            return marks(kind, t["h1"].to_numpy(), t["h2"].to_numpy(), 0, t["doc_id"].combine_chunks(), t[TEXT_KEY].combine_chunks(), t["pos"].to_numpy())

        def part(k, n):
            return marks(PART, np.array([k[0]]), np.array([k[1]]), n, pa.array([None], pa.int64()), pa.array([0], pa.int64()), np.zeros(1, np.int32))

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            h1, h2 = t["h1"].to_numpy(), t["h2"].to_numpy()
            ids = t["doc_id"].fill_null(np.iinfo(np.int64).min).to_numpy()
            null, tk = t["doc_id"].is_null().to_numpy(), t[TEXT_KEY].to_numpy()
            new_key = _changes(h1, h2)
            new_doc = _changes(h1, h2, ids, null, tk)
            same = key == (h1[0], h2[0])
            if same and last_doc == (ids[0], null[0], tk[0]):
                new_doc[0] = False
            starts = np.flatnonzero(new_key)
            n_docs = np.add.reduceat(new_doc.astype(np.int64), starts)
            ends = np.append(starts[1:], len(h1))
            if not same and key is not None:  # the group before has ended
                if head:
                    yield part(key, docs_in)
                    if carry is not None and not first_only and docs_in < min_docs:
                        yield rows_of(OPEN, carry)
                head, carry, docs_in = False, None, 0
            if key is None:
                head = True
            base = np.zeros(len(starts), np.int64)
            base[0] = docs_in if same else 0
            total = n_docs + base
            group = np.repeat(np.arange(len(starts)), ends - starts)
            if first_only:
                goes = ~new_key
                if same:
                    goes[0] = True
                opens = np.zeros(len(h1), bool)
                if not same and head:
                    opens[0] = True
                if goes.any():
                    yield rows_of(GOES, t.filter(pa.array(goes)))
                if opens.any():
                    yield rows_of(OPEN, t.filter(pa.array(opens)))
                if len(starts) > 1 and head:
                    yield part((h1[0], h2[0]), total[0])
            else:
                large = total >= min_docs
                if large[0] and same and carry is not None:
                    yield rows_of(GOES, carry)
                    carry = None
                goes = large[group]
                if goes.any():
                    yield rows_of(GOES, t.filter(pa.array(goes)))
                if len(starts) > 1 and head:
                    yield part((h1[0], h2[0]), total[0])
                    if not large[0]:
                        if carry is not None:
                            yield rows_of(OPEN, carry)
                        yield rows_of(OPEN, t.slice(0, ends[0]))
                if len(starts) > 1:
                    carry = None
                if not large[-1]:
                    rest = t.slice(starts[-1])
                    carry = rest if carry is None else pa.concat_tables([carry, rest])
                else:
                    carry = None
            if len(starts) > 1:
                head = False
            key, docs_in, last_doc = (h1[-1], h2[-1]), int(total[-1]), (ids[-1], null[-1], tk[-1])
        if key is not None:
            yield part(key, docs_in)
            if carry is not None and not first_only:
                yield rows_of(OPEN, carry)

    return run


def _to_bitmap(batches):
    for batch in batches:
        out = []
        for positions in batch.column("dropped").to_pylist():
            keep = np.ones(max(positions) // 8 * 8 + 8, bool)
            keep[positions] = False
            out.append(zlib.compress(np.packbits(keep).tobytes(), 6))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column(TEXT_KEY), pa.array(out, pa.binary())], names=["doc_id", TEXT_KEY, "keep_bitmap"])


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, rule: str = "frequent") -> DataFrame:
    """One row for each document that loses a line: doc_id, the text's key, keep_bitmap.

    The bitmap is zlib over bits (most significant first), one a line, in whole bytes up to the last line that goes; lines beyond stay.
    """
    if rule not in ("frequent", "first"):
        raise ValueError(f"unknown rule: {rule}")
    if min_docs < 1:
        raise ValueError("min_docs must be at least 1")
    spark = docs.sparkSession
    order = ["h1", "h2", "doc_id", TEXT_KEY]
    keyed = with_text_key(docs)
    # A copy of a row must not make its own lines look like later ones; for the other rule documents are counted, and copies do no harm.
    lines = (once(keyed) if rule == "first" else keyed).mapInArrow(_explode_lines, _LINE)
    lines = lines.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order, "pos")
    marks = materialize(lines.mapInArrow(_decide(min_docs, rule == "first"), _MARK), "line-marks")
    # At most two rows for each partition: this side of the join is bounded by the number of partitions.
    groups = marks.where(F.col("kind") == PART).groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.min("pid").alias("first_pid"))
    open_ = marks.where(F.col("kind") == OPEN).join(F.broadcast(groups), ["h1", "h2"])
    open_ = open_.where(F.col("pid") > F.col("first_pid") if rule == "first" else F.col("docs") >= min_docs)
    cols = ["doc_id", TEXT_KEY, "pos"]
    dropped = marks.where(F.col("kind") == GOES).select(*cols).unionAll(open_.select(*cols))
    return dropped.groupBy("doc_id", TEXT_KEY).agg(F.collect_set("pos").alias("dropped")).mapInArrow(_to_bitmap, f"doc_id long, {TEXT_KEY} long, keep_bitmap binary")


def kept_lines(text: bytes, bitmap: bytes | None) -> tuple[list[bytes], int]:
    """The lines that stay, and the number of lines before."""
    lines = text.split(b"\n")
    if bitmap is None:
        return lines, len(lines)
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return [x for i, x in enumerate(lines) if i >= len(keep) or keep[i]], len(lines)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text (what stays), n_lines, n_dropped."""

    def run(batches):
        for batch in batches:
            texts, n, gone = [], [], []
            for text, bitmap in zip(_texts(batch.column("text")), batch.column("keep_bitmap").to_pylist(), strict=True):
                kept, lines = kept_lines(text, bitmap)
                texts.append(b"\n".join(kept).decode())
                n.append(lines)
                gone.append(lines - len(kept))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["doc_id", "text", "n_lines", "n_dropped"])

    return attach(with_text_key(docs), bitmaps, ["keep_bitmap"]).mapInArrow(released(run), "doc_id long, text string, n_lines long, n_dropped long")


def cut_documents(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with all its columns; ``text`` is what stays (null only where it was), ``n_chars``, if there is one, its length."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, bitmap in enumerate(batch.column("_keep_bitmap").to_pylist()):
                if bitmap is not None and texts[i] is not None:
                    texts[i] = b"\n".join(kept_lines(texts[i].encode(), bitmap)[0]).decode()
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns], names=columns)

    columns = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    cut = attach(docs.withColumn(TEXT_KEY, F.xxhash64("text")), bitmaps.withColumnRenamed("keep_bitmap", "_keep_bitmap"), ["_keep_bitmap"]).mapInArrow(released(run), schema)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else cut


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    cut = apply_bitmaps(docs, keep_bitmaps(docs))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT l.doc_id, l.pos, l.line, f.key IS NOT NULL AS goes FROM lines l LEFT JOIN frequent f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
