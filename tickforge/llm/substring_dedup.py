"""Substring deduplication by level-wise doubling over words.

A window is 35 consecutive words.  The levels are lengths: 9 words, then twice as many, 18, and at last 35.  At the first level only the
windows' anchors (see ``anchors``) are counted over the whole corpus; what does not repeat there is gone for good.  Blocks
around a repeated anchor are counted as a whole: a block that occurs again settles all its windows.  The rest -- one
block for each different surrounding of an anchor -- goes up the levels: sub-windows of one length that repeat, at the same place
relative to their anchor, are joined in pairs to sub-windows of twice the length, and only pairs whose halves both
repeat are counted, until the window's full length is reached or no candidate survives.  Every word covered by a
repeated window goes, in all places.

Anchors with up to ``WIDE`` different surroundings go through the levels inside one task.  For the others each level is a
partial aggregate before a shuffle, so a passage that very many documents share costs each task one row.

Defined results: null or empty texts have no words; texts of fewer than 35 words lose nothing; repeated rows of a
document count once and are cut alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import Anchored, cut_spans, mix, word_codes
from .common import TEXT_KEY, lookup, materialize, partitions, read_table, released, with_text_key

WINDOW = 35
BASE = 9
#: Different surroundings of an anchor up to which one task takes them all.
WIDE = 1000


def levels(window: int, base: int) -> list[int]:
    """Lengths after the base: doubled, the last cut to the window."""
    out, n = [], base
    while n < window:
        n = min(2 * n, window)
        out.append(n)
    return out


def _again(rows: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """Keys that occur twice or more, and how often."""
    return materialize(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").withColumn("again", F.lit(True)), tag)


def _repeats(*keys: np.ndarray) -> np.ndarray:
    """True for rows whose key occurs again."""
    _, index, n = np.unique(np.stack(keys, 1).view([("", k.dtype) for k in keys]).ravel(), return_inverse=True, return_counts=True)
    return n[index] > 1


def _doubling(window: int, steps: list[int], held_rows: int):
    """The levels for whole anchors that fit into a task: rows sorted by anchor -> windows that repeat."""

    def solve(t: pa.Table):
        span = t["span"].to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(span)), span)
        p = np.arange(len(row)) - np.repeat(np.cumsum(span) - span, span)
        anchor, back = t["anchor"].to_numpy(), t["back"].to_numpy().astype(np.int64)

        def hashes(n, at):
            column = t[f"h{n}"].combine_chunks()
            return column.values.to_numpy()[column.offsets.to_numpy()[row] + at]

        for n in steps:
            for end in (0, window - n) if n < window else (0,):
                ok = _repeats(anchor[row], p - back[row], hashes(n, p + end))
                row, p = row[ok], p[ok]
                if not len(row):
                    return None
        new = t["times"].to_numpy()[row] == 1
        row, p = row[new], p[new]
        at = pa.array(row)
        return pa.RecordBatch.from_arrays([t["doc_id"].combine_chunks().take(at), t[TEXT_KEY].combine_chunks().take(at), pa.array((t["lo"].to_numpy()[row] + p).astype(np.int32)), pa.array(np.full(len(p), window, np.int32))], names=["doc_id", TEXT_KEY, "begin", "length"])

    def run(batches):
        held = []
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            if sum(x.num_rows for x in held) < held_rows:
                continue
            t = pa.concat_tables(held)
            anchor = t["anchor"].to_numpy()
            cut = len(anchor) - int((anchor[::-1] == anchor[-1]).argmin()) if anchor[0] != anchor[-1] else 0
            held = [t.slice(cut)]
            if cut and (out := solve(t.slice(0, cut))) is not None:
                yield out
        if held and sum(x.num_rows for x in held) and (out := solve(pa.concat_tables(held))) is not None:
            yield out

    return run


def _doubling_wide(rest: DataFrame, window: int, steps: list[int]) -> DataFrame:
    """The levels for anchors with very many surroundings: each count is a partial aggregate before a shuffle."""
    ends = {f"h{n}_{i}": f"h{n}[p + {i * (window - n)}]" for n in steps[:-1] for i in (0, 1)} | {"h": f"h{window}[p]"}
    struct = ", ".join(f"'{k}', {v}" for k, v in ends.items())
    live = rest.selectExpr("anchor", "times", "doc_id", TEXT_KEY, "lo", "back", f"inline(transform(sequence(0, span - 1), p -> named_struct('p', p, {struct})))")
    live = live.withColumn("place", F.col("p") - F.col("back"))
    for column in ends:
        live = materialize(live, f"live-{column}")
        again = _again(live, ["anchor", "place", column], f"again-{column}")
        live = lookup(live, again, ["anchor", "place", column], ["again"], "n", "inner").drop("again")
    return live.where("times = 1").select("doc_id", TEXT_KEY, (F.col("lo") + F.col("p")).alias("begin"), F.lit(window).alias("length"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, base: int = BASE, wide: int = WIDE) -> DataFrame:
    """doc_id, key, begin, length (in words): stretches made of windows that occur anywhere else."""
    anchored = Anchored(docs, word_codes, window, base, 1 << 20)
    blocks = anchored.blocks_of(anchored.repeated_anchors())
    groups = anchored.groups(blocks)
    # Blocks that occur again: all of their windows do.
    whole = groups.where("n > 1").select("anchor", "block", "n", F.lit(True).alias("again"))
    settled = lookup(blocks, whole, ["anchor", "block"], ["again"], "n", "inner")
    settled = settled.select("doc_id", TEXT_KEY, F.col("lo").alias("begin"), (F.col("span") + window - 1).alias("length"))
    steps = levels(window, base)

    def hashes(part, x, b, ok):
        out = {"back": pa.array(b.back[ok].astype(np.int32))}
        for n in steps:
            every = mix(b.rolling.all(n)).view(np.int64)
            counts = b.span[ok] + window - n
            ends = np.cumsum(counts)
            place = np.arange(int(counts.sum())) + np.repeat(b.begin[ok] - (ends - counts), counts)
            out[f"h{n}"] = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), every[place])
        return out

    rest = anchored.contents(groups.where("kinds > 1"), ", ".join(["back int", *(f"h{n} array<long>" for n in steps)]), hashes)
    rest = materialize(rest.withColumnRenamed("n", "times"), "candidates")
    near = rest.where(F.col("kinds") <= wide).repartition(partitions(docs.sparkSession), "anchor").sortWithinPartitions("anchor")
    found = near.mapInArrow(released(_doubling(window, steps, 10_000)), f"doc_id long, {TEXT_KEY} long, begin int, length int")
    if (far := rest.where(F.col("kinds") > wide)).limit(1).count():
        found = found.unionAll(_doubling_wide(far, window, steps))
    return settled.unionAll(found)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_text_key(read_table(spark, sf_dir, "documents"))
    cut = cut_spans(docs, repeated_spans(docs), bytes.split, b" ")
    return cut.select("doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, p, md5_number(array_to_string(words[p:p + 34], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS p FROM w WHERE len(words) >= 35)
), again AS (
  SELECT h FROM win GROUP BY h HAVING count(*) > 1
), starts AS (
  SELECT win.doc_id, list(win.p) AS ps FROM win JOIN again USING (h) GROUP BY win.doc_id
), each AS (
  SELECT doc_id, i, words[i] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM (SELECT doc_id, unnest(ps) AS p FROM starts)
), kept AS (
  SELECT e.doc_id, count(*) FILTER (WHERE g.i IS NOT NULL) AS n_removed, string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
