"""Duplicate byte strings by column-wise construction of a collection's Burrows-Wheeler transform.

A byte goes if it is covered by a 100-byte string that also starts earlier (smaller doc_id, or earlier in the document).

1. Documents are cut into anchored blocks (see ``anchors``): overlapping segments such that each 100-byte string lies in exactly
   one block and equal strings lie in blocks of one anchor.  Blocks that occur again are settled as a whole: all places
   but the first lose all their strings.  What is left is one segment for each different surrounding of a repeated anchor.
2. These segments are dealt by anchor -- large anchors over several parts -- into collections of bounded size.  For each
   collection the transform and the common-prefix array are built column by column: in each round one more symbol, from
   the right, of every segment is inserted, and the columns (symbol, common prefix, segment, suffix length) of the round before are
   read front to back from sequential files and written to those of the next round.  No suffix is ever sorted.
3. Runs of suffixes with common prefixes of 100 or more are the classes of equal strings.  The earliest place of a class
   stays; for anchors dealt over several parts a class's earliest places are compared once more by (anchor, string hash).

The sequential files are scratch of one task: they have no name in the file system, are gone with the task, and nothing
else reads them; a lost executor's collections are simply built again from the shuffle.

Defined results: null or empty texts have no bytes; shorter texts than 100 bytes lose nothing; repeated rows of a document
count once and are cut alike; documents with one id and different texts are ordered by their texts' hash; other
columns are ignored.  What is left is bytes, which need not be valid UTF-8.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import Anchored, Rolling, _BYTE_CODES, byte_codes, cut_spans, mix, text_bytes
from .common import TEXT_KEY, lookup, materialize, partitions, read_table, released, with_text_key

LENGTH = 100
GRAM = 32
#: Segments of a collection, about; and of one anchor in one part, about.
COLLECTION = 1000
PART = 500
#: Places of the anchor in a string, in so many classes: what all strings of a class have in common must repeat.
CELLS = 12


class ColumnFiles:
    """Columns of the transform in sequential files: a round reads those of the last and writes those of the next."""

    TYPES = {"symbol": np.uint8, "common": np.uint8, "origin": np.int32}

    def __init__(self, symbol: type):
        self.types = self.TYPES | {"symbol": symbol}
        self.now = {k: tempfile.TemporaryFile() for k in self.types}
        self.next = {k: tempfile.TemporaryFile() for k in self.types}

    def read(self, column: str) -> np.ndarray:
        f = self.now[column]
        f.seek(0)
        return np.frombuffer(f.read(), self.types[column])

    def write(self, column: str, values: np.ndarray) -> None:
        f = self.next[column]
        f.seek(0)
        f.write(np.ascontiguousarray(values, self.types[column]).data)
        f.truncate()

    def turn(self) -> None:
        self.now, self.next = self.next, self.now

    def close(self) -> None:
        for f in [*self.now.values(), *self.next.values()]:
            f.close()


def collection_bwt(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """symbol (0: a segment's begin, else byte + 1), common prefix with the suffix before (at most 255), segment and suffix length of
    each suffix, empty ones too, in sorted order.  Ends of segments are smaller than any byte and ordered as the segments are."""
    k = len(segments)
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(segments), np.uint8)
    # Symbols are numbered as they occur: those of a collection of text fit into a byte.
    used = np.flatnonzero(np.bincount(raw, minlength=256))
    code = np.zeros(256, np.uint16)
    code[used] = np.arange(1, len(used) + 1)
    files = ColumnFiles(np.uint8 if len(used) < 256 else np.uint16)
    # Before each segment stands a 0, so that a suffix that begins at ``origin`` is preceded by data[origin - 1].
    data = np.zeros(len(raw) + k, files.types["symbol"])
    begins = ends - sizes + np.arange(k)
    inside = np.ones(len(data), bool)
    inside[begins] = False
    data[inside] = code[raw]
    try:
        origin = begins + sizes + 1  # of the empty suffixes
        for column, values in (("symbol", data[origin - 1]), ("common", np.zeros(k)), ("origin", origin)):
            files.write(column, values)
        files.turn()
        active = np.flatnonzero(data[origin - 1])  # places of the suffixes inserted last whose segments go on, in order
        while len(active):
            symbol, common = files.read("symbol"), files.read("common")
            n = len(symbol)
            order = np.argsort(symbol, kind="stable")
            empty = n - int(np.count_nonzero(symbol))
            rank = np.empty(n, np.int32)
            rank[order] = np.arange(n, dtype=np.int32)
            # A symbol's suffix stands where its rank among all symbols says, after the empty suffixes.
            by_rank = rank[active]
            turn = np.argsort(by_rank)
            active, by_rank = active[turn], by_rank[turn].astype(np.int64)
            place = k + by_rank - empty
            total = k + n - empty
            own_symbol = symbol[active]

            def since(left, right):
                """1 + the least common prefix after ``left`` up to ``right``, for pairs of places with equal symbols."""
                stretch = np.stack([left + 1, right + 1], 1).ravel()
                return np.minimum(np.minimum.reduceat(closed, stretch)[::2], 254) + 1

            closed = np.append(common, np.uint8(0))  # one more, so that a stretch may end at the end
            before = order[np.maximum(by_rank - 1, 0)]
            has_before = (by_rank > empty) & (symbol[before] == own_symbol)
            own = np.zeros(len(active), np.uint8)
            if has_before.any():
                own[has_before] = since(before[has_before], active[has_before])
            after = order[np.minimum(by_rank + 1, n - 1)]
            has_after = (by_rank + 1 < n) & (symbol[after] == own_symbol)
            # Where each row of the next columns comes from: the old rows, and the new ones after them.
            new = np.zeros(total, bool)
            new[place] = True
            source = np.cumsum(~new, dtype=np.int32)
            source -= 1
            source[place] = n + np.arange(len(place), dtype=np.int32)
            origin = files.read("origin")
            ahead = origin[active] - 1
            following = data[ahead - 1]
            files.write("symbol", np.concatenate([symbol, following]).take(source))
            merged = np.concatenate([common, own]).take(source)
            if has_after.any():
                merged[place[has_after] + 1] = since(active[has_after], after[has_after])
            files.write("common", merged)
            files.write("origin", np.concatenate([origin, ahead]).take(source))
            files.turn()
            active = place[following > 0]
        symbol, common, origin = (files.read(c) for c in files.types)
        segment = np.searchsorted(begins, origin, "left") - 1
        return np.append(0, used + 1)[symbol], common.copy(), segment, begins[segment] + sizes[segment] + 1 - origin
    finally:
        files.close()


def equal_strings(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, segment and start of every string of ``length`` bytes in the segments, class by class."""
    _, common, segment, suffix = collection_bwt(segments)
    # Between two suffixes that share ``length`` bytes there is no suffix that does not.
    long = suffix >= length
    group = np.cumsum(common < length)[long]
    seg = segment[long]
    start = np.array([len(s) for s in segments], np.int64)[seg] - suffix[long]
    _, group = np.unique(group, return_inverse=True)
    return group, seg, start


def promising(content: list[bytes], anchor: np.ndarray, back: np.ndarray, whole: np.ndarray, length: int, gram: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments that may share a string with another of their anchor, and the stretch [begin, end) of each that may.

    A string with its anchor x bytes from its begin, lo <= x <= hi, holds the lo bytes before the anchor, the anchor, and
    length - gram - hi bytes after it; of equal strings these are equal too.  Segments in ``whole`` stay as they are.
    """
    sizes = np.array([len(c) for c in content], np.int64)
    at = np.cumsum(sizes) - sizes
    rolling = Rolling(_BYTE_CODES[np.frombuffer(b"".join(content), np.uint8)])
    most = back  # the anchor's places in a segment's strings: from ``least`` to ``most``
    least = back - (sizes - length)
    room = length - gram
    low, high = np.full(len(sizes), room + 1), np.full(len(sizes), -1)
    edges = np.arange(cells + 1) * (room + 1) // cells
    for lo, hi in zip(edges[:-1].tolist(), (edges[1:] - 1).tolist(), strict=True):
        own = np.flatnonzero(np.maximum(least, lo) <= np.minimum(most, hi))
        h = rolling.at(at[own] + back[own] - lo, lo + gram + room - hi)
        _, index, n = np.unique(np.stack([anchor[own], h.view(np.int64)], 1).view("i8,i8").ravel(), return_inverse=True, return_counts=True)
        again = own[n[index] > 1]
        low[again] = np.minimum(low[again], lo)
        high[again] = hi
    chosen = np.flatnonzero((high >= 0) | whole)
    begin = np.where(whole, 0, back - np.minimum(high, most))[chosen]
    end = np.where(whole, sizes, back - np.maximum(low, least) + length)[chosen]
    return chosen, begin, end


def _collections(length: int, gram: int, size: int):
    """For each partition, sorted by anchor and part: strings that start earlier too, and first places of anchors in several parts."""

    def solve(rows: pa.Table):
        content = rows["content"].to_pylist()
        chosen, begin, end = promising(content, rows["anchor"].to_numpy(), rows["back"].to_numpy().astype(np.int64), rows["parts"].to_numpy() > 1, length, gram)
        if not len(chosen):
            return None
        segments = [content[i][a:b] for i, a, b in zip(chosen.tolist(), begin.tolist(), end.tolist(), strict=True)]
        rows = rows.drop_columns("content").take(pa.array(chosen))
        group, seg, start = equal_strings(segments, length)
        null = rows["doc_id"].is_null().to_numpy()
        ids, keys, lo = rows["doc_id"].fill_null(0).to_numpy(), rows[TEXT_KEY].to_numpy(), rows["lo"].to_numpy() + begin
        begin = lo[seg] + start
        order = np.lexsort((begin, keys[seg], ids[seg], ~null[seg], group))
        group, seg, start, begin = group[order], seg[order], start[order], begin[order]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        # Strings that start earlier too, as stretches of consecutive ones; and the first ones of anchors in several parts.
        later = np.flatnonzero(~first)
        later = later[np.lexsort((begin[later], seg[later]))]
        s, p = seg[later], begin[later]
        new = np.ones(len(later), bool)
        new[1:] = (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1)
        counts = np.diff(np.append(np.flatnonzero(new), len(later)))
        open_ = np.flatnonzero(first & (rows["parts"].to_numpy()[seg] > 1))
        chosen = np.append(later[new], open_)
        if not len(chosen):
            return None
        h = np.zeros(len(chosen), np.int64)
        if len(open_):
            data = np.frombuffer(b"".join(segments), np.uint8)
            at = np.cumsum([0, *map(len, segments)])
            h[len(chosen) - len(open_) :] = mix(Rolling(_BYTE_CODES[data]).at(at[seg[open_]] + start[open_], length)).view(np.int64)
        lengths = np.append(length + counts - 1, np.full(len(open_), length)).astype(np.int64)
        is_open = np.arange(len(chosen)) >= len(chosen) - len(open_)
        own = pa.array(seg[chosen])
        return pa.RecordBatch.from_arrays(
            [rows["anchor"].combine_chunks().take(own), rows["doc_id"].combine_chunks().take(own), rows[TEXT_KEY].combine_chunks().take(own), pa.array(begin[chosen]), pa.array(lengths), pa.array(is_open), pa.array(h)],
            names=["anchor", "doc_id", TEXT_KEY, "begin", "length", "open", "string"],
        )

    def run(batches):
        held, n = [], 0

        def ready(table, last):
            """Whole (anchor, part) groups, and the rest."""
            a, p = table["anchor"].to_numpy(), table["part"].to_numpy()
            cuts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (p[1:] != p[:-1])))
            begin = 0
            for c in cuts:
                if c - begin >= size:
                    yield table.slice(begin, c - begin)
                    begin = int(c)
            if last:
                yield table.slice(begin)
            else:
                held.append(table.slice(begin))

        for b in batches:
            held.append(pa.Table.from_batches([b]))
            n = sum(t.num_rows for t in held)
            if n >= 2 * size:
                table, held = pa.concat_tables(held), []
                for c in ready(table, False):
                    if (out := solve(c)) is not None:
                        yield out
        if held:
            for c in ready(pa.concat_tables(held), True):
                if c.num_rows and (out := solve(c)) is not None:
                    yield out

    return run


def later_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, collection: int = COLLECTION, part: int = PART) -> DataFrame:
    """doc_id, key, begin, length (bytes): stretches made of strings that also start earlier."""
    if not gram < length <= 254:
        raise ValueError("strings have more bytes than an anchor and 254 at most: common prefixes are stored in a byte")
    spark = docs.sparkSession
    anchored = Anchored(docs, byte_codes, length, gram, 1 << 18)
    blocks = anchored.blocks_of(anchored.repeated_anchors())
    groups = anchored.groups(blocks)
    again = groups.where("n > 1").select("anchor", "block", "n", F.col("doc_id").alias("f_id"), F.col(TEXT_KEY).alias("f_key"), F.col("lo").alias("f_lo"))
    settled = lookup(blocks, again, ["anchor", "block"], ["f_id", "f_key", "f_lo"], "n", "inner")
    settled = settled.where(~(F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col(TEXT_KEY) == F.col("f_key")) & (F.col("lo") == F.col("f_lo"))))
    settled = settled.select("doc_id", TEXT_KEY, F.col("lo").cast("long").alias("begin"), (F.col("span") + length - 1).cast("long").alias("length"))

    def content(batch, x, b, ok):
        data, _ = text_bytes(batch.column("text"))
        return {"back": pa.array(b.back[ok].astype(np.int32)), "content": pa.array([data[i : i + n].tobytes() for i, n in zip(b.begin[ok].tolist(), (b.span[ok] + length - 1).tolist(), strict=True)], pa.binary())}

    rest = anchored.contents(groups.where("kinds > 1"), "back int, content binary", content)
    parts = F.ceil(F.col("kinds") / part)
    rest = rest.select("anchor", "doc_id", TEXT_KEY, "lo", "back", "content", parts.cast("int").alias("parts"), F.pmod(F.col("block"), parts).cast("int").alias("part"))
    rest = rest.repartition(partitions(spark), "anchor", "part").sortWithinPartitions("anchor", "part")
    found = rest.mapInArrow(released(_collections(length, gram, collection)), f"anchor long, doc_id long, {TEXT_KEY} long, begin long, length long, open boolean, string long")
    found = materialize(found, "strings")
    place = F.struct("doc_id", TEXT_KEY, "begin")
    open_ = found.where("open")
    firsts = open_.groupBy("anchor", "string").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = materialize(firsts.select("anchor", "string", "n", F.col("first.doc_id").alias("f_id"), F.col(f"first.{TEXT_KEY}").alias("f_key"), F.col("first.begin").alias("f_begin")), "firsts")
    later = lookup(open_, firsts, ["anchor", "string"], ["f_id", "f_key", "f_begin"], "n", "inner")
    later = later.where(~(F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col(TEXT_KEY) == F.col("f_key")) & (F.col("begin") == F.col("f_begin"))))
    cols = ["doc_id", TEXT_KEY, "begin", "length"]
    return settled.unionAll(found.where(~F.col("open")).select(*cols)).unionAll(later.select(*cols))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_text_key(read_table(spark, sf_dir, "documents"))
    cut = cut_spans(docs, later_spans(docs), bytes, b"")
    return cut.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
