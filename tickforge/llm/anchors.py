"""Anchored blocks: how equal windows of a whole corpus are brought together without shuffling every window.

A window is ``size`` consecutive tokens.  Its anchor is the gram (``gram`` tokens) inside it with the least hash, the
leftmost of equals; so equal windows have equal anchors at equal places.  Consecutive windows of a document with the same
anchor occurrence form a block.  Each window is in exactly one block, there is one block for about (size - gram) / 2
tokens, and windows can only be equal if their blocks' anchors are: every comparison stays inside an anchor's group.

All of it covers whole texts; nothing is sampled.  Hashes are 64-bit, and keys are pairs of them (anchor and block, or
anchor and window); equal pairs are taken as equal contents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TEXT_KEY, attach, lookup, materialize, released
from .packing import slices

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POSITION_BITS = 32  # hashes are compared by their other bits, then by place: still a function of the window alone


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


_known: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of base; those of a usual batch are kept by each process."""
    have = _known.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[:1] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 1 << 19:
            _known[base] = have
    return have[:n]


class Rolling:
    """Polynomial hashes, modulo 2**64, of any stretch of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.down = _powers(_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * _powers(_MULTIPLIER, n), out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Hash of the stretch of ``length`` at each place."""
        n = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values: running minima from both ends of stretches of that width."""
    n = len(v)
    if n < width:
        return v[:0]
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = v
    grid = full.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Blocks:
    """The blocks of several documents whose codes stand one after the other."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, size: int, gram: int):
        self.size = size
        ends = np.cumsum(counts)
        starts = ends - counts
        self.rolling = Rolling(codes)
        grams = mix(self.rolling.all(gram))
        keyed = grams >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(keyed, size - gram + 1)
        anchor = (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        windows = np.maximum(counts - size + 1, 0)
        own = np.flatnonzero(windows)
        n = windows[own]
        # Places of the windows that lie inside a document, and the document of each.
        place = np.arange(int(n.sum())) + np.repeat(starts[own] - (np.cumsum(n) - n), n)
        doc = np.repeat(own, n)
        anchor = anchor[place]
        new = np.ones(len(place), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        self.span = np.diff(np.append(first, len(place)))  # windows in the block
        self.begin = place[first]  # of the block, among all codes
        self.doc = doc[first]
        self.lo = self.begin - starts[self.doc]  # of the block, in its document
        self.back = anchor[first] - self.begin  # from the block's begin to its anchor; may be that of a window's end
        self.anchor_hash = grams[anchor[first]].view(np.int64)
        self.codes = codes

    def content_hash(self, chosen: np.ndarray) -> np.ndarray:
        """Hash of the contents of some blocks and the place of their anchor.  It is no polynomial: periodic contents are no weak case."""
        raw = memoryview(np.ascontiguousarray(self.codes)).cast("B")
        begin, length, back = self.begin[chosen] * 8, (self.span[chosen] + self.size - 1) * 8, self.back[chosen]
        digest = xxhash.xxh3_64_intdigest
        return np.array([digest(raw[a : a + n], seed) for a, n, seed in zip(begin.tolist(), length.tolist(), back.tolist(), strict=True)], np.uint64).view(np.int64)


class Sieve:
    """A bit table of fixed size that keeps, before a shuffle, almost only rows whose key is in a set; an exact join follows.

    Its size does not depend on the input, so it may be broadcast; with very many keys it lets more through, no more.
    """

    BITS = 27

    @classmethod
    def build(cls, keys: DataFrame, column: str) -> np.ndarray:
        place = f"shiftrightunsigned({column}, {64 - cls.BITS})"
        words = keys.select(F.expr(f"cast({place} >> 6 as int)").alias("w"), F.expr(f"shiftleft(1L, cast({place} & 63 as int))").alias("b"))
        got = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most 2**(BITS - 6) rows
        table = np.zeros(1 << (cls.BITS - 6), np.uint64)
        table[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
        return table

    @classmethod
    def holds(cls, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        place = keys.view(np.uint64) >> np.uint64(64 - cls.BITS)
        return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins and the last ends; null has none."""
    raw = texts.fill_null("").cast(pa.large_binary())
    if not len(raw):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    if ends[0] == ends[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(ends), np.int64)
    return np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def byte_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, ends = text_bytes(texts)
    return _BYTE_CODES[data], np.diff(ends)


_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Longer words, in bytes, are hashed one by one; there can be only few of them.
LONG_WORD = 128
_ODD = np.uint64(0x9FB21C651E98DF25)


def word_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of ``data``, eight bytes of all words at a time.  Words of one length up to eight bytes never collide."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))  # the eight bytes from each place on
    out = mix(length.astype(np.uint64) * _ODD)
    long = np.flatnonzero(length > LONG_WORD)
    own = np.flatnonzero(length <= LONG_WORD)
    at, left, h = start[own], length[own], out[own]
    while len(own):
        part = eights[at]
        short = np.flatnonzero(left < 8)
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h = mix((h ^ part) * _ODD)
        done = left <= 8
        out[own[done]] = h[done]
        more = np.flatnonzero(~done)
        own, at, left, h = own[more], at[more] + 8, left[more] - 8, h[more]
    raw = memoryview(padded)
    for i, a, n in zip(long.tolist(), start[long].tolist(), length[long].tolist(), strict=True):
        out[i] = xxhash.xxh3_64_intdigest(raw[a : a + n])
    return out


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words ``[^\\x20\\x09-\\x0D]+``, and how many each text has."""
    data, ends = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.diff(ends)
    word = ~_SPACES[data]
    # A word begins after a space or at a text's begin, and ends before a space or at a text's end.
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edge = ends[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = word[edge]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[edge - 1] = word[edge - 1]
    start = np.flatnonzero(begins)
    return word_hashes(data, start, np.flatnonzero(last) + 1 - start), np.diff(np.searchsorted(start, ends))


def once(docs: DataFrame) -> DataFrame:
    """Repeated rows of a document only once.  Texts are shuffled for that only if there are any."""
    again = docs.groupBy("doc_id", TEXT_KEY).agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return docs.dropDuplicates(["doc_id", TEXT_KEY]) if again else docs


#: A number for a block at a place, in SQL and in numpy: it only has to differ between most places.
SPOT = "block ^ shiftleft(coalesce(doc_id, 0L), 37) ^ shiftleft(cast(lo as bigint), 45)"


def spots(block: np.ndarray, doc_id: pa.Array, lo: np.ndarray) -> np.ndarray:
    return block ^ doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) << 37 ^ lo.astype(np.int64) << 45


class Anchored:
    """The blocks of a table of documents (doc_id, text, its key)."""

    def __init__(self, docs: DataFrame, codes, size: int, gram: int, stretch: int):
        self.docs = once(docs)
        self.codes, self.size, self.gram, self.stretch = codes, size, gram, stretch
        self.spark: SparkSession = docs.sparkSession

    def _each(self, emit):
        codes, size, gram, stretch = self.codes, self.size, self.gram, self.stretch

        def run(batches):
            for b in batches:
                for at, n in slices(b.column("text"), stretch):
                    part = b.slice(at, n)
                    x, counts = codes(part.column("text"))
                    if len(x) >= size:
                        yield from emit(part, x, Blocks(x, counts, size, gram))

        return run

    def repeated_anchors(self) -> DataFrame:
        """anchor, n: the anchors with two blocks or more."""

        def emit(part, x, blocks):
            yield pa.RecordBatch.from_arrays([pa.array(blocks.anchor_hash)], names=["anchor"])

        anchors = self.docs.mapInArrow(released(self._each(emit)), "anchor long")
        return materialize(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")

    def blocks_of(self, anchors: DataFrame) -> DataFrame:
        """The blocks, once for each place, of the anchors: anchor, block, doc_id, key, lo, span."""
        table = self.spark.sparkContext.broadcast(Sieve.build(anchors, "anchor"))

        def emit(part, x, blocks):
            ok = np.flatnonzero(Sieve.holds(table.value, blocks.anchor_hash))
            doc = pa.array(blocks.doc[ok])
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks.anchor_hash[ok]), pa.array(blocks.content_hash(ok)), part.column("doc_id").take(doc), part.column(TEXT_KEY).take(doc), pa.array(blocks.lo[ok].astype(np.int32)), pa.array(blocks.span[ok].astype(np.int32))],
                names=["anchor", "block", "doc_id", TEXT_KEY, "lo", "span"],
            )

        rows = self.docs.mapInArrow(released(self._each(emit)), f"anchor long, block long, doc_id long, {TEXT_KEY} long, lo int, span int")
        rows = lookup(rows, anchors.withColumn("again", F.lit(True)), ["anchor"], ["again"], "n", "inner").drop("again")
        return materialize(rows, "blocks")

    def groups(self, blocks: DataFrame) -> DataFrame:
        """anchor, block, n, doc_id, key, lo, span: equal blocks, how often, and the first place of each; and ``kinds``, the anchor's number of different blocks."""
        first = F.min(F.struct("doc_id", TEXT_KEY, "lo")).alias("first")
        g = materialize(blocks.groupBy("anchor", "block").agg(F.count("*").alias("n"), first, F.min("span").alias("span")), "groups")
        kinds = materialize(g.groupBy("anchor").agg(F.count("*").alias("kinds")), "kinds")
        g = lookup(g, kinds.withColumn("rows", F.col("kinds")), ["anchor"], ["kinds"], "rows", "inner")
        return materialize(g.select("anchor", "block", "n", "kinds", "span", "first.*"), "groups")

    def contents(self, groups: DataFrame, extra_schema: str, extra) -> DataFrame:
        """The groups' first blocks, with what ``extra(batch, codes, blocks, chosen)`` reads from the texts there."""
        # By anchor first, so that few blocks are hashed; then by block and place, of which a group has one and an anchor has many.
        near = self.spark.sparkContext.broadcast(Sieve.build(groups.select("anchor"), "anchor"))
        table = self.spark.sparkContext.broadcast(Sieve.build(groups.select(F.expr(SPOT).alias("spot")), "spot"))

        def emit(part, x, blocks):
            ok = np.flatnonzero(Sieve.holds(near.value, blocks.anchor_hash))
            block = blocks.content_hash(ok)
            kept = Sieve.holds(table.value, spots(block, part.column("doc_id").take(pa.array(blocks.doc[ok])), blocks.lo[ok]))
            ok, block = ok[kept], block[kept]
            if len(ok):
                doc = pa.array(blocks.doc[ok])
                own = extra(part, x, blocks, ok)
                yield pa.RecordBatch.from_arrays([pa.array(block), part.column("doc_id").take(doc), part.column(TEXT_KEY).take(doc), pa.array(blocks.lo[ok].astype(np.int32)), *own.values()], names=["r_block", "r_id", "r_key", "r_lo", *own])

        found = self.docs.mapInArrow(released(self._each(emit)), f"r_block long, r_id long, r_key long, r_lo int, {extra_schema}")
        same = (groups["block"] == found["r_block"]) & groups["doc_id"].eqNullSafe(found["r_id"]) & (groups[TEXT_KEY] == found["r_key"]) & (groups["lo"] == found["r_lo"])
        return groups.join(found, same).drop("r_block", "r_id", "r_key", "r_lo")


def cut_spans(docs: DataFrame, spans: DataFrame, tokens, joiner: bytes) -> DataFrame:
    """doc_id, text (what stays), n (tokens before), n_removed, n_spans; ``spans``: doc_id, key, begin, length."""
    per_doc = spans.groupBy("doc_id", TEXT_KEY).agg(F.collect_list(F.struct("begin", "length")).alias("spans"))
    per_doc = per_doc.select("doc_id", TEXT_KEY, F.col("spans.begin").alias("begins"), F.col("spans.length").alias("lengths"))

    def run(batches):
        for b in batches:
            texts, rows = [], []
            for text, begins, lengths in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("begins"), b.column("lengths"), strict=True):
                parts = tokens(text or b"")
                n = len(parts)
                gone = np.zeros(n + 1, np.int64)
                if begins.is_valid:
                    at = begins.values.to_numpy()
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + lengths.values.to_numpy(), -1)
                gone = np.cumsum(gone)[:n] > 0
                runs = int((gone[1:] & ~gone[:-1]).sum() + (n and gone[0]))
                if not runs:
                    kept = joiner.join(parts) if joiner else parts
                elif joiner:
                    kept = joiner.join([parts[i] for i in np.flatnonzero(~gone)])
                else:
                    kept = np.frombuffer(parts, np.uint8)[~gone].tobytes()
                texts.append(kept)
                rows.append((n, int(gone.sum()), runs))
            n = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.binary()), *(pa.array(n[:, i].copy()) for i in range(3))], names=["doc_id", "kept", "n", "n_removed", "n_spans"])

    return attach(docs, per_doc, ["begins", "lengths"]).mapInArrow(released(run), "doc_id long, kept binary, n long, n_removed long, n_spans long")
