"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be found with up to k = floor(rate * m) edits.  Cut into k + 1 pieces, at least one
piece of any such occurrence is untouched, so exact hits of pieces -- one pass of a string automaton over each whole
text -- find all candidates.  The same principle holds for halves: of two neighbouring stretches of a and b pieces with a + b - 1 edits
in all, one has fewer edits than pieces.  So a hit counts only if the two pieces around it, then the four, and so on up to the whole item
are there with fewer edits than pieces, each step verified in the hit's surrounding with Myers' bit-parallel distance, the
stretch as one integer; most chance hits end at the first step.  Texts and items are compared in lower case with stretches of white space as one space.

Items are broadcast in blocks of about ``BLOCK_BYTES``; a larger benchmark takes several passes.

Items of fewer than ``min_chars`` characters (after normalisation) have the same budget of edits, but an occurrence must lie between word bounds, since short
strings meet by chance inside longer words: around a piece's hit, each start at a bound is compared with all ends at bounds.

Defined results: null or empty texts and items match nothing; of occurrences with equal distances the one that ends first is given; items with one text and different ids each
get a row, repeated items one; repeated rows of a document are matched row by row; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, released

#: Edits for each character of an item.
RATE = 0.1
#: Shorter items are found between word bounds only.
MIN_CHARS = 40
BLOCK_BYTES = 16 << 20


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(pattern: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length, with their places."""
    n, k = len(pattern), errors + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(a, pattern[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


class Myers:
    """Least edit distance of a pattern to any substring of a text."""

    def __init__(self, pattern: str):
        self.length = len(pattern)
        self.places: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.places[c] = self.places.get(c, 0) | 1 << i

    def search(self, text: str) -> tuple[int, int]:
        """(distance, end of the first best substring)."""
        m = self.length
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score = full, 0, m
        best, end = m, 0
        get = self.places.get
        for i, c in enumerate(text):
            eq = get(c, 0)
            vertical = eq | minus
            eq = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (full & ~(eq | plus))
            down = plus & eq
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = up << 1 & full
            down = down << 1 & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
            if score < best:
                best, end = score, i + 1
        return best, end

    def prefixes(self, text: str):
        """The distance of the pattern to each non-empty prefix of a text."""
        m = self.length
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score = full, 0, m
        for c in text:
            eq = self.places.get(c, 0)
            vertical = eq | minus
            eq = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (full & ~(eq | plus))
            down = plus & eq
            score += bool(up & top) - bool(down & top)
            up = (up << 1 | 1) & full  # a prefix is one longer
            plus = (down << 1 & full) | (full & ~(vertical | up))
            minus = up & vertical
            yield score


class Stretch:
    """Some neighbouring pieces of an item: one piece, or two halves."""

    __slots__ = ("at", "end", "errors", "parent", "text", "_myers")

    def __init__(self, pattern: str, parts: list[tuple[int, str]], parent: Stretch | None):
        self.at, self.end = parts[0][0], parts[-1][0] + len(parts[-1][1])
        self.errors, self.parent = len(parts) - 1, parent
        self.text, self._myers = pattern[self.at : self.end], None

    def distance(self, text: str) -> tuple[int, int]:
        if self._myers is None:
            self._myers = Myers(self.text)
        return self._myers.search(text)


def leaves(pattern: str, parts: list[tuple[int, str]], parent: Stretch | None = None) -> list[Stretch]:
    """The pieces of a pattern, each knowing the stretch that it is half of."""
    own = Stretch(pattern, parts, parent)
    if len(parts) == 1:
        return [own]
    half = len(parts) // 2
    return leaves(pattern, parts[:half], own) + leaves(pattern, parts[half:], own)


class Matcher:
    """Items, their pieces in one automaton, and their verifiers."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE, min_chars: int = MIN_CHARS):
        import ahocorasick

        self.items, self.short, found = [], [], {}
        for item_id, text in items:
            pattern = normalise(text)
            if not pattern:
                continue
            errors = int(rate * len(pattern))
            self.short.append((Myers(pattern), errors) if len(pattern) < min_chars else None)
            for leaf in leaves(pattern, pieces(pattern, errors)):
                found.setdefault(leaf.text, []).append((len(self.items), leaf))
            self.items.append(item_id)
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def _between_bounds(self, i: int, text: str, begin: int) -> tuple[int, int] | None:
        """(distance, end) of the least occurrence of a short item that begins near ``begin``, if there is one within its budget."""
        myers, errors = self.short[i]
        found = []
        for a in range(max(0, begin - errors), begin + errors + 1):
            if not text[a - 1 : a].isalnum():
                ends = enumerate(myers.prefixes(text[a : a + myers.length + errors]), a + 1)
                found += [(d, e) for e, d in ends if d <= errors and not text[e : e + 1].isalnum()]
        return min(found, default=None)

    def match(self, text: str) -> list[tuple[int | None, int, int]]:
        """(item_id, distance, end in the normalised text) of each item found, with its least distance."""
        if not self.items:
            return []
        best: dict[int, tuple[int, int]] = {}
        seen: set[tuple[int, Stretch | None, int]] = set()
        for end, (n, where) in self.automaton.iter(text):
            for i, leaf in where:
                begin = end + 1 - n - leaf.at  # of the item, without edits
                if self.short[i]:
                    if (i, None, begin) not in seen:
                        seen.add((i, None, begin))
                        last = self._between_bounds(i, text, begin)
                        if last:
                            best[i] = min(best.get(i, last), last)
                    continue
                node, last = leaf.parent, (0, end + 1)
                while node is not None:
                    # Edits of a stretch that holds the hit can move its ends by so many places at most.
                    a, b = max(0, begin + node.at - node.errors), begin + node.end + node.errors
                    if node.parent is None:  # the whole item, once for a place
                        if (i, node, begin) in seen:
                            break
                        seen.add((i, node, begin))
                    d, e = node.distance(text[a:b])
                    if d > node.errors:
                        break
                    last, node = (d, a + e), node.parent
                else:
                    best[i] = min(best.get(i, last), last)
        return [(self.items[i], *x) for i, x in best.items()]


def _item_blocks(benchmark: DataFrame) -> list:
    """Broadcasts of the items, each of about BLOCK_BYTES of text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull()).dropDuplicates()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    return [spark.sparkContext.broadcast([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]) for k in range(n)]


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, item_id, distance, end: each item found in a document, once, with its least distance."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance int, end long"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _item_blocks(benchmark):

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate, min_chars)
            for b in batches:
                rows = [(doc, *m) for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) for m in matcher.match(normalise(text))]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["doc_id", "item_id", "distance", "end"])

        out = out.unionAll(docs.mapInArrow(released(run), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no item is found."""
    for shared in _item_blocks(benchmark):

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate, min_chars)
            for b in batches:
                yield b.filter(pa.array([not matcher.match(normalise(t)) for t in b.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(released(run), docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
