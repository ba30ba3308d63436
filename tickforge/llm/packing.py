"""Packing documents into training sequences by cutting-stock column generation.

1. Each task tokenizes its documents: white-space words are counted once per batch and each distinct one goes through
   the tokenizer's own model once.  A document (ids and an end id) is cut into full sequences and one remainder.
2. The pieces are range-partitioned by (length, document, start) and sorted, which ranks the pieces of each length
   although one length may hold most rows; a partition's part of a length is counted, and those counts -- at most one
   for each partition and length -- are all that reaches the driver.
3. On the histogram of lengths (at most ``size`` bins, whatever the input) a linear program over patterns is solved by
   column generation: revised simplex from a greedy start, and an exact-sum knapsack dynamic program prices new patterns
   and proves when none is needed.  A pattern
   costs what its sequence takes up: its own total if that is a power of two, else ``size``.
4. Patterns are rounded down, then up where the pieces last; what is left is filled greedily.  The result is a table of rank ranges for each
   length, by which tasks look up the sequence and the offset of each piece.

Defined results: a null or empty text has the end id alone; repeated rows are packed once for each row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import gc
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, partitions, read_table, released

SIZE = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

#: Words whose normal form and pieces the standard library gives as the tokenizer does: printable ASCII, Latin letters.
_PLAIN = re.compile(r"(?!.*<\|)[!-~À-įı-ňŊ-ž]+")
#: The pre-tokenizer's pattern, for plain words.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class WordTokenizer:
    """Ids of texts by a word-end BPE whose pre-tokenizer never joins across white space, so that words can be cached."""

    def __init__(self, path: str, keep: int = 150_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.keep = self.whole.model, keep
        self.letters = _byte_letters()
        self.known: dict[str, list[int]] = {}  # pieces
        self.words: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        if (ids := self.known.get(piece)) is None:
            form = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            ids = self.known[piece] = [t.id for t in self.model.tokenize(form)]
        return ids

    def word(self, word: str) -> list[int]:
        if (ids := self.words.get(word)) is None:
            ids = self.words[word] = self._word(word)
        return ids

    def _word(self, word: str) -> list[int]:
        if word and word.isascii():  # most words are letters, or letters and a mark: then the pieces are plain
            if word.isalpha():
                return self._piece(word.lower())
            body, mark = word[:-1], word[-1]
            if body.isalpha() and not mark.isalnum() and mark.isprintable():
                return self._piece(body.lower()) + self._piece(mark)
        if not _PLAIN.fullmatch(word):
            return self.whole.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for piece in _PIECE.findall(word.lower()):
            out += self._piece(piece)
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        words = pc.ascii_split_whitespace(texts)
        of = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        have = self.words.get
        each = [have(w) or self.word(w) for w in coded.dictionary.to_pylist()]
        for cache in (self.known, self.words):
            if len(cache) > self.keep:  # a batch has at most as many words as bytes, so this bounds the caches
                cache.clear()
        n = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.fromiter(chain.from_iterable(each), np.uint32, int(n.sum()))
        at = np.cumsum(n) - n
        index = coded.indices.to_numpy(zero_copy_only=False)
        reps = n[index]
        ends = np.cumsum(reps)
        ids = flat[np.arange(int(reps.sum())) + np.repeat(at[index] - (ends - reps), reps)]
        per_text = np.diff(np.append(0, ends)[np.append(0, np.cumsum(of))])
        return ids, per_text


def slices(texts: pa.Array, most_bytes: int = 2 << 20):
    """Stretches (start, length) of a column of texts with about so many bytes each."""
    total = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(total):
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + most_bytes, "right")))
        yield start, end - start
        start = end


def pieces(docs: DataFrame, vocabulary: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full sequences from the front, then the remainder."""

    def run(batches):
        import public_tokenizers

        collects = gc.isenabled()
        gc.disable()  # the caches are lists of numbers, a million and more: nothing refers back, and looking for cycles takes a fifth of the time
        try:
            tokenizer = WordTokenizer(vocabulary or public_tokenizers.path(VOCABULARY))
            for b in batches:
                for at, n in slices(b.column("text")):
                    ids, counts = tokenizer.batch(b.column("text").slice(at, n).fill_null(""))
                    rows = {k: [] for k in ("row", "start", "length", "ids_crc32", "doc_tokens")}
                    begin = 0
                    for i, k in enumerate(counts.tolist()):
                        own = np.append(ids[begin : begin + k], end_id).astype("<u4")
                        begin += k
                        for s in range(0, k + 1, size):
                            part = own[s : s + size]
                            for name, v in zip(rows, (at + i, s, len(part), zlib.crc32(part), k + 1), strict=True):
                                rows[name].append(v)
                    out = pa.RecordBatch.from_pydict(rows, schema=pa.schema([(k, pa.int64()) for k in rows]))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(out.column(0)), *out.columns[1:]], names=["doc_id", *out.schema.names[1:]])
        finally:
            if collects:
                gc.enable()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(released(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# ---- the linear program ------------------------------------------------------------------------------------------


def taken(total: np.ndarray, size: int) -> np.ndarray:
    """What sequences of these totals take up after padding."""
    total = np.asarray(total, np.int64)
    return np.where((total & (total - 1)) == 0, total, size)


def price(duals: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact-sum knapsack: for each total, the best value of lengths that add up to it, and the last length used.

    duals: value of each length, at its place in an array of size + 1; -inf where there is no such piece.
    """
    value, last = np.full(size + 1, -np.inf), np.zeros(size + 1, np.int64)
    value[0] = 0
    backwards = duals[::-1]  # the value of length l is at size - l
    for total in range(1, size + 1):
        options = value[:total] + backwards[size - total : size]  # from 0 + total up to (total - 1) + 1
        i = int(options.argmax())
        value[total], last[total] = options[i], total - i
    return value, last


def _pattern(last: np.ndarray, total: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while total:
        out[int(last[total])] = out.get(int(last[total]), 0) + 1
        total -= int(last[total])
    return out


def greedy_pattern(lengths: list[int], left: dict[int, int] | None, size: int) -> dict[int, int]:
    """The longest piece that fits, as often as it fits and lasts, then the next; ``lengths`` is sorted."""
    room, p, top = size, {}, len(lengths)
    while room and (i := bisect.bisect_right(lengths, room, 0, top)):
        k = lengths[i - 1]
        p[k] = room // k if left is None else min(left[k], room // k)
        room -= p[k] * k
        top = i - 1
    return p


def column_generation(counts: dict[int, int], size: int, tolerance: float = 5e-4, most_pivots: int = 4000, per_round: int = 40) -> list[tuple[dict[int, int], float]]:
    """Patterns {length: copies} and how often each is used in a (nearly) optimal fractional solution.

    The restricted master starts from a greedy solution in fractions: the longest pieces that fit, used until one length
    runs out; the pattern that uses a length up stands for it, which makes the basis regular and the solution feasible.
    Every round prices all patterns by the knapsack, which also bounds the optimum from below: the duals, divided by the
    largest ratio of a pattern's value to its cost, are feasible for the dual program.  It ends when no pattern has a
    positive reduced cost, when the cost is within ``tolerance`` of that bound, or when cost and bound need the same
    whole number of sequences.  ``most_pivots`` ends it earlier on highly degenerate histograms (hundreds of lengths that
    occur once or twice); the patterns are then feasible but not proven best.
    """
    lengths = np.array(sorted(counts))
    m = len(lengths)
    if not m:
        return []
    row = {int(x): i for i, x in enumerate(lengths)}
    need = np.array([counts[int(x)] for x in lengths], float)
    least = float((need * lengths).sum())
    patterns: list[dict[int, int]] = [{}] * m
    x = np.zeros(m)
    left, open_ = need.copy(), [int(k) for k in lengths]
    while open_:
        p = greedy_pattern(open_, None, size)
        at = np.array([row[k] for k in p])
        ratio = left[at] / np.array(list(p.values()))
        out = int(at[ratio.argmin()])
        left[at] = np.maximum(left[at] - ratio.min() * np.array(list(p.values())), 0)
        patterns[out], x[out] = p, ratio.min()
        open_.remove(int(lengths[out]))
    basis = np.zeros((m, m))
    for j, p in enumerate(patterns):
        for k, v in p.items():
            basis[row[k], j] = v
    inverse = np.ascontiguousarray(np.linalg.inv(basis).T)  # transposed: row k is column k of the basis' inverse
    cost = taken(np.array([sum(k * v for k, v in p.items()) for p in patterns]), size).astype(float)
    totals = np.arange(1, size + 1)
    costs = np.append(np.inf, taken(totals, size))
    pivots, bound = 0, least
    while pivots < most_pivots:
        duals = np.full(size + 1, -np.inf)
        duals[lengths] = inverse @ cost
        value, last = price(duals, size)
        bound = max(bound, float(duals[lengths] @ need) / max(1.0, float((value / costs).max())))
        spent = float(cost @ x)
        if spent <= bound * (1 + tolerance) or np.ceil(spent / size - 1e-9) <= np.ceil(bound / size - 1e-9):
            break
        gain = value - costs
        # Besides the best totals, the best pattern around each length that is short of partners.
        around = [(float(duals[l] + value[size - l]) - size, int(l)) for l in lengths if l < size]
        found = [_pattern(last, int(t)) for t in np.argsort(-gain)[:8] if gain[t] > 1e-6 * size]
        for g, l in sorted(around, reverse=True)[:: max(1, len(around) // per_round)]:
            if g > 1e-6 * size:
                p = _pattern(last, size - l)
                p[l] = p.get(l, 0) + 1
                found.append(p)
        entered = 0
        for p in found:
            total = sum(k * v for k, v in p.items())
            c = float(taken(np.array(total), size))
            at = np.array([row[k] for k in p])
            amount = np.array([float(v) for v in p.values()])
            if amount @ (inverse[at] @ cost) - c <= 1e-6 * size:
                continue
            d = amount @ inverse[at]
            positive = d > 1e-9
            if not positive.any():
                continue
            ratio = np.full(m, np.inf)
            ratio[positive] = x[positive] / d[positive]
            r = int(ratio.argmin())
            step = ratio[r]
            pivot_column = inverse[:, r] / d[r]
            change = d.copy()
            change[r] -= 1
            touched = np.flatnonzero(pivot_column)
            used = np.flatnonzero(change)
            inverse[np.ix_(touched, used)] -= np.outer(pivot_column[touched], change[used])
            x = np.maximum(x - step * d, 0)
            x[r] = step
            patterns[r], cost[r] = p, c
            entered += 1
            pivots += 1
        if not entered:
            break
    return [(p, float(v)) for p, v in zip(patterns, x, strict=True) if v > 1e-9]


def fill(left: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Greedy sequences for the pieces that rounding left: the longest that still fits, again and again."""
    lengths, out = sorted(k for k, v in left.items() if v), []
    left = dict(left)
    while lengths:
        p = greedy_pattern(lengths, left, size)
        n = min(left[k] // v for k, v in p.items())
        out.append((p, n))
        for k, v in p.items():
            left[k] -= n * v
        lengths = [k for k in lengths if left[k]]
    return out


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """Whole numbers of sequences for patterns that together use up ``counts``."""
    left = dict(counts)
    out: list[tuple[dict[int, int], int]] = []
    full = left.pop(size, 0)
    if full:
        out.append(({size: 1}, full))

    def use(p: dict[int, int], most: int) -> None:
        if (n := min([most, *(left[k] // v for k, v in p.items())])) > 0:
            out.append((p, n))
            for k, v in p.items():
                left[k] -= n * v

    solved = column_generation(left, size)
    for p, v in solved:
        use(p, int(v + 1e-6))
    for p, _ in sorted(solved, key=lambda s: (s[1] + 1e-6) % 1, reverse=True):
        use(p, 1)
    return out + fill(left, size)


def rank_ranges(planned: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, copies in a sequence, first sequence, offset of the first copy), in the order of ranks."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for p, n in planned:
        offset = 0
        for length, copies in p.items():
            out.append((length, used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + n * copies
            offset += length * copies
        sequence += n
    return sorted(out)


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """``parts`` (rows with ``length``, doc_id, start) with ``sequence_id`` and ``offset``."""
    spark = parts.sparkSession
    parts = materialize(parts, "pieces")  # range partitioning reads its input twice
    order = ["length", "doc_id", "start", "ids_crc32"]

    def rank(batches):
        pid, length, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("length").to_numpy()
            new = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            first = np.repeat(new, np.diff(np.append(new, len(x))))
            r = np.arange(len(x)) - first
            if x[0] == length:
                r[first == 0] += n
            length, n = x[-1], int(r[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(x), pid, np.int32)), pa.array(r)], names=[*b.schema.names, "pid", "local_rank"])

    ranked = parts.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranked = materialize(ranked.mapInArrow(released(rank), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", pid int, local_rank long"), "ranked-pieces")
    # At most one row for each partition and length: the partitions are ranges of lengths.
    shares = sorted((r["length"], r["pid"], r["n"]) for r in ranked.groupBy("length", "pid").agg(F.count("*").alias("n")).collect())
    counts: dict[int, int] = {}
    before = {}
    for length, pid, n in shares:
        before[length, pid] = counts.get(length, 0)
        counts[length] = before[length, pid] + n
    ranges = np.array(rank_ranges(plan(counts, size)), np.int64).reshape(-1, 5)
    base = np.zeros(size + 2, np.int64)
    for length, n in counts.items():
        base[length + 1] = n
    base = np.cumsum(base)  # where a length's ranks begin on one common axis
    starts = base[ranges[:, 0]] + ranges[:, 1]
    share_keys = np.array([length * (1 << 32) + pid for length, pid in before], np.int64)
    share_values = np.array(list(before.values()), np.int64)
    by = np.argsort(share_keys)
    share_keys, share_values = share_keys[by], share_values[by]

    def assign(batches):
        for b in batches:
            if not b.num_rows:
                continue
            length, pid, local = (b.column(k).to_numpy() for k in ("length", "pid", "local_rank"))
            place = base[length] + local + share_values[np.searchsorted(share_keys, length * (1 << 32) + pid)]
            i = np.searchsorted(starts, place, "right") - 1
            k = place - starts[i]
            copies = ranges[i, 2]
            out = [b.column(c) for c in parts_names]
            yield pa.RecordBatch.from_arrays([*out, pa.array(ranges[i, 3] + k // copies), pa.array(ranges[i, 4] + k % copies * length)], names=[*parts_names, "sequence_id", "offset"])

    parts_names = parts.columns
    return ranked.mapInArrow(released(assign), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(read_table(spark, sf_dir, "documents")))
