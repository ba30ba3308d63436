"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: counts of the byte that follows each context of 0 to 3 bytes.  A byte's
probability in a context is its count over (total + distinct), and the share distinct / (total + distinct) is the escape
to the next shorter context, whose probabilities are spread over the bytes not seen in the longer one (method C with
full exclusion, so each context's probabilities sum to one).  Below the empty context all 256 bytes are equal.  The trees are frozen after
training: a byte seen in a context has its code length there, a known context the cost of its escape, both in sorted tables.
A text's code length in a language is the sum over all its bytes; the shortest wins, and its posterior (equal priors)
is the score.  A language's code lengths follow from its own statistics alone, whatever other languages there are.

Training uses a bounded sample: about ``sample_docs`` documents of each language (a Bernoulli sample by hash of the id,
whole texts), whose statistics Spark counts, a few languages at a time.  All languages are learned, with all their contexts.  Tables are
broadcast in blocks of about ``BLOCK_BYTES``; more languages than fit into one block take a pass for each block.

Defined results: null texts and texts without a letter (the empty one too) are ``und`` with score 0; of languages with equal code lengths the
first by name wins; rows with a null id are held out and rows with a null language are not learned from; repeated rows are scored row by row, other columns are ignored;
without any training row every text is ``und``, and an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, released
from .packing import slices

ORDER = 3
#: Documents of each language that are learned from, about.
SAMPLE_DOCS = 400
#: Languages whose statistics come to the driver at once.
LANGS = 8
#: Bytes of the tables that one pass has in memory, about.
BLOCK_BYTES = 32 << 20
#: Bytes of text that are looked up at once; longer texts are cut, each part with the bytes before it.
STRETCH = 1 << 20
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """One document in four, by its id's checksum; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def _codes(data: bytes) -> np.ndarray:
    """Each byte but the first ORDER (lowest) with the ORDER bytes before it, the nearest lowest."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    code = raw[ORDER:].copy()
    for k in range(1, ORDER + 1):
        code |= raw[ORDER - k : len(raw) - k] << np.uint32(8 * k)
    return code


def _grams(batches):
    """(lang, bytes of the context and the next byte as one integer, n) of a batch's texts; a text begins after newlines."""
    for b in batches:
        langs = b.column("lang").to_pylist()
        texts = b.column("text").cast(pa.binary()).to_pylist()
        for lang in sorted(set(langs)):
            own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            codes = _codes(b"".join(b"\n" * ORDER + t for t in own))
            ends = np.cumsum([len(t) + ORDER for t in own])[:-1]
            codes = np.delete(codes, (ends[:, None] - ORDER + np.arange(ORDER)).ravel())  # the newlines between texts are contexts only
            if len(codes):
                grams, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among the sorted keys, and their values."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, values[at]


class ContextTree:
    """A language's frozen code lengths in bits, for contexts of k bytes: ``seen[k]`` holds (context and byte, code length there), ``escapes[k]``
    holds (context, what a byte not seen in it costs above its code length in the context of one byte less)."""

    def __init__(self, lang: str, seen: list[tuple[np.ndarray, np.ndarray]], escapes: list[tuple[np.ndarray, np.ndarray]]):
        self.lang, self.seen, self.escapes = lang, seen, escapes
        self.size = sum(x.nbytes for pair in seen + escapes for x in pair)

    @classmethod
    def fit(cls, lang: str, gram: np.ndarray, n: np.ndarray) -> ContextTree:
        """``gram``: codes as of ``_codes``; ``n``: how often each was seen."""
        gram, n = np.asarray(gram, np.int64), np.asarray(n, float)
        seen, escapes, shorter, p = [], [], None, None
        for k in range(ORDER + 1):
            own, at = np.unique(gram & (1 << 8 * (k + 1)) - 1, return_inverse=True)
            context, of = np.unique(own >> 8, return_inverse=True)
            count = np.bincount(at, n)
            total, distinct = np.bincount(of, count), np.bincount(of)
            # What is seen in a context was seen in the shorter one too; the rest is what that leaves to all other bytes.
            below = p[np.searchsorted(shorter, own & (1 << 8 * k) - 1)] if k else np.full(len(own), 1 / 256)
            rest = np.where(distinct < 256, 1 - np.bincount(of, below), 1)
            every = total + np.where(distinct < 256, distinct, 0)
            shorter, p = own, count / every[of]
            seen.append((own.astype(np.uint32), -np.log2(p).astype(np.float32)))
            escapes.append((context.astype(np.uint32), -np.log2(distinct / (total + distinct) / rest).astype(np.float32)))
        return cls(lang, seen, escapes)

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each byte after its context."""
        out = np.full(len(codes), 8, np.float32)
        for k in range(ORDER + 1):
            own = codes & np.uint32((1 << 8 * (k + 1)) - 1)
            known, cost = _find(*self.escapes[k], own >> np.uint32(8))
            found, bits = _find(*self.seen[k], own)
            out = np.where(found, bits, out + np.where(known, cost, np.float32(0)))
        return out


def _add_lengths(out: np.ndarray, trees: list[ContextTree], parts: list[tuple[int, bytes]]) -> None:
    """Adds the bits of parts of texts, each after the ORDER bytes before it, to ``out[text, language]``."""
    codes, at = np.unique(_codes(b"".join(x for _, x in parts)), return_inverse=True)
    ends = np.cumsum([len(x) for _, x in parts])
    # Alternate stretches are the next part's context, and are left out.
    cuts = np.stack([np.concatenate([[0], ends[:-1]]), ends - ORDER], 1).ravel()[:-1]
    owner = np.array([i for i, _ in parts])
    for j, tree in enumerate(trees):
        np.add.at(out[:, j], owner, np.add.reduceat(tree.lengths(codes)[at], cuts, dtype=np.float64)[::2])


def code_lengths(trees: list[ContextTree], texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language."""
    out = np.zeros((len(texts), len(trees)))
    parts, size = [], 0
    for i, text in enumerate(texts):
        data = b"\n" * ORDER + text
        for a in range(0, len(text), STRETCH):
            parts.append((i, data[a : a + ORDER + STRETCH]))
            size += len(parts[-1][1])
            if size >= STRETCH:
                _add_lengths(out, trees, parts)
                parts, size = [], 0
    if parts:
        _add_lengths(out, trees, parts)
    return out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[ContextTree]:
    """A tree for each language, by name.  ``docs``: doc_id, text, lang; only rows that are not held out and have a language are learned from.  No such row: no trees."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    u = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    langs, trees = sorted(sizes), []
    for some in (langs[i : i + LANGS] for i in range(0, len(langs), LANGS)):
        n = F.coalesce(*[F.when(F.col("lang") == x, F.lit(sizes[x])) for x in some])
        sample = rows.where(F.col("lang").isin(some) & (u * n < sample_docs)).select("lang", "text")
        counts = sample.mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        got = counts.toPandas()  # at most as many rows as the sample of these languages has bytes
        trees += [ContextTree.fit(lang, own["gram"], own["n"]) for lang, own in got.groupby("lang", sort=True)]
    return trees


def _blocks(trees: list[ContextTree], size: int) -> list[list[ContextTree]]:
    """Trees in their order, in blocks of about ``size`` bytes; at least one block."""
    out, used = [[]], 0
    for tree in trees:
        if out[-1] and used + tree.size > size:
            out.append([])
            used = 0
        out[-1].append(tree)
        used += tree.size
    return out


def identify(docs: DataFrame, model: list[ContextTree], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, lang_pred, score, bits_per_byte: every whole text under the frozen trees."""
    blocks = _blocks(model, block_bytes)
    result = "doc_id long, lang_pred string, score double, bits_per_byte double"
    state = "doc_id long, text string, lang_pred string, least double, mass double"  # mass: of all languages so far, the best one's being 1
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit("und").alias("lang_pred"), F.lit(float("inf")).alias("least"), F.lit(0.0).alias("mass"))
    for k, block in enumerate(blocks):
        shared, last = docs.sparkSession.sparkContext.broadcast(block), k == len(blocks) - 1

        def run(batches, shared=shared, last=last):
            trees = shared.value
            names = np.array([t.lang for t in trees], object)
            for b in batches:
                for at, n in slices(b.column("text"), STRETCH):
                    part = b.slice(at, n)
                    texts = part.column("text").to_pylist()
                    lang = np.array(part.column("lang_pred").to_pylist(), object)
                    least, mass, rate = np.array(part.column("least")), np.array(part.column("mass")), np.zeros(n)
                    own = np.flatnonzero([bool(trees and t and _LETTER.search(t)) for t in texts])
                    if len(own):
                        raw = [texts[i].encode() for i in own]
                        bits = code_lengths(trees, raw)
                        best = bits.argmin(1)
                        low = np.minimum(bits.min(1), least[own])
                        lang[own] = np.where(bits.min(1) < least[own], names[best], lang[own])
                        mass[own] = mass[own] * np.exp2(np.maximum(low - least[own], -1000)) + np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(1)
                        least[own] = low
                        rate[own] = low / np.array([len(t) for t in raw])
                    if last:
                        score = np.divide(1, mass, out=np.zeros(n), where=mass > 0)
                        columns = {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score), "bits_per_byte": pa.array(rate)}
                    else:
                        columns = {"text": part.column("text"), "lang_pred": pa.array(lang, pa.string()), "least": pa.array(least), "mass": pa.array(mass)}
                    yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id")} | columns)

        docs = docs.mapInArrow(released(run), result if last else state)
        if not last:
            docs = materialize(docs, "langid")
    return docs


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")
