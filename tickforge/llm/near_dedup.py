"""Near-duplicate documents: banded MinHash candidates, verified by sequential Bayesian tests, then on their full sets.

Texts with equal sets of shingles are one node.  A node's signature is ``bands`` x ``rows`` minima of its set, of which a byte each is kept
for comparisons.  Nodes that share a band's hash are candidates.  A pair's bytes are compared in batches: after each one, a pair goes
whose posterior probability of being similar enough (uniform prior, matches so far) is below a bound.  The bound is chosen
so that a pair at the threshold is lost in all batches together with a probability of at most ``miss`` (``schedule`` finds it,
``missed`` computes that probability exactly).  Survivors are decided by their full sets.

What is asked for is components, not pairs, so large buckets are not paired:

1. Buckets of at most ``SMALL`` nodes give their pairs.  A larger one is named by a centre, the node in it that shares the most; each of
   its nodes is a candidate with the centre only.  Links give components.
2. Where all nodes of a centre are one component, nothing is left to ask.  Elsewhere the nodes outside the centre's largest component are compared with
   all others, in tasks of two bounded blocks: bytes of signatures first, in the same batches, sets only where those are alike and the
   components differ.  Only edges that join two components leave a task.

The second step is work with (nodes outside the largest component) x (nodes of the centre), some ten bytes a pair: texts that are alike
but not similar enough have to be looked at, and nothing is dropped to avoid it.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of fewer words than a shingle has one, all of it; texts without words are alone, even
from each other; repeated rows get the same result; component_id is the least id, nulls last; kept is whether it is the row's own
(null ids: if the component has no other); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import Sieve, mix
from .common import TEXT_KEY, lookup, materialize, read_table, released, with_text_key
from .near_join import _common, _name_array, _nodes, banding, components, shingle_sets
from .packing import slices

SHINGLE = 5
#: Hundredths of the union that two sets have in common.
THRESHOLD = 85
#: Of pairs at the threshold so many share a band, and so many of those are lost by the tests.
RECALL, MISS = 0.99999, 1e-5
BATCH = 15
SMALL = 8
#: Nodes and shingles of a block, at most or about.  Centres of more nodes than NARROW have up to SPREAD blocks.
WIDE, MILLIONS = 2000, 1
NARROW, SPREAD = 250, 4
#: Share of pairs up to which they are compared as a list.
DENSE = 0.02


# ---- the sequential test ------------------------------------------------------------------------------------------------


def agreement(similarity: float) -> float:
    """Probability that the bytes of two signatures agree at a place."""
    return similarity + (1 - similarity) / 256


def binomial(n: int, p: float) -> np.ndarray:
    """Probabilities of 0 to n successes."""
    i = np.arange(n + 1)
    log = np.array([math.lgamma(k + 1) for k in range(n + 1)])
    return np.exp(log[n] - log[i] - log[n - i] + i * math.log(p) + (n - i) * math.log1p(-p))


def posterior(n: int, threshold: float) -> np.ndarray:
    """For 0 to n matches of n: the probability, from a uniform prior, that the rate of agreement is that of the threshold or more."""
    return np.cumsum(binomial(n + 1, agreement(threshold)))[:-1]


def missed(similarity: float, least: list[int], batch: int) -> float:
    """Probability that a pair of this similarity is lost: fewer than least[k] matches after k + 1 batches, for any k."""
    one = binomial(batch, agreement(similarity))
    alive, lost = np.ones(1), 0.0
    for k in least:
        alive = np.convolve(alive, one)
        lost += alive[:k].sum()
        alive[:k] = 0
    return float(lost)


def schedule(threshold: float, miss: float, hashes: int, batch: int = BATCH) -> list[int]:
    """The least number of matches after each batch: the strictest posterior bound, in steps of a half, that loses no more than ``miss``."""
    bound = 0.1
    while True:
        least = [int(np.searchsorted(posterior(n, threshold), bound)) for n in range(batch, hashes + 1, batch)]
        if missed(threshold, least, batch) <= miss:
            return least
        bound /= 2


# ---- signatures and sets ------------------------------------------------------------------------------------------------


def _shingles(texts: pa.Array, size: int):
    return shingle_sets(pc.ascii_lower(texts.fill_null("")), size)


def signatures(docs: DataFrame, bands: int, rows: int, size: int = SHINGLE) -> DataFrame:
    """doc_id, key, node (null without words), n_shingles, bands (hashes), prints (a byte of each minimum)."""
    rng = np.random.default_rng(20250211)
    factors = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    offsets = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text"), 1 << 20):
                part = b.slice(at, n)
                h, sizes = _shingles(part.column("text"), size)
                full = np.flatnonzero(sizes)
                node, prints = np.full(n, None, object), np.full(n, None, object)
                hashes = np.zeros((len(full), bands), np.uint64)
                if len(full):
                    node[full] = _name_array(_nodes(h, sizes, full)).to_pylist()
                    low = (h >> np.uint64(32)).astype(np.uint32)
                    starts = (np.cumsum(sizes) - sizes)[full]
                    kept = np.zeros((len(full), bands * rows), np.uint8)
                    for j in range(bands):
                        key = np.full(len(full), j + 1, np.uint64)
                        for r in range(j * rows, (j + 1) * rows):
                            x = low * factors[r] + offsets[r]
                            x ^= x >> np.uint32(15)
                            x *= np.uint32(0x846CA68B)
                            least = np.minimum.reduceat(x, starts)
                            kept[:, r] = (least ^ least >> np.uint32(8) ^ least >> np.uint32(16)) & np.uint32(255)
                            key = mix(key + least.astype(np.uint64))
                        hashes[:, j] = key
                    prints[full] = [row.tobytes() for row in kept]
                ends = np.zeros(n + 1, np.int32)
                ends[1:] = np.cumsum(np.where(sizes > 0, bands, 0))
                columns = [part.column("doc_id"), part.column(TEXT_KEY), pa.array(node.tolist(), pa.binary()), pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(ends, hashes.view(np.int64).ravel()), pa.array(prints.tolist(), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", TEXT_KEY, "node", "n_shingles", "bands", "prints"])

    return docs.mapInArrow(released(run), f"doc_id long, {TEXT_KEY} long, node binary, n_shingles long, bands array<long>, prints binary")


def sets_of(docs: DataFrame, nodes: DataFrame, size: int = SHINGLE) -> DataFrame:
    """node, set (sorted shingle hashes) of the given nodes."""
    front = F.expr("cast(conv(hex(substring(node, 1, 8)), 16, -10) as long)")
    table = docs.sparkSession.sparkContext.broadcast(Sieve.build(nodes.select(front.alias("front")), "front"))

    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text"), 1 << 20):
                h, sizes = _shingles(b.column("text").slice(at, n), size)
                full = np.flatnonzero(sizes)
                if not len(full):
                    continue
                names = _nodes(h, sizes, full)
                ok = Sieve.holds(table.value, names[:, 0].byteswap())
                chosen = full[ok]
                if len(chosen):
                    member = np.repeat(np.isin(np.arange(len(sizes)), chosen), sizes)
                    ends = np.append(0, np.cumsum(sizes[chosen])).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([_name_array(names[ok]), pa.ListArray.from_arrays(ends, h[member].view(np.int64))], names=["node", "set"])

    found = docs.mapInArrow(released(run), "node binary, set array<long>").groupBy("node").agg(F.first("set").alias("set"))
    return found.join(nodes.select("node"), "node", "left_semi")


# ---- pairs --------------------------------------------------------------------------------------------------------------


def _bytes_of(x: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), width)


def surviving(a: np.ndarray, b: np.ndarray, least: list[int], batch: int) -> np.ndarray:
    """Which rows of bytes a and b pass the test in all batches; those that fail one are not looked at again."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for k, bound in enumerate(least):
        at = slice(k * batch, (k + 1) * batch)
        matches[alive] += (a[alive, at] == b[alive, at]).sum(1)
        alive = alive[matches[alive] >= bound]
    return alive


def likely(pairs: DataFrame, prints: DataFrame, least: list[int], hashes: int, batch: int) -> DataFrame:
    """a, b: the pairs that pass the sequential test.  prints: node, prints."""

    def run(batches):
        for t in batches:
            if t.num_rows:
                ok = surviving(_bytes_of(t.column("prints_a"), hashes), _bytes_of(t.column("prints_b"), hashes), least, batch)
                yield pa.RecordBatch.from_arrays([t.column("a").take(pa.array(ok)), t.column("b").take(pa.array(ok))], names=["a", "b"])

    of = lambda x: prints.select(F.col("node").alias(x), F.col("prints").alias(f"prints_{x}"))
    return pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "prints_a", "prints_b").mapInArrow(released(run), "a binary, b binary")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """a, b: the pairs whose sets have enough in common."""
    of = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.join(of("b"), "b").join(of("a"), "a").where(100 * both >= threshold * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")


def _compare(t: pa.Table, threshold: int, least: list[int], hashes: int, batch: int) -> pa.Table:
    """a, b: links between blocks x and y of a centre that join components, as few as do it."""
    t = t.combine_chunks()
    block, x, y = t["block"].to_numpy(), t["x"][0].as_py(), t["y"][0].as_py()
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    prints = _bytes_of(t["prints"].chunk(0), hashes)
    label = t["label"].chunk(0).dictionary_encode().indices.to_numpy()
    rows, columns = [], []
    step = max(1, (1 << 22) // max(1, len(right)))
    for at in range(0, len(left), step):  # so many pairs at a time that a batch is some MB
        own = left[at : at + step]
        alive = label[own][:, None] != label[right][None, :]
        if x == y:
            alive &= own[:, None] < right[None, :]
        matches, k = np.zeros(alive.shape, np.uint16 if hashes > 255 else np.uint8), 0
        while k < len(least) and alive.mean() > DENSE:  # all pairs of the step, as long as many are left
            for place in range(k * batch, (k + 1) * batch):
                matches += prints[own, place][:, None] == prints[right, place][None, :]
            alive &= matches >= least[k]
            k += 1
        i, j = np.nonzero(alive)
        for s in range(0, len(i), 1 << 15):
            a, b = own[i[s : s + (1 << 15)]], right[j[s : s + (1 << 15)]]
            ok = surviving(prints[a], prints[b], least, batch) if k < len(least) else slice(None)
            rows.append(a[ok])
            columns.append(b[ok])
    a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (rows, columns))
    edges = []
    if len(a):
        sets = t["set"].chunk(0)
        sizes = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ua, ub = np.unique(a), np.unique(b)
        used = np.zeros(t.num_rows, bool)
        used[ua] = used[ub] = True
        both = _common(sets.flatten().to_numpy()[np.repeat(used, sizes)], np.repeat(np.arange(t.num_rows), np.where(used, sizes, 0)), ua, ub)
        both = both[np.searchsorted(ua, a), np.searchsorted(ub, b)].astype(np.int64)
        linked = 100 * both >= threshold * (sizes[a] + sizes[b] - both)
        root = np.arange(label.max() + 1)

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in zip(a[linked], b[linked], strict=True):
            p, q = find(label[i]), find(label[j])
            if p != q:
                root[p] = q
                edges.append((i, j))
    node = t["node"].chunk(0)
    return pa.table({c: node.take(pa.array([e[k] for e in edges], pa.int64())) for k, c in enumerate("ab")})


def links(docs: DataFrame, nodes: DataFrame, threshold: int, miss: float, hashes: int, size: int, batch: int) -> DataFrame:
    """node, label (the least node of its component) of the nodes that are linked to any other.  nodes: node, bands, prints, n_shingles."""
    least = schedule(threshold / 100, miss, hashes, batch)
    keys = nodes.select("node", F.explode("bands").alias("key"))
    sizes = materialize(keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"), "buckets")
    members = materialize(lookup(keys, sizes.withColumn("size", F.col("rows")), ["key"], ["size"], "rows", "inner"), "members")

    few = members.where(F.col("size") <= SMALL)
    a, b = (few.select("key", F.col("node").alias(x)) for x in "ab")
    pairs = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b"))).select("a", "b")
    large = members.where(F.col("size") > SMALL)
    score = large.groupBy("node").agg(F.sum("size").alias("score"))
    centres = large.select("key", "node").join(score, "node").groupBy("key").agg(F.max(F.struct("score", "node"))["node"].alias("centre"), F.count("*").alias("rows"))
    stars = materialize(lookup(large.select("key", "node"), materialize(centres, "centres"), ["key"], ["centre"], "rows", "inner").select("centre", "node").distinct(), "stars")
    rays = stars.where("centre <> node").select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b"))
    prints = nodes.select("node", "prints")
    survivors = materialize(likely(pairs.unionAll(rays).distinct(), prints, least, hashes, batch), "survivors")
    asked = survivors.select(F.col("a").alias("node")).unionAll(survivors.select("b")).unionAll(stars.select("node")).distinct()
    sets = materialize(sets_of(docs, asked, size), "sets")
    found = materialize(confirmed(survivors, sets, threshold), "links")
    labels = materialize(components(found), "components")

    # Centres whose nodes are not one component yet.
    own = stars.join(labels, "node", "left").select("centre", "node", F.coalesce("label", "node").alias("label"))
    own = materialize(own, "own")
    parts = own.groupBy("centre", "label").agg(F.count("*").alias("n"))
    split = parts.groupBy("centre").agg(F.count("*").alias("parts"), F.max(F.struct("n", "label"))["label"].alias("main"), F.sum("n").alias("rows")).where("parts > 1")
    split = materialize(split.select("centre", "main", "rows"), "split")
    zones = lookup(own, split, ["centre"], ["main"], "rows", "inner")
    zones = materialize(zones.join(nodes.select("node", "n_shingles"), "node").select("centre", "node", "label", (F.col("label") == F.col("main")).alias("inside"), "n_shingles"), "zones")

    def blocks(inside: bool):
        rows, n = F.count_if(F.col("inside") == inside), F.coalesce(F.sum(F.when(F.col("inside") == inside, F.col("n_shingles"))), F.lit(0))
        return F.greatest(F.ceil(rows / WIDE), F.ceil(n / (MILLIONS * 1_000_000)), F.least(F.ceil(rows / NARROW), F.lit(SPREAD))).cast("int")

    groups = materialize(zones.groupBy("centre").agg(blocks(True).alias("inner"), blocks(False).alias("outer"), F.count("*").alias("rows")), "groups")
    dealt = lookup(zones.select("centre", "node", "label", "inside"), groups, ["centre"], ["inner", "outer"], "rows", "inner")
    h, inner, outer = F.xxhash64("node"), F.col("inner"), F.col("outer")
    dealt = dealt.withColumn("block", F.when(F.col("inside"), F.pmod(h, inner)).otherwise(inner + F.pmod(h, outer)).cast("int"))
    dealt = dealt.select("centre", "node", "label", "block", F.explode(F.sequence(F.when(F.col("inside"), inner).otherwise(F.lit(0)), inner + outer - 1)).alias("with"))
    dealt = dealt.select("centre", "node", "label", "block", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"))
    compared = dealt.join(prints, "node").join(sets, "node").groupBy("centre", "x", "y").applyInArrow(lambda t: _compare(t, threshold, least, hashes, batch), "a binary, b binary")
    late = materialize(compared, "late")
    if not late.limit(1).count():
        return labels
    return components(found.unionAll(late))


def near_components(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE, recall: float = RECALL, miss: float = MISS, batch: int = BATCH) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept of every document of ``docs`` (see with_text_key)."""
    bands, rows = banding(threshold / 100, recall)
    every = materialize(signatures(docs, bands, rows, size), "signatures")
    nodes = every.where(F.col("node").isNotNull()).groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("prints").alias("prints"))
    nodes = materialize(nodes, "nodes")
    labels = links(docs, nodes, threshold, miss, bands * rows, size, batch)
    members = materialize(nodes.select("node", "n", "first").join(labels, "node"), "linked")
    least = materialize(members.groupBy("label").agg(F.min("first").alias("component_id"), F.count("*").alias("rows")), "least")
    named = lookup(members, least, ["label"], ["component_id"], "rows", "inner").select("node", "component_id")
    alone = nodes.select("node", "n", "first").join(named.withColumn("linked", F.lit(True)), "node", "left")
    names = materialize(alone.select("node", "n", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id")), "names")
    out = lookup(every.select("doc_id", TEXT_KEY, "node", "n_shingles"), names, ["node"], ["component_id"], "n")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", TEXT_KEY, "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, repeated rows of a document once; a text that shares its id with another one that is kept stays with it."""
    kept = near_components(with_text_key(docs), **options).where("kept").select(F.col("doc_id").alias("_id"), F.col(TEXT_KEY).alias("_key")).distinct()
    keyed = docs.withColumn(TEXT_KEY, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(kept["_id"]) & (keyed[TEXT_KEY] == kept["_key"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", TEXT_KEY]).drop(TEXT_KEY)


def op11_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(with_text_key(read_table(spark, sf_dir, "documents"))).drop(TEXT_KEY)


SQL = """
with recursive
words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
shingles as (
  select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
sized as (select doc_id, coalesce(s, []) as s, len(coalesce(s, [])) as n from shingles),
rows as (select doc_id, n, unnest(s) as x from sized),
pairs as (
  select a.doc_id as a, b.doc_id as b from rows a join rows b on a.x = b.x and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges as (select a, b from pairs union all select b, a from pairs),
reach as (
  select a as node, b as other from edges
  union
  select r.node, e.b from reach r join edges e on r.other = e.a)
select doc_id, n as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id, doc_id <= coalesce(m, doc_id) as kept
from sized left join (select node, min(other) as m from reach group by node) on doc_id = node
"""
