"""Jaccard join of documents on word n-grams: MinHash bands find candidates, the full sets verify them.

Texts with equal sets of five-word shingles are one class (copies; they are never expanded into pairs) and one node.
A node's signature has ``bands`` x ``rows`` minima; the counts are chosen for a target recall at the threshold.  Nodes
that share a band's hash form a bucket.  Buckets of at most ``small`` nodes give all their pairs as rows.  Larger ones are named
by a central node (which shares the most buckets), so that the buckets of one hot group fall together, and are not paired:

1. The shingles that most of some thirty of a centre's nodes have are its pivot.  Each node is compared with the pivot only.
2. Jaccard distance is a metric: two nodes with at least (1 + threshold) / 2 in common with the pivot, the centre's core, are similar
   enough in any case.  Their links are counted from the core's size, and its least node connects them: work in proportion to
   nodes, however many near copies of one text there are.
3. Nodes outside the core are dealt into blocks, and each block is compared with every other one and with the core's blocks, two
   in a task, by counting what their sets share (``_compare``).  Only counts of links and the edges of a spanning forest leave the task.

All pairs that share a bucket are so decided, whatever its size; the pivot decides only how.
Verified links make connected components, found by label propagation with pointer jumping.

n_links is the number of different texts (nodes) that are similar enough and share a bucket, whatever the bucket's size.  A pair
with several centres is counted at the least one, and a pair with a centre is left out of the small buckets.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a text of one to four words has one shingle, all of it; texts without words are
linked to nothing, not even each other; repeated rows are copies; class_id is the least doc_id of the class (null if it
has none), which need not name the class: classes of null ids only, or of one id with different texts, may have the same; class_key
(a hash of the class's least set, null for a text without words) does; other columns are ignored.  The first of a class is its least document by (doc_id, nulls last; hash of the text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import Rolling, Sieve, mix, word_codes
from .common import TEXT_KEY, lookup, materialize, read_table, released, with_text_key
from .packing import slices

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99999
SMALL = 12
#: A block of a large group has about so many nodes and so many million shingles at most.
MILLIONS = 1
WIDE = 2000
#: Groups of more nodes than this are dealt into up to SPREAD blocks, so that a middling one is not left to one task.
NARROW = 250
SPREAD = 4
#: Values that make no more pairs than this are counted pair by pair, the others as matrix columns.
FEW = 16
COLUMNS = 2048
#: Nodes that a pivot is made from, about; and different sets of lesser centres up to which a core is counted, not compared.
PIVOT = 31
KINDS = 2000


def banding(threshold: float, recall: float, rows: int = 6) -> tuple[int, int]:
    """Bands and rows such that a pair at the threshold shares a band with at least this probability."""
    bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
    return bands, rows


def shingle_sets(texts: pa.Array, size: int):
    """The set of shingle hashes of each text, sorted, one after the other; and the sets' sizes."""
    codes, counts = word_codes(texts)
    ends = np.cumsum(counts)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), n)
    place = np.arange(int(n.sum())) + np.repeat(ends - counts - (np.cumsum(n) - n), n)
    length = np.minimum(size, counts)[doc]
    h = mix(Rolling(codes).at(place, length)) if len(place) else np.zeros(0, np.uint64)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    return h, np.bincount(doc, minlength=len(counts))


def _nodes(h: np.ndarray, sizes: np.ndarray, full: np.ndarray) -> np.ndarray:
    """A 128-bit name of each set that is not empty."""
    starts = (np.cumsum(sizes) - sizes)[full]
    a = np.add.reduceat(mix(h ^ np.uint64(0x1234567)), starts)
    b = np.add.reduceat(mix(h + np.uint64(0x9E3779B97F4A7C15)), starts)
    return np.stack([mix(a + sizes[full].astype(np.uint64)), b], 1)


def _name_array(names: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(names).tobytes()
    return pa.array([raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary())


def signatures(docs: DataFrame, bands: int, rows: int, size: int = SHINGLE) -> DataFrame:
    """doc_id, key, node (null without words), bands (hashes) of every document."""
    rng = np.random.default_rng(20240501)
    factors = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    offsets = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text"), 1 << 20):
                part = b.slice(at, n)
                h, sizes = shingle_sets(part.column("text"), size)
                full = np.flatnonzero(sizes)
                node = np.full(n, None, object)
                hashes = np.zeros((len(full), bands), np.uint64)
                if len(full):
                    node[full] = _name_array(_nodes(h, sizes, full)).to_pylist()
                    low = (h >> np.uint64(32)).astype(np.uint32)
                    starts = (np.cumsum(sizes) - sizes)[full]
                    for j in range(bands):
                        key = np.full(len(full), j + 1, np.uint64)
                        for r in range(rows):
                            x = low * factors[j * rows + r] + offsets[j * rows + r]
                            x ^= x >> np.uint32(15)
                            x *= np.uint32(0x846CA68B)
                            key = mix(key + np.minimum.reduceat(x, starts).astype(np.uint64))
                        hashes[:, j] = key
                ends = np.zeros(n + 1, np.int32)
                ends[1:] = np.cumsum(np.where(sizes > 0, bands, 0))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column(TEXT_KEY), pa.array(node.tolist(), pa.binary()), pa.ListArray.from_arrays(ends, hashes.view(np.int64).ravel())], names=["doc_id", TEXT_KEY, "node", "bands"])

    return docs.mapInArrow(released(run), f"doc_id long, {TEXT_KEY} long, node binary, bands array<long>")


def sets_of(docs: DataFrame, nodes: DataFrame, size: int = SHINGLE) -> DataFrame:
    """node, set (array of shingle hashes) of the given nodes."""
    front = "conv(hex(substring(node, 1, 8)), 16, -10)"
    table = docs.sparkSession.sparkContext.broadcast(Sieve.build(nodes.select(F.expr(f"cast({front} as long)").alias("front")), "front"))

    def run(batches):
        for b in batches:
            for at, n in slices(b.column("text"), 1 << 20):
                h, sizes = shingle_sets(b.column("text").slice(at, n), size)
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


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b of the pairs whose sets are similar enough.  Both sides are plain tables: Spark splits the partitions of a hot node."""
    a = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return pairs.join(b, "b").join(a, "a").where(both >= threshold * (F.size("set_a") + F.size("set_b") - both) - 1e-9).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for the nodes of the edges a, b.  A hub's edges and a large component's nodes are salted."""
    both = materialize(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("degree"), F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        heard = lookup(both.select("a", F.col("b").alias("node")), labels, ["node"], ["label"], "degree", "inner").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        step = materialize(labels.join(heard, "node").select("node", "degree", F.col("label").alias("was"), F.least("label", "heard").alias("label")), "labels")
        sizes = step.groupBy("label").agg(F.count("*").alias("n"))
        jumps = materialize(sizes.join(step.select(F.col("node").alias("label"), F.col("label").alias("next")), "label"), "jumps")
        step = materialize(lookup(step, jumps, ["label"], ["next"], "n", "inner").select("node", "degree", "was", F.least("label", "next").alias("label")), "labels")
        if not step.where("was <> label").limit(1).count():
            return step.select("node", "label")
        labels = step.drop("was")


def _common(value: np.ndarray, row: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values each row of ``left`` shares with each of ``right``; a row has a value once."""
    _, value = np.unique(value, return_inverse=True)
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    n = int(value[-1]) + 1 if len(value) else 0
    sides = []
    for side in (left, right):
        place = np.full(int(max(left.max(), right.max(), row.max(initial=0))) + 1, -1)
        place[side] = np.arange(len(side))
        mine = place[row] >= 0
        count = np.bincount(value[mine], minlength=n)
        sides.append((value[mine], place[row][mine], count, np.cumsum(count) - count))
    (va, pa_, ca, sa), (vb, pb, cb, sb) = sides
    out = np.zeros((len(left), len(right)), np.float32)
    few = np.flatnonzero((ca * cb > 0) & (ca * cb <= FEW))
    if len(few):
        times = (ca * cb)[few]
        e = np.repeat(few, times)
        at = np.arange(len(e)) - np.repeat(np.cumsum(times) - times, times)
        out += np.bincount(pa_[sa[e] + at // cb[e]] * len(right) + pb[sb[e] + at % cb[e]], minlength=out.size).reshape(out.shape)
    many = np.flatnonzero(ca * cb > FEW)
    column = np.full(n, -1)
    column[many] = np.arange(len(many))
    for start in range(0, len(many), COLUMNS):
        parts = []
        for v, p, k in ((va, pa_, len(left)), (vb, pb, len(right))):
            c = column[v] - start
            ok = (c >= 0) & (c < COLUMNS)
            m = np.zeros((k, min(COLUMNS, len(many) - start)), np.float32)
            m[p[ok], c[ok]] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the linked rows."""
    at_left, at_right = np.full(n, -1), np.full(n, -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    seen, edges = np.zeros(n, bool), []
    for start in left:
        todo = [] if seen[start] else [start]
        seen[start] = True
        while todo:
            x = todo.pop()
            near = right[linked[at_left[x]]] if at_left[x] >= 0 else left[linked[:, at_right[x]]]
            near = near[~seen[near]]
            seen[near] = True
            edges += [(x, y) for y in near]
            todo += list(near)
    return edges


def _compare(t: pa.Table, threshold: float) -> pa.Table:
    """node, n: links counted of all pairs between blocks x and y of a centre; node, other: edges that connect what is linked."""
    t = t.combine_chunks()
    block, x, y, centre = t["block"].to_numpy(), t["x"][0].as_py(), t["y"][0].as_py(), t["centre"][0].as_py()
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    counts, edges = np.zeros(t.num_rows, np.int64), []
    if len(left) and len(right):
        sets, others = (t[c].chunk(0) for c in ("set", "centres"))
        sizes = sets.value_lengths().to_numpy(zero_copy_only=False)
        rows = np.arange(t.num_rows)
        both = _common(sets.flatten().to_numpy(), np.repeat(rows, sizes), left, right).astype(np.float64)
        linked = both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-9
        before, of = others.flatten().to_numpy(), np.repeat(rows, others.value_lengths().to_numpy(zero_copy_only=False))
        if (before < centre).any():
            linked &= _common(before[before < centre], of[before < centre], left, right) == 0
        if x == y:
            np.fill_diagonal(linked, False)
        else:
            counts[right] += linked.sum(0)
        counts[left] += linked.sum(1)
        edges = _forest(linked, left, right, t.num_rows)
    some = np.flatnonzero(counts)
    node = t["node"].take(pa.array(np.concatenate([some, np.array([a for a, _ in edges], np.int64)]))).combine_chunks()
    other = pa.concat_arrays([pa.nulls(len(some), pa.binary()), t["node"].take(pa.array([b for _, b in edges], pa.int64())).combine_chunks().cast(pa.binary())])
    return pa.table({"node": node, "other": other, "n": pa.array(np.append(counts[some], np.zeros(len(edges), np.int64)))})


def _pivot(t: pa.Table) -> pa.Table:
    """The values that most of the sets have."""
    values, n = np.unique(t["set"].combine_chunks().flatten().to_numpy(), return_counts=True)
    most = values[2 * n > t.num_rows]
    return pa.table({"centre": t["centre"].slice(0, 1), "set": pa.ListArray.from_arrays(np.array([0, len(most)], np.int32), most)})


def _measure(t: pa.Table, threshold: float) -> pa.Table:
    """The nodes whose sets are so near the pivot (the row without node) that any two of them are similar enough."""
    t = t.combine_chunks()
    own = t["node"].is_valid().to_numpy()
    sets = t["set"].chunk(0)
    sizes = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    near = np.zeros(t.num_rows, bool)
    if not own.all():
        pivot = np.sort(sets[int(np.flatnonzero(~own)[0])].values.to_numpy())
        row = np.repeat(np.arange(t.num_rows), sizes)
        both = np.bincount(row, np.isin(sets.flatten().to_numpy(), pivot), t.num_rows)
        near = own & (both >= (1 + threshold) / 2 * (sizes + len(pivot) - both) + 1e-9)
    return t.select(["centre", "node"]).filter(pa.array(near))


def _core_links(t: pa.Table) -> pa.Table:
    """centre, lesser, n, links, first: for each kind of core node the others that are counted here, which share no lesser centre with it."""
    lesser, n = t["lesser"].to_pylist(), t["n"].to_numpy()
    place = {c: i for i, c in enumerate(sorted({c for x in lesser for c in x}))}
    has = np.zeros((len(lesser), len(place)), np.float32)
    for i, x in enumerate(lesser):
        has[i, [place[c] for c in x]] = 1
    apart = has @ has.T == 0
    links = apart @ n - np.array([not x for x in lesser])  # without lesser centres a node would count itself
    return pa.table({"centre": t["centre"], "lesser": t["lesser"], "n": t["n"], "links": pa.array(links.astype(np.int64)), "first": pa.array([min(t["first"].to_pylist())] * len(lesser), pa.binary())})


def links(docs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD, small: int = SMALL, millions: int = MILLIONS, wide: int = WIDE) -> tuple[DataFrame, DataFrame]:
    """a, b: verified links that connect all that is linked; and node, n_links: the number of all verified links.  ``classes``: node, bands."""
    keys = classes.select("node", F.explode("bands").alias("key"))
    sizes = materialize(keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"), "buckets")
    members = materialize(lookup(keys, sizes.withColumn("size", F.col("rows")), ["key"], ["size"], "rows", "inner"), "members")
    sets = materialize(sets_of(docs, members.select("node").distinct()), "sets")

    large = members.where(F.col("size") > small)
    score = large.groupBy("node").agg(F.sum("size").alias("score"))
    centres = large.select("key", "node").join(score, "node").groupBy("key").agg(F.xxhash64(F.max(F.struct("score", "node"))["node"]).alias("centre"), F.count("*").alias("rows"))
    stars = materialize(lookup(large.select("key", "node"), materialize(centres, "centres"), ["key"], ["centre"], "rows", "inner").select("centre", "node").distinct(), "stars")
    shared = materialize(stars.groupBy("node").agg(F.collect_set("centre").alias("centres")), "shared")

    few = members.where(F.col("size") <= small).join(shared, "node", "left")
    a, b = (few.select("key", F.col("node").alias(x), F.col("centres").alias(f"centres_{x}")) for x in "ab")
    apart = ~F.coalesce(F.arrays_overlap("centres_a", "centres_b"), F.lit(False))
    pairs = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & apart).select("a", "b").distinct()
    found = materialize(verified(pairs, sets, threshold), "links")

    def blocks(rows, n):
        by_size = F.greatest(F.ceil(rows / wide), F.ceil(n / (millions * 1_000_000)), F.least(F.ceil(rows / NARROW), F.lit(SPREAD)))
        return F.coalesce(by_size, F.lit(0)).cast("int")

    widths = sets.select("node", F.size("set").alias("width"))
    sized = stars.join(widths, "node").groupBy("centre").agg(F.count("*").alias("rows"), F.sum("width").alias("n"))
    groups = materialize(sized.select("centre", "rows", blocks(F.col("rows"), F.col("n")).alias("parts")), "groups")
    placed = lookup(stars, groups.withColumn("group", F.col("rows")), ["centre"], ["group", "parts"], "rows", "inner")
    chosen = placed.where(F.pmod(F.xxhash64("centre", "node"), F.col("group")) < PIVOT).join(sets, "node")
    pivots = chosen.groupBy("centre").applyInArrow(_pivot, "centre long, set array<long>").join(groups, "centre")
    pivots = pivots.select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("binary").alias("node"), "set")
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).join(sets, "node").select("centre", "part", "node", "set")
    measured = dealt.unionAll(pivots).groupBy("centre", "part").applyInArrow(lambda t: _measure(t, threshold), "centre long, node binary")
    lesser = F.array_sort(F.filter("centres", lambda c: c < F.col("centre")))
    core = materialize(measured.join(shared, "node").select("centre", "node", lesser.alias("lesser")), "core")
    kinds = core.groupBy("centre", "lesser").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    kinds = materialize(kinds, "kinds")
    few_kinds = kinds.groupBy("centre").agg(F.count("*").alias("k")).where(F.col("k") <= KINDS)
    known = kinds.join(few_kinds, "centre", "left_semi").groupBy("centre").applyInArrow(_core_links, "centre long, lesser array<long>, n long, links long, first binary")
    sure = materialize(lookup(core, materialize(known, "known"), ["centre", "lesser"], ["links", "first"], "n", "inner").select("centre", "node", "links", "first"), "sure")

    zones = sure.select("centre", "node", F.lit(True).alias("core")).unionAll(stars.join(sure, ["centre", "node"], "left_anti").select("centre", "node", F.lit(False)))
    at = lambda c, x: F.sum(F.when(F.col("core") == c, x))
    split = zones.join(widths, "node").groupBy("centre").agg(F.count("*").alias("rows"), at(True, 1).alias("a"), at(True, F.col("width")).alias("an"), at(False, 1).alias("b"), at(False, F.col("width")).alias("bn"))
    split = materialize(split.select("centre", "rows", blocks(F.col("a"), F.col("an")).alias("inner"), blocks(F.col("b"), F.col("bn")).alias("outer")).where("outer > 0"), "zones")
    dealt = lookup(zones, split, ["centre"], ["inner", "outer"], "rows", "inner")
    h, inner, outer = F.xxhash64("node"), F.col("inner"), F.col("outer")
    dealt = dealt.withColumn("block", F.when(F.col("core"), F.pmod(h, inner)).otherwise(inner + F.pmod(h, outer)).cast("int"))
    dealt = dealt.select("centre", "node", "block", F.explode(F.sequence(F.when(F.col("core"), inner).otherwise(F.lit(0)), inner + outer - 1)).alias("with"))
    dealt = dealt.select("centre", "node", "block", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"))
    compared = dealt.join(sets, "node").join(shared, "node").groupBy("centre", "x", "y").applyInArrow(lambda t: _compare(t, threshold), "node binary, other binary, n long")
    compared = materialize(compared, "compared")

    ends = found.select(F.col("a").alias("node"), F.lit(1).alias("n")).unionAll(found.select(F.col("b").alias("node"), F.lit(1).alias("n")))
    ends = ends.unionAll(compared.where("other is null").select("node", "n")).unionAll(sure.select("node", "links"))
    counts = ends.groupBy("node").agg(F.sum("n").alias("n_links")).where("n_links > 0")
    edges = found.unionAll(compared.where("other is not null").select("node", "other")).unionAll(sure.where("node <> first").select("node", "first"))
    return edges, counts


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """doc_id, key, class_id, n_links, n_copies, class_key, is_first (of its class) of every document of ``docs`` (see with_text_key)."""
    bands, rows = banding(threshold, recall)
    every = materialize(signatures(docs, bands, rows, size), "signatures")
    classes = every.where(F.col("node").isNotNull()).groupBy("node").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", TEXT_KEY)).alias("own_first"), F.first("bands").alias("bands"))
    classes = materialize(classes, "classes")
    found, ends = links(docs, classes, threshold)
    members = materialize(classes.select("node", "n", "own_first").join(components(found), "node").join(ends, "node"), "linked")
    least = materialize(members.groupBy("label").agg(F.min("own_first").alias("first"), F.count("*").alias("rows")), "least")
    named = lookup(members, least, ["label"], ["first"], "rows", "inner").select("node", "label", "first", "n_links")
    names = classes.select("node", "n", "own_first").join(named, "node", "left")
    names = materialize(names.select("node", "n", F.hex(F.coalesce("label", "node")).alias("class_key"), F.coalesce("first", "own_first").alias("first"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("n").alias("n_copies")), "names")
    out = lookup(every.drop("bands"), names, ["node"], ["class_key", "first", "n_links", "n_copies"], "n")
    alone = F.col("node").isNull()
    is_first = alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col(TEXT_KEY) == F.col(f"first.{TEXT_KEY}")))
    return out.select("doc_id", TEXT_KEY, F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), "class_key", is_first.alias("is_first"))


def op9_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(with_text_key(read_table(spark, sf_dir, "documents"))).drop(TEXT_KEY, "is_first")
