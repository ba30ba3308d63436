"""Merkle manifest of a dataset: every row's leaf, its authentication path and the root that answers for all rows.

The tree: the leaves of a group (a source) ascend by id; runs of ``FAN`` consecutive nodes become their hash, level by level,
down to one node, the group's subroot; the subroots, in order of the groups, become the root in the same way.

1. Leaves are hashed by Spark.  Their places come from ``sorted_places``: a group may have any share of the rows.
2. A block is an aligned subtree of FAN ** HEIGHT leaves.  A first pass gives each block's root.
3. ``climb`` makes the upper levels, one aggregate each, over one row a block, and gives each block its path above.
4. ``Traversal`` goes through a block once more and emits the paths of successive leaves, as fractal traversal does: for each level the
   run that the path lies in (the existing subtree) is kept, and the run that comes next (the desired one) is built beside it, a leaf a step,
   so that it is there when the path crosses over.  Besides the block's leaves it holds two runs a level.  The block's path above is appended.

Only the root, one row, comes to the driver.

Defined results: fields are null (``-``) or counted in UTF-8 bytes, so that no two rows have one encoding; ids ascend nulls first; of rows with one id the
lesser leaf comes first, and repeated rows are leaves of their own; a null group is the first; an empty table has no leaf
and no row; a group of one leaf has it as subroot, and a lone subroot is the root; columns that are missing count as null, others are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.positions import sorted_places
from .common import materialize, read_table, released

FAN = 16
#: Levels of a block: 4096 leaves, some hundred KB.
HEIGHT = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(nodes: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


def field(x: Column) -> Column:
    x = x.cast("string")
    return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(x) for x in values]).cast("binary"), 256)


def levels(n: int, limit: int) -> int:
    """Levels above n nodes, at most ``limit``."""
    found = 0
    while n > 1 and found < limit:
        n, found = -(-n // FAN), found + 1
    return found


class Desired:
    """The run of one level that begins above leaf ``at``, built a leaf at a time."""

    def __init__(self, leaves: list[bytes], level: int, at: int):
        self.leaves, self.level, self.at = leaves, level, at
        self.end = min(at + FAN ** (level + 1), len(leaves))
        self.parts: list[list[bytes]] = [[] for _ in range(level + 1)]

    def step(self) -> None:
        if self.at < self.end:
            self.parts[0].append(self.leaves[self.at])
            self.at += 1
            self._close(last=self.at == len(self.leaves))

    def _close(self, last: bool) -> None:
        for k in range(self.level):
            if self.parts[k] and (last or len(self.parts[k]) == FAN):
                self.parts[k + 1].append(_hash(self.parts[k]))
                self.parts[k] = []

    def run(self) -> list[bytes]:
        while self.at < self.end:
            self.step()
        return self.parts[self.level]


class Traversal:
    """The paths of a block's leaves, one after the other: for each level the run that holds the path's node, and the node's place in it."""

    def __init__(self, leaves: list[bytes], height: int):
        self.leaves, self.height = leaves, height
        self.existing = [Desired(leaves, k, 0).run() for k in range(height)]

    def root(self) -> bytes:
        return _hash(self.existing[-1]) if self.height else self.leaves[0]

    def __iter__(self):
        desired = [Desired(self.leaves, k, FAN ** (k + 1)) for k in range(self.height)]
        for i in range(len(self.leaves)):
            yield [(self.existing[k], i // FAN**k % FAN) for k in range(self.height)]
            for k, d in enumerate(desired):
                d.step()
                if (i + 1) % FAN ** (k + 1) == 0:
                    self.existing[k] = d.run()
                    desired[k] = Desired(self.leaves, k, i + 1 + FAN ** (k + 1))


def _height(block: int, n: int) -> int:
    """Levels inside a block: all of them if the group has other blocks."""
    return HEIGHT if block else levels(n, HEIGHT)


def _sorted(t: pa.Table) -> pa.Table:
    return t.sort_by("place").combine_chunks()


def _block_root(t: pa.Table) -> pa.Table:
    t = _sorted(t)
    leaves, block = t["leaf"].cast(pa.binary()).to_pylist(), t["block"][0].as_py()
    root = Traversal(leaves, _height(block, len(leaves))).root()
    return pa.table({"tree": t["tree"].slice(0, 1), "idx": t["block"].slice(0, 1), "digest": pa.array([root.decode()])})


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes: tree, idx (0-based, gapless), digest -> tree, root; and tree, idx, path: the runs from a node up to its tree's root, with its place in each.

    Each level is one aggregate of groups of FAN rows; the levels are as many as the largest tree has.
    """
    sizes = nodes.groupBy("tree").agg((F.max("idx") + 1).alias("count"))
    level = materialize(nodes.join(sizes.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree"), "nodes")
    most = level.agg(F.max("count")).first()[0] or 0
    paths = level.select("tree", "idx", F.lit(None).cast("array<struct<place:int,run:array<string>>>").alias("path"))
    paths = paths.withColumn("path", F.coalesce("path", F.array().cast("array<struct<place:int,run:array<string>>>")))
    roots = level.where("count = 1").select("tree", F.col("digest").alias("root"))
    width = 1
    while most > 1:
        run = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])
        runs = level.where("count > 1").groupBy("tree", F.floor(F.col("idx") / FAN).alias("up")).agg(run.alias("run"), F.max("count").alias("count"))
        runs = materialize(runs, "runs")
        own = runs.select(F.col("tree").alias("_tree"), F.col("up").alias("_up"), "run")
        at = F.floor(F.col("idx") / width)
        joined = paths.withColumn("_at", at).join(own, F.col("tree").eqNullSafe(F.col("_tree")) & (F.floor(F.col("_at") / FAN) == F.col("_up")), "left")
        step = F.when(F.col("run").isNull(), F.col("path")).otherwise(F.concat("path", F.array(F.struct((F.col("_at") % FAN).cast("int").alias("place"), "run"))))
        paths = joined.select("tree", "idx", step.alias("path"))
        level = runs.select("tree", F.col("up").alias("idx"), F.sha2(F.array_join("run", "").cast("binary"), 256).alias("digest"), F.ceil(F.col("count") / FAN).alias("count"))
        roots = roots.unionAll(level.where("count = 1").select("tree", F.col("digest").alias("root")))
        width, most = width * FAN, -(-most // FAN)
    return roots, materialize(paths, "paths")


def _proofs(t: pa.Table, above: pa.Table, root: bytes) -> pa.Table:
    """The rows of a block's leaves: path hashed, root folded from the leaf as it is now."""
    t = _sorted(t)
    leaves, now = (t[c].cast(pa.binary()).to_pylist() for c in ("leaf", "changed"))
    upper = [([x.encode() for x in s["run"]], s["place"]) for s in above["path"][0].as_py()]
    tail = b"".join(x for run, at in upper for k, x in enumerate(run) if k != at)
    proofs, folded = [], []
    for own, other, path in zip(leaves, now, Traversal(leaves, _height(t["block"][0].as_py(), len(leaves))), strict=True):
        digest = hashlib.sha256()
        node = own if other is None else other
        for run, at in path:
            before, after = b"".join(run[:at]), b"".join(run[at + 1 :])
            digest.update(before + after)
            node = hashlib.sha256(before + node + after).hexdigest().encode()
        digest.update(tail)
        for run, at in upper:
            node = _hash([*run[:at], node, *run[at + 1 :]])
        proofs.append(digest.hexdigest())
        folded.append(node.decode())
    n = len(leaves)
    subroot = above["subroot"][0].as_py()
    return pa.table({"doc_id": t["doc_id"], "leaf": t["leaf"], "subroot": pa.array([subroot] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})


def manifest(leaves: DataFrame) -> DataFrame:
    """leaves: doc_id, tree (the group), leaf, changed (the leaf of the row as it is now; null: as it was).

    Gives doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.
    """
    # Ranges are found by a pass of its own over what is sorted: the leaves are written first, so that texts are read and hashed once.
    written = materialize(leaves.select(F.col("doc_id").cast("long").alias("doc_id"), "tree", "leaf", "changed"), "hashed")
    order = sorted_places(written, ["tree"], ["doc_id", "leaf"], "place")
    placed = materialize(order.withColumn("block", F.floor(F.col("place") / FAN**HEIGHT)), "leaves")
    # A block's number alone could meet in one task what belongs to many groups, and a null group is a group.
    group = ["tree", "block"]
    blocks = placed.select("tree", "block", "place", "leaf").groupBy(*group).applyInArrow(_block_root, "tree string, idx long, digest string")
    subroots, inner = climb(materialize(blocks, "blocks"))
    groups = sorted_places(subroots, [], ["tree"], "idx").select(F.lit("all").alias("tree"), F.col("tree").alias("group"), "idx", F.col("root").alias("digest"))
    groups = materialize(groups, "groups")
    roots, outer = climb(groups.select("tree", "idx", "digest"))
    root = next((r["root"] for r in roots.collect()), "")  # one row
    named = groups.select("group", F.col("idx").alias("_idx"), F.col("digest").alias("subroot")).join(outer.select(F.col("idx").alias("_idx"), F.col("path").alias("outer")), "_idx")
    above = inner.join(named, F.col("tree").eqNullSafe(F.col("group"))).select("tree", F.col("idx").alias("block"), "subroot", F.concat("path", "outer").alias("path"))
    token = root.encode()
    proofs = placed.groupBy(*group).cogroup(above.groupBy(*group)).applyInArrow(lambda a, b: _proofs(a, b, token), "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proofs.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def with_columns(docs: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    return docs.select(*[F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in columns])


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_columns(read_table(spark, sf_dir, "documents"))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    cols = [F.col(c) for c in COLUMNS]
    changed = F.when(tampered, leaf([*cols[:-1], F.translate("text", upper, lower)]))
    return manifest(docs.select("doc_id", F.col("source").cast("string").alias("tree"), leaf(cols).alias("leaf"), changed.alias("changed")))


#: One level a round; a path is a list of what stands before and after the own node in each run.
SQL = """
with recursive
fields as (
  select doc_id, source, text,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
    xor(4294967295, list_reduce([4294967295::bigint] || list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint),
      lambda a, b: list_reduce([xor(a, b)] || list_transform(range(8), lambda x: x::bigint), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))))) as crc
  from documents),
leaves as (
  select doc_id, source as tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(text) || ':' || case when crc % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end, '-')) as now
  from fields),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by tree) as n from leaves),
nodes as (
  select tree, 0 as lvl, place as idx, leaf as digest, n from placed
  union all
  select tree, lvl + 1, idx // 16, sha256(string_agg(digest, '' order by idx)), max((n + 15) // 16) from nodes where n > 1 group by tree, lvl, idx // 16),
subroots as (
  select tree, digest as subroot, row_number() over (order by tree nulls first) - 1 as place, count(*) over () as n from nodes where n = 1),
tops as (
  select 0 as lvl, place as idx, subroot as digest, n from subroots
  union all
  select lvl + 1, idx // 16, sha256(string_agg(digest, '' order by idx)), max((n + 15) // 16) from tops where n > 1 group by lvl, idx // 16),
runs as (select tree, lvl, idx // 16 as up, list(digest order by idx) as run from nodes where n > 1 group by tree, lvl, idx // 16),
top_runs as (select lvl, idx // 16 as up, list(digest order by idx) as run from tops where n > 1 group by lvl, idx // 16),
steps as (
  select doc_id, leaf, p.tree, p.place as row, lvl as seq, run, (p.place // cast(16 ** lvl as bigint)) % 16 as own
  from placed p join runs r on p.tree is not distinct from r.tree and p.place // cast(16 ** (lvl + 1) as bigint) = r.up
  union all
  select doc_id, leaf, p.tree, p.place, 1000 + lvl, run, (s.place // cast(16 ** lvl as bigint)) % 16
  from placed p join subroots s on p.tree is not distinct from s.tree join top_runs r on s.place // cast(16 ** (lvl + 1) as bigint) = r.up),
sides as (select tree, row, seq, array_to_string(run[1:own], '') as before, array_to_string(run[own + 2:], '') as after from steps),
paths as (select tree, row, string_agg(before || after, '' order by seq) as siblings, list(before || '#' || after order by seq) as path from sides group by tree, row),
folded as (
  select p.doc_id, p.leaf, s.subroot, (select digest from tops where n = 1) as root, sha256(coalesce(x.siblings, '')) as proof_sha256,
    list_reduce([p.now] || coalesce(x.path, []), lambda a, b: sha256(split_part(b, '#', 1) || a || split_part(b, '#', 2))) as folded_root
  from placed p join subroots s on p.tree is not distinct from s.tree left join paths x on p.tree is not distinct from x.tree and p.place = x.row)
select *, folded_root = root as verified from folded
"""
