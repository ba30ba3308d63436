import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import connect, same
from tickforge.llm import merkle

SF = "/root/testdata/sf0.001"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def up(nodes, fan=16):
    """All levels of a tree."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def path(tree, i, fan=16):
    steps = []
    for level in tree[:-1]:
        first = i // fan * fan
        run = level[first : first + fan]
        steps.append((run[: i - first], run[i - first + 1 :]))
        i //= fan
    return steps


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r, leaf(r)))
    trees, tops = {}, []
    for g in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = up([x[1] for x in groups[g]])
        tops.append(trees[g][-1][0])
    top = up(tops)
    root, out = top[-1][0], []
    for k, (g, tree) in enumerate(trees.items()):
        for i, (r, h) in enumerate(groups[g]):
            steps = path(tree, i) + path(top, k)
            now = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for before, after in steps:
                now = H([*before, now, *after])
            out.append((r[0], h, tree[-1][0], root, H(x for b, a in steps for x in [*b, *a]), now, now == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def query(spark, rows, tmp_path):
    extra = ", ".join(f"{c} string" for c in ("leaf", "tree", "place", "block"))
    spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {extra}").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["op13_merkle_manifest"](spark, str(tmp_path))
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_odd_rows(spark, tmp_path):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(700)]
    rows += [(i, f"s{i % 23}", None, None, "É A\n" * (i % 3)) for i in range(700, 800)]
    rows += [(900 + i, None, "de", 1, None) for i in range(17)] + [(None, "lone", None, None, None)]
    rows += [(5, "hot", "en", 5, "Text 5")] * 3 + [(5, "hot", "en", 5, "other"), (None, "hot", None, 3, ""), (None, "hot", None, 3, "B"), (3000, "é", "a", 0, "x" * 100000)]
    assert query(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_few_rows(spark, tmp_path, n):
    rows = [(i, "s", "en", 1, "A") for i in range(n)]
    assert query(spark, rows, tmp_path) == (brute(rows) if rows else [])


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 4095, 4096])
def test_traversal(n):
    leaves = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    tree = up(leaves)
    walk = merkle.Traversal([x.encode() for x in leaves], len(tree) - 1)
    assert walk.root().decode() == tree[-1][0]
    for i, steps in enumerate(walk):
        assert [([x.decode() for x in run[:at]], [x.decode() for x in run[at + 1 :]]) for run, at in steps] == path(tree, i), i


def test_short_block_of_a_tall_tree():
    """Such a block has all its levels, each node the hash of the one below."""
    walk = merkle.Traversal([b"x"], 3)
    assert walk.root().decode() == H([H([H("x")])])
    assert [[(run[:at], run[at + 1 :]) for run, at in steps] for steps in walk] == [[([], [])] * 3]


def test_traversal_keeps_little():
    leaves = [hashlib.sha256(str(i).encode()).hexdigest().encode() for i in range(4096)]
    walk = merkle.Traversal(leaves, 3)
    assert all(sum(map(len, walk.existing)) <= 3 * 16 for _ in walk)


def test_many_blocks(spark, monkeypatch):
    """Blocks of 16 leaves: the upper levels are made by Spark, over several of them."""
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    rows = [(i, "hot" if i % 3 else f"s{i % 40}", "en", i, f"Text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    leaves = docs.select("doc_id", F.col("source").alias("tree"), merkle.leaf([F.col(c) for c in merkle.COLUMNS]).alias("leaf"), F.lit(None).cast("string").alias("changed"))
    got = {r.doc_id: r for r in merkle.manifest(leaves).collect()}
    want = brute(rows)
    assert len(got) == len(want)
    for doc_id, h, subroot, root, proof, _, _ in want:
        r = got[doc_id]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) == (h, subroot, root, proof, root, True)


def test_query(spark):
    df = entry.queries()["op13_merkle_manifest"](spark, SF)
    assert dict(df.dtypes) == {c: "boolean" if c == "verified" else "bigint" if c == "doc_id" else "string" for c in COLUMNS}
    got = df.toPandas()
    same(got, connect(SF).execute(entry.oracle_sql()["op13_merkle_manifest"]).df())
    rows = connect(SF).execute("select doc_id, source, lang, n_chars, text from documents").fetchall()
    assert sorted((tuple(r) for r in got[COLUMNS].itertuples(index=False)), key=repr) == brute(rows)
    assert 0 < (~got.verified).sum() < len(got) / 3
