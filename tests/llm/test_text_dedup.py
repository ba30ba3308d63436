"""Line, byte-string and word-window deduplication and the near join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickforge.llm import line_dedup, near_join, substring_dedup, suffix_dedup
from tickforge.llm.anchors import LONG_WORD, cut_spans, word_codes
from tickforge.llm.common import TEXT_KEY, with_text_key

from .conftest import words


def sha(b):
    return hashlib.sha256(b).hexdigest()


def table(docs):
    """Different (id, text) pairs in the order of the operators: id, null first, then the hash of the text."""
    rows = with_text_key(docs).distinct().collect()
    return sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r[TEXT_KEY]))


def result(df, *cols):
    return sorted((tuple(r) for r in df.select("doc_id", *cols).collect()), key=repr)


def per_row(docs, by):
    """What each row of the table should get."""
    return sorted(((r.doc_id, *by[r.doc_id, r.text]) for r in docs.select("doc_id", "text").collect()), key=repr)


@pytest.mark.parametrize(("rule", "least"), [("frequent", 3), ("frequent", 10), ("first", 10)])
@pytest.mark.parametrize("parts", [1, 7])
def test_lines(spark, docs, rule, least, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
        rows = table(docs)
        where = defaultdict(list)
        for n, r in enumerate(rows):
            for i, x in enumerate((r.text or "").encode().split(b"\n")):
                where[key(x)].append((n, i))
        want = {}
        for n, r in enumerate(rows):
            lines = (r.text or "").encode().split(b"\n")
            if rule == "frequent":
                keep = [not key(x) or len({m for m, _ in where[key(x)]}) < least for x in lines]
            else:
                keep = [not key(x) or (n, i) == min(where[key(x)]) for i, x in enumerate(lines)]
            kept = b"\n".join(x for x, k in zip(lines, keep, strict=True) if k)
            want[r.doc_id, r.text] = (kept.decode(), len(lines), len(lines) - sum(keep))
        got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, least, rule))
        assert result(got, "text", "n_lines", "n_dropped") == per_row(docs, want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_lines_spread_over_partitions(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very same line\n"), (F.col("id") % 40).cast("string"), F.lit("\nown "), F.col("id").cast("string")).alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        got = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, 10)).collect()
        assert {r.text for r in got} == {f"own {i}" for i in range(3000)}
        first = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, 10, "first"))
        assert first.agg(F.sum("n_dropped")).first()[0] == 2999 + 3000 - 40
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_cut_documents_keeps_columns(docs):
    got = line_dedup.cut_documents(docs, line_dedup.keep_bitmaps(docs, 3))
    assert got.columns == docs.columns and got.count() == docs.count()


def bytes_brute(rows, size=100):
    seen, want = set(), {}
    for r in rows:
        b = (r.text or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - size + 1):
            w = b[p : p + size]
            if w in seen:
                gone[p] += 1
                gone[p + size] -= 1
            seen.add(w)
        gone = np.cumsum(gone)[: len(b)] > 0
        runs = int((gone[1:] & ~gone[:-1]).sum() + (len(b) and gone[0]))
        want[r.doc_id, r.text] = (len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return want


@pytest.mark.parametrize(("collection", "part"), [(1000, 500), (5, 2)])
def test_bytes(docs, collection, part):
    keyed = with_text_key(docs)
    got = cut_spans(keyed, suffix_dedup.later_spans(keyed, collection=collection, part=part), bytes, b"")
    assert result(got.withColumn("sha", F.sha2("kept", 256)), "n", "n_removed", "n_spans", "sha") == per_row(docs, bytes_brute(table(docs)))


def test_transform():
    rng = random.Random(5)
    for _ in range(60):
        segments = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 7))]
        symbol, common, segment, suffix = suffix_dedup.collection_bwt(segments)
        want = sorted((tuple(x + 1 for x in s[len(s) - n :]) + (0,), i, n) for i, s in enumerate(segments) for n in range(len(s) + 1))
        assert [(i, n) for _, i, n in want] == list(zip(segment.tolist(), suffix.tolist(), strict=True))
        assert [0 if n == len(segments[i]) else segments[i][len(segments[i]) - n - 1] + 1 for _, i, n in want] == symbol.tolist()
        for (a, *_), (b, *_), n in zip(want, want[1:], common.tolist()[1:], strict=False):
            assert n == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y or x == 0), 0)


def windows_brute(rows, size=35):
    count = Counter()
    split = {(r.doc_id, r.text): (r.text or "").encode().split() for r in rows}
    for w in split.values():
        count.update(tuple(w[p : p + size]) for p in range(len(w) - size + 1))
    want = {}
    for k, w in split.items():
        gone = set()
        for p in range(len(w) - size + 1):
            if count[tuple(w[p : p + size])] > 1:
                gone.update(range(p, p + size))
        want[k] = (len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return want


@pytest.mark.parametrize("wide", [1000, 1])
def test_windows(docs, wide):
    keyed = with_text_key(docs)
    got = cut_spans(keyed, substring_dedup.repeated_spans(keyed, wide=wide), bytes.split, b" ")
    assert result(got.withColumn("sha", F.sha2("kept", 256)), "n", "n_removed", "sha") == per_row(docs, windows_brute(table(docs)))


def test_levels():
    assert substring_dedup.levels(35, 9) == [18, 35] and substring_dedup.levels(40, 5) == [10, 20, 40]


def near_brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                label[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    ids = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((doc, doc if not sets[i] else ids[find(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("small", "wide"), [(12, 1000), (2, 1000), (2, 3)])
def test_near(docs, monkeypatch, small, wide):
    monkeypatch.setattr(near_join.links, "__defaults__", (0.8, small, 2, wide))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(near_join.near_classes(with_text_key(docs)), "class_id") == near_brute(rows)


@pytest.mark.parametrize("wide", [1000, 8])
def test_large_near_group(spark, monkeypatch, wide):
    """Many near copies of one text, few of which are near each other."""
    monkeypatch.setattr(near_join.links, "__defaults__", (0.8, 12, 3, wide))
    rng = random.Random(3)
    base = words(rng, 120).split()
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"new{rng.random()}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, words(rng, 90)) for i in range(40)]
    got = near_join.near_classes(with_text_key(spark.createDataFrame(rows, "doc_id long, text string")))
    assert result(got, "class_id") == near_brute(rows)
    links = {r.doc_id: r.n_links for r in got.collect()}
    assert all(links[i] for i in range(80) if (i, 0) in near_brute(rows)[1:]) and not any(links[100 + i] for i in range(40))


@pytest.mark.parametrize(("small", "wide"), [(12, 1000), (12, 8), (2, 8)])
def test_links_of_large_groups(spark, monkeypatch, small, wide):
    """Every link of buckets over ``small`` nodes counts, also between nodes that a third one connects already."""
    monkeypatch.setattr(near_join.links, "__defaults__", (0.8, small, 3, wide))
    rng = random.Random(5)
    rows = []
    for g, n in ((0, 60), (1, 25), (2, 4)):
        base = words(rng, 120).split()
        for i in range(n):
            w = list(base)
            for _ in range(i % 4):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            rows.append((100 * g + i, " ".join(w)))
    sets = {i: frozenset(zip(*[t.split()[k:] for k in range(5)])) for i, t in rows}
    nodes = {s: i for i, s in sets.items()}
    want = {i: sum(s != sets[i] and len(s & sets[i]) >= 0.8 * len(s | sets[i]) - 1e-9 for s in nodes) for i in sets}
    assert max(want.values()) > 12
    got = near_join.near_classes(with_text_key(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {r.doc_id: r.n_links for r in got.collect()} == want
    assert result(got, "class_id") == near_brute(rows)


def test_first_of_each_near_class(spark):
    """Unrelated documents stay, also with null ids or one id for several texts; wordless ones are never copies of each other."""
    import corpus_pipeline as cp

    rng = random.Random(11)
    a, b, c, d, e, f = (words(rng, 60) for _ in range(6))
    rows = [(None, a), (None, b), (None, b + " more"), (7, c), (7, d), (9, d + " more"), (3, e), (None, e + " more"), (2, e + " other"), (4, ""), (5, None), (4, " "), (7, d), (None, f), (8, f)]
    got = cp.one_of_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    got = [tuple(r) for r in got.collect()]
    one_b = [r for r in got if r[1] in (b, b + " more")]
    want = [(None, a), (7, c), (7, d), (2, e + " other"), (4, ""), (4, " "), (5, None), (8, f)]
    assert len(one_b) == 1 and sorted((r for r in got if r not in one_b), key=repr) == sorted(want, key=repr)


def test_banding():
    bands, rows = near_join.banding(0.8, 0.99999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99999


def test_empty_tables(empty):
    keyed = with_text_key(empty)
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0
    assert cut_spans(keyed, suffix_dedup.later_spans(keyed), bytes, b"").count() == 0
    assert cut_spans(keyed, substring_dedup.repeated_spans(keyed), bytes.split, b" ").count() == 0
    assert near_join.near_classes(keyed).count() == 0


def test_lookup_spreads_a_hot_key(spark, tmp_path):
    """One key holds four of five rows: its rows are dealt over all partitions by a salt that stays in the plan."""
    from tickforge.llm.common import lookup

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(50_000).select(F.when(F.col("id") % 5 != 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        left.groupBy("k").agg(F.count("*").alias("n")).write.parquet(str(tmp_path / "right"))
        right = spark.read.parquet(str(tmp_path / "right")).withColumn("c", F.col("n") + 1)
        got = lookup(left, right, ["k"], ["c"], "n")
        assert "_salt" in next(x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(k" in x)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 15_000 and got.count() == 50_000
        assert got.where("c <> if(k = 0, 40002, 2)").count() == 0
        assert lookup(left.unionAll(left.limit(3).withColumn("k", F.lit(-1))), right, ["k"], ["c"], "n", "inner").count() == 50_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tight_group_is_not_compared(spark):
    """Near copies of one text: all links are counted from the core's size."""
    rng = random.Random(13)
    base = [w + str(i) for i, w in enumerate(words(rng, 300).split())]
    rows = []
    for i in range(120):
        w = list(base)
        w[(i * 7) % 290] = f"new{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_join.near_classes(with_text_key(docs)).toPandas()
    assert (got.n_links == 119).all() and (got.class_id == 0).all() and got.class_key.nunique() == 1
    import pyarrow as pa

    hashes, sizes = near_join.shingle_sets(pa.array([t for _, t in rows]), 5)
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    t = pa.table({"centre": pa.array([1] * 120), "node": pa.array([str(i).encode() for i in range(120)], pa.binary()), "set": pa.ListArray.from_arrays(ends, hashes.view(np.int64))})
    pivot = near_join._pivot(t.slice(0, 31))
    with_pivot = pa.concat_tables([t, pivot.add_column(1, "node", pa.nulls(1, pa.binary()))])
    assert near_join._measure(with_pivot, 0.8).num_rows == 120


def test_word_codes_are_those_of_the_words():
    rng = random.Random(5)
    texts = [None, "", " ", "a", "ab c", "\u00e9 \u00fc x\x0by", "\t\n", "x" * 300 + " y", "12345678 123456789 1234567\x00 1234567", "a b"]
    texts += ["".join(rng.choice("ab \n\u00e9\u00a0\u2003") for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += ["w" * n for n in range(LONG_WORD - 9, LONG_WORD + 9)]
    array = pa.array(texts)
    seen: dict[str, int] = {}
    for part in (array, array.slice(3), array.slice(4, 3), array.cast(pa.large_string())):
        codes, counts = word_codes(part)
        words = [re.findall("[^\x20\x09-\x0D]+", t or "") for t in part.to_pylist()]
        assert counts.tolist() == [len(w) for w in words]
        for w, c in zip([w for each in words for w in each], codes.tolist(), strict=True):
            assert seen.setdefault(w, c) == c
    assert len(set(seen.values())) == len(seen)
    for none in ([], [None], ["", None, " "]):
        codes, counts = word_codes(pa.array(none, pa.string()))
        assert len(codes) == 0 and counts.tolist() == [0] * len(none)
