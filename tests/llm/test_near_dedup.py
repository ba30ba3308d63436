import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import connect, same
from tickforge.llm import near_dedup as nd
from tickforge.llm.common import TEXT_KEY, with_text_key

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=85):
    """rows: (doc_id, text) -> (doc_id, text, n_shingles, component_id, kept)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        x = find(i)
        if d is not None:
            least[x] = min(d, least.get(x, d))
    return sorted(((d, t, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, t), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "n", 1, "l", 2) for r in rows], "doc_id long, text string, node string, n_shingles int, label string, kept int")
    got = nd.near_components(with_text_key(docs), **options)
    keys = {r[0]: r[1] for r in docs.select(F.xxhash64("text"), "text").distinct().collect()}
    return sorted(((r.doc_id, keys[r[TEXT_KEY]], r.n_shingles, r.component_id, r.kept) for r in got.collect()), key=repr)


def edited(rng, words, edits):
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"w{rng.randrange(10**9)}"
    return " ".join(out)


def chosen(rng, n, least, most, edits):
    words = [f"b{rng.randrange(10**6)}" for _ in range(rng.randint(least, most))]
    return [edited(rng, words, rng.choice(edits)) for _ in range(n)]


def odd_rows(texts):
    rows = list(enumerate(texts))
    rows += [(None, texts[3]), (None, texts[3]), (None, "only null ids have these five words here"), (None, None), (2, texts[2]), (7, "another text with the id of seven"), (80, "A b C"), (81, "a B c"), (82, "a b"), (83, "É é x y z ß"), (84, "é É x y z ß")]
    return rows


@pytest.mark.parametrize(("small", "wide"), [(8, 2000), (1, 3)])
def test_odd_rows(spark, texts, monkeypatch, small, wide):
    monkeypatch.setattr(nd, "SMALL", small)
    monkeypatch.setattr(nd, "WIDE", wide)
    rows = odd_rows(texts)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("wide", [2000, 40])
def test_groups_of_all_kinds(spark, monkeypatch, wide):
    """Tight, loose and split groups, at the threshold and around it; chains whose ends are not alike."""
    monkeypatch.setattr(nd, "WIDE", wide)
    rng = random.Random(5)
    texts = chosen(rng, 90, 80, 120, [0, 1, 2]) + chosen(rng, 90, 90, 110, [2, 3, 4]) + chosen(rng, 60, 60, 70, [3, 4]) + chosen(rng, 40, 100, 130, [6, 8])
    chain = [f"c{i}" for i in range(150)]
    for i in range(40):  # each link of the chain changes one more word
        chain[3 * i] = f"d{i}"
        texts.append(" ".join(chain))
    texts += [f"{t} {t}" for t in texts[:5]] + [t.upper() for t in texts[5:10]] + texts[10:20]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(spark, rows) == brute(rows)


def test_other_thresholds(spark):
    rng = random.Random(6)
    rows = list(enumerate(chosen(rng, 60, 30, 60, [0, 1, 2, 3])))
    for threshold, size in ((60, 5), (95, 3)):
        global shingles
        own = shingles
        try:
            shingles = lambda t, size=size: own(t, size)
            assert found(spark, rows, threshold=threshold, size=size) == brute(rows, threshold)
        finally:
            shingles = own


def test_schedule_loses_what_it_may():
    least = nd.schedule(0.85, 1e-3, 150, 15)
    assert nd.missed(0.85, least, 15) <= 1e-3 < nd.missed(0.85, [m + 2 for m in least], 15)
    assert nd.missed(0.95, least, 15) < nd.missed(0.85, least, 15) < nd.missed(0.7, least, 15)
    rng = np.random.default_rng(3)
    for s in (0.7, 0.8):
        agree = rng.random((20000, 150)) < nd.agreement(s)
        a = np.zeros((20000, 150), np.uint8)
        kept = nd.surviving(a, np.where(agree, 0, 1).astype(np.uint8), least, 15)
        assert abs(1 - len(kept) / 20000 - nd.missed(s, least, 15)) < 0.015
    # The posterior is the share of the prior's mass, by counting.
    x = np.linspace(0, 1, 200001)
    density = x**12 * (1 - x) ** 3
    assert abs(density[x >= nd.agreement(0.85)].sum() / density.sum() - nd.posterior(15, 0.85)[12]) < 1e-4


def test_links_kept_and_lost(spark):
    """Of pairs just at the threshold none is lost, and none just below it is linked."""
    rng = random.Random(9)
    texts = []
    for i in range(150):
        n = rng.randint(40, 200)
        words = [f"p{i}x{k}" for k in range(n + 4)]  # n shingles
        cut = n * 15 // 100 if i % 2 else n * 15 // 100 + 1
        texts += [" ".join(words), " ".join(words[: n + 4 - cut])]  # n - cut of n in common
    got = found(spark, list(enumerate(texts)))
    linked = {r[0] for r in got if not r[4]}
    assert linked == {2 * i + 1 for i in range(150) if i % 2}


def test_deduplicate(spark, texts):
    rows = odd_rows(texts)
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row int")
    out = nd.deduplicate(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted({(d, t) for d, t, _, _, kept in brute(rows) if kept}, key=repr)
    assert nd.deduplicate(docs.where("false")).count() == 0


def test_query(spark):
    df = entry.queries()["op11_near_dedup"](spark, SF)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}
    same(df.toPandas(), connect(SF).execute(entry.oracle_sql()["op11_near_dedup"]).df())
