"""The registered queries: SQL where there is some, and the pipeline against a plain restatement."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import connect, same
from tickforge.llm import near_join

from .test_models import distance

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_line_dedup", "op7_substring_dedup"])
def test_sql(spark, name):
    same(entry.queries()[name](spark, SF).toPandas(), connect(SF).execute(entry.oracle_sql()[name]).df())


def test_registered():
    names = {n for n in entry.queries() if n.startswith("op")}
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_pipeline(spark):
    import corpus_pipeline as cp
    from tickforge.llm import decontaminate, line_dedup, packing, toxicity
    from tickforge.llm.common import read_table

    from .test_text_dedup import near_brute

    docs = read_table(spark, SF, "documents")
    model = toxicity.train(docs, read_table(spark, SF, "labels"))
    rows = {r.doc_id: r.text for r in docs.collect() if model.score(r.text or "") < toxicity.THRESHOLD}
    key = line_dedup.line_key
    found = {}
    for i, t in rows.items():
        for x in t.encode().split(b"\n"):
            found.setdefault(key(x), set()).add(i)
    rows = {i: b"\n".join(x for x in t.encode().split(b"\n") if not key(x) or len(found[key(x)]) < line_dedup.MIN_DOCS).decode() for i, t in rows.items()}
    rows = {i: rows[i] for i, c in near_brute(sorted(rows.items())) if i == c}
    matcher = decontaminate.Matcher([tuple(r) for r in read_table(spark, SF, "benchmark").collect()])
    rows = {i: t for i, t in rows.items() if not matcher.match(decontaminate.normalise(t))}
    want = packing.pieces(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    got = cp.run(spark, SF)
    columns = want.columns
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.collect()))
    staged = docs
    for _, stage in cp.STAGES[:-1]:
        staged = stage(spark, staged, SF)
        assert staged.columns == docs.columns
    assert got.agg(F.count_distinct("doc_id")).first()[0] == len(rows)


# ---- the registered queries themselves, on whole tables ---------------------------------------------------------------

TYPES = {
    "op1_langid": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op3_decontaminate": {"doc_id": "bigint", "item_id": "bigint", "distance": "int", "end": "bigint"},
    "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_media_columns": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op6_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op7_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op8_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op9_near_join": {"doc_id": "bigint", "class_id": "bigint", "n_links": "bigint"},
    "op10_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


@pytest.fixture(scope="module")
def rows():
    con = connect(SF)
    return {t: con.execute(f"select * from {t}").df() for t in ("documents", "pages", "benchmark", "labels")}


@pytest.fixture(scope="module")
def results(spark):
    got = {}

    def result(name):
        if name not in got:
            df = entry.queries()[name](spark, SF)
            kinds = dict(df.dtypes)
            assert {c: kinds[c] for c in TYPES[name]} == TYPES[name]
            got[name] = df.toPandas()
        return got[name]

    return result


def _texts(rows):
    return {int(i): "" if t is None else t for i, t in zip(rows["documents"].doc_id, rows["documents"].text, strict=True)}


def test_op1_op4(results, rows):
    for name in ("op1_langid", "op4_toxicity"):
        got = results(name)
        assert sorted(got.doc_id) == sorted(rows["documents"].doc_id)
        assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(got.doc_id, got.held_out, strict=True)) and got.score.between(0, 1).all()
    assert ((results("op4_toxicity").score >= 0.3).astype(int) == results("op4_toxicity").predicted).all()
    texts = _texts(rows)
    und = {i for i, t in texts.items() if not any(c.isalpha() for c in t)}
    got = results("op1_langid")
    assert set(got[got.lang_pred == "und"].doc_id) == und and set(got.lang_pred) - {"und"} <= set(rows["documents"].lang.dropna())


def test_op3(results, rows):
    """Every hit is one, by plain dynamic programming; no item is missed that a document holds whole."""
    from tickforge.llm.decontaminate import normalise

    got, texts = results("op3_decontaminate"), {i: normalise(t) for i, t in _texts(rows).items()}
    items = {int(i): normalise(t) for i, t in zip(rows["benchmark"].item_id, rows["benchmark"].text, strict=True)}
    found = set(zip(got.doc_id, got.item_id, strict=True))
    assert {(d, i) for d, t in texts.items() for i, p in items.items() if p and p in t} <= found and len(got) == len(found)
    for r in got.head(30).itertuples():
        p = items[r.item_id]
        t = texts[r.doc_id][max(0, r.end - 2 * len(p)) : r.end]
        assert distance(p, t) == r.distance <= int(0.1 * len(p))


def test_op5(results, rows):
    got, texts = results("op5_media_columns").set_index("doc_id"), _texts(rows)
    assert len(got) == len(texts)
    for i, t in texts.items():
        data, r = t.encode(), got.loc[i]
        padded = data + b" " * (-len(data) % 192 or (0 if data else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
        assert len(r.feature) == 16 and r.media_bytes > 0


def test_op6(results, rows):
    from .test_text_dedup import bytes_brute

    class Row:
        def __init__(self, i, t):
            self.doc_id, self.text = i, t

    want = bytes_brute([Row(i, t) for i, t in sorted(_texts(rows).items())])
    got = results("op6_suffix_dedup")
    assert {(r.doc_id): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.itertuples()} == {k[0]: v for k, v in want.items()}


def test_op8(results, rows):
    html = {int(i): ("" if h is None else h).encode() for i, h in zip(rows["pages"].page_id, rows["pages"].html, strict=True)}
    best = {}
    for i, h in html.items():
        best[h] = max(best.get(h, i), i)
    got = results("op8_warc")
    want = {(i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if best[h] == i else "revisit", -1 if best[h] == i else best[h]) for i, h in html.items()}
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to != r.refers_to else int(r.refers_to)) for r in got.itertuples()} == want and len(got) == len(html)


def test_op9(spark, results, rows):
    """Classes and links of all pairs, here and on a larger table."""
    from .test_text_dedup import near_brute

    got = results("op9_near_join")
    assert sorted(zip(got.doc_id, got.class_id, strict=True), key=repr) == near_brute(sorted(_texts(rows).items()))
    docs = connect("/root/testdata/sf0.01").execute("select doc_id, text from documents").fetchall()
    sets = {}
    for i, t in docs:
        w = (t or "").encode().split()
        s = frozenset(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        if s:
            sets.setdefault(s, []).append(i)
    nodes = list(sets)
    having = {}
    for n, s in enumerate(nodes):
        for x in s:
            having.setdefault(x, []).append(n)
    links = {}
    for n, s in enumerate(nodes):
        both = Counter(m for x in s for m in having[x])
        links[n] = sum(m != n and c >= 0.8 * (len(s) + len(nodes[m]) - c) - 1e-9 for m, c in both.items())
    got = near_join.op9_near_join(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    want = {i: links[n] for n, s in enumerate(nodes) for i in sets[s]}
    found = sum(min(got.loc[i].n_links, k) for i, k in want.items())
    assert found >= 0.99 * sum(want.values()) and all(got.loc[i].n_links <= k for i, k in want.items())
    assert sum(k > 0 for k in want.values()) > 10


def test_op10(results, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tickforge.llm import packing

    whole = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    got = results("op10_packing")
    by = {i: g.sort_values("start") for i, g in got.groupby("doc_id")}
    texts = _texts(rows)
    assert set(by) == set(texts)
    for i, t in texts.items():
        ids, at = np.array([*whole.encode(t, add_special_tokens=False).ids, 1], "<u4"), 0
        for r in by[i].itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == list(np.cumsum([0, *g.length])[:-1]) and g.length.sum() <= 2048
    total = got.groupby("sequence_id").length.sum().to_numpy()
    assert sorted(set(got.sequence_id)) == list(range(len(total)))
    assert 1 - total.sum() / packing.taken(total, 2048).sum() < 0.02


def test_empty_documents(spark):
    """Every stage of the pipeline takes an empty table and keeps its columns."""
    import corpus_pipeline as cp
    from tickforge.llm.common import read_table

    docs = read_table(spark, SF, "documents").where("false")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == read_table(spark, SF, "documents").columns and docs.count() == 0
    assert cp.STAGES[-1][1](spark, docs, SF).count() == 0


def test_stages_with_odd_rows(spark):
    """Null ids and texts, repeated rows, one id with two texts, and columns whose names the operators use too."""
    import corpus_pipeline as cp
    from tickforge.llm.common import read_table

    base = read_table(spark, SF, "documents").withColumns({"score": F.lit("s"), "value": F.lit(1), "h": F.lit(2), "n": F.lit(3)})
    odd = base.limit(3)
    docs = base.unionAll(odd).unionAll(odd.withColumn("doc_id", F.lit(None).cast("long"))).unionAll(odd.withColumn("text", F.lit(None).cast("string"))).unionAll(odd.withColumn("text", F.concat("text", F.lit(" zzz own words of this row only"))))
    before = docs.count()
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == base.columns
        if name == "line_dedup":
            assert docs.count() <= before
    assert docs.where("doc_id is null and text is null").count() == 0 and cp.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
