import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import connect, same
from tickforge.llm import fill_middle as fm

SF = "/root/testdata/sf0.001"


def brute(doc_id, text, seed="1:"):
    t = text or ""
    h = hashlib.sha256((seed + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(t), "plain", None, None, t
    pre, mid, suf = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return len(t), "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return len(t), "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


ODD = [None, "", "a", "<", "<<P", "x<P>y", "a<S>", "<M>", "\U0001f600é́\r\n\x00 ", "<P<S<M" * 5, "P>S>M>", "\n\n", "long é " * 30000, "$1 \\Q[a]"]


def test_against_brute_force(spark):
    rows = [(i, t) for i in [*range(40), None, -7, 2**62] for t in ODD]
    docs = spark.createDataFrame([(i, t, "f", 7, "o", -1) for i, t in rows], "doc_id long, text string, form string, n int, output string, prefix_chars int")
    out = fm.transformed(docs).withColumn("back", fm.restored(F.col("output"), F.col("form")))
    got = sorted(((r.doc_id, r.text, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.back) for r in out.collect()), key=repr)
    assert got == sorted(((i, t, brute(i, t), t or "") for i, t in rows), key=repr)
    assert {g[2][1] for g in got} == {"plain", "psm", "spm"}
    assert fm.transformed(docs.where("false")).count() == 0


def test_other_units_and_sentinels(spark):
    docs = spark.createDataFrame([(i, f"one two  three\nfour {i}") for i in range(60)] + [(60, "  leading space")], "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    out = fm.transformed(docs, unit=r"\S+\s*", rate=100, suffix_first=50, seed="2:", sentinels=marks)
    rows = out.withColumn("back", fm.restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r.back == r.text for r in rows)
    assert {r.form for r in rows if r.doc_id < 60} == {"psm", "spm"} and {r.n for r in rows if r.doc_id < 60} == {5}
    assert [r.form for r in rows if r.doc_id == 60] == ["plain"]  # its units would lose what stands before them
    for bad in (("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("aa", "b", "c"), ("", "b", "c"), ("<P>", "<P>x", "m")):
        with pytest.raises(ValueError):
            fm.checked(bad)


def test_query(spark):
    df = entry.queries()["op12_fill_middle"](spark, SF)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output_sha256": "string", "restored_sha256": "string"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    got = df.toPandas()
    same(got, connect(SF).execute(entry.oracle_sql()["op12_fill_middle"]).df())
    texts = dict(connect(SF).execute("select doc_id, text from documents").fetchall())
    for r in got.itertuples():
        n, form, a, b, output = brute(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.output_sha256, r.restored_sha256) == (n, form, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest())
