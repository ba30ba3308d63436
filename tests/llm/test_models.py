"""Language identification, toxicity, decontamination, media, archives, packing."""

import functools
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import decontaminate, langid, media, packing, toxicity, warc
from tickforge.llm.common import new_path

from .conftest import words


def context_counts(texts, order=3):
    """How often each byte follows each context of 0 to ``order`` bytes."""
    counts = {}
    for t in texts:
        data = b"\n" * order + t
        for i in range(order, len(data)):
            for k in range(order + 1):
                own = counts.setdefault(data[i - k : i], {})
                own[data[i]] = own.get(data[i], 0) + 1
    return counts


def ppm(counts, order=3):
    """The code length of a text by prediction by partial matching with exclusion, byte by byte."""

    @functools.cache
    def rest(context):
        below = functools.partial(p, context[1:]) if context else lambda _: 1 / 256
        return sum(below(b) for b in range(256) if b not in counts[context])

    @functools.cache
    def p(context, byte):
        below = functools.partial(p, context[1:]) if context else lambda _: 1 / 256
        seen = counts.get(context)
        if not seen:
            return below(byte)
        total, distinct = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (total + (distinct if distinct < 256 else 0))
        return distinct / (total + distinct) * below(byte) / rest(context)

    def bits(text):
        data = b"\n" * order + text
        return sum(-math.log2(p(data[i - order : i], data[i])) for i in range(order, len(data)))

    return bits


def tree_of(lang, texts):
    codes, n = np.unique(np.concatenate([langid._codes(b"\n" * 3 + t) for t in texts]), return_counts=True)
    return langid.ContextTree.fit(lang, codes, n)


def test_code_lengths_against_brute_force(monkeypatch):
    """Every code length is that of the textbook recursion, each context's probabilities sum to one, and cutting a text changes nothing."""
    texts = [b"abracadabra banana", b"an abacus and a cab", b"bab baa cad", bytes(range(256)) * 2]
    for some in (texts[:3], texts):
        tree, bits = tree_of("x", some), ppm(context_counts(some))
        for text in (b"abra", b"banana cab", b"an", b"b" * 9, b"Z", b"aZ\xff\x00b"):
            assert math.isclose(langid.code_lengths([tree], [text])[0, 0], bits(text), rel_tol=1e-5)
        for context in (b"\n\n\n", b"aba", b"zab", b"qqq", b"\x00\x01\x02"):
            codes = np.array([langid._codes(context + bytes([b]))[0] for b in range(256)], np.uint32)
            assert np.isclose(np.exp2(-tree.lengths(codes).astype(float)).sum(), 1, atol=1e-4)
    whole = langid.code_lengths([tree], [b"abracadabra" * 30, b"", b"x"])
    monkeypatch.setattr(langid, "STRETCH", 7)
    assert np.allclose(langid.code_lengths([tree], [b"abracadabra" * 30, b"", b"x"]), whole) and whole[1, 0] == 0


def test_many_languages(spark):
    """All languages are learned; their number, and blocks of tables of any size, change no result."""
    rng = random.Random(9)
    rows = [(i * 40 + j, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 * 7 % 26)}{rng.choice('xyz')}{i}" for _ in range(12)), f"l{i:02d}") for i in range(20) for j in range(12)]
    rows += [(5000, "", "l00"), (5001, None, "l00"), (5002, "12", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    model = langid.train(df)
    assert [t.lang for t in model] == [f"l{i:02d}" for i in range(20)]
    got = langid.identify(df, model).orderBy("doc_id").toPandas()
    assert (got.lang_pred[:240].to_numpy() == np.array([r[2] for r in rows[:240]])).mean() > 0.97
    assert list(got.lang_pred[240:]) == ["und"] * 3 and not got.score[240:].any()
    several = langid.identify(df, model, block_bytes=5 * model[0].size).orderBy("doc_id").toPandas()
    assert (several.lang_pred == got.lang_pred).all() and np.allclose(several.score, got.score) and np.allclose(several.bits_per_byte, got.bits_per_byte)
    few = langid.train(df.where("lang in ('l03', 'l17')"))
    probe = [r[1].encode() for r in rows[:240:7]]
    assert np.allclose(langid.code_lengths(few, probe), langid.code_lengths(model, probe)[:, [3, 17]], rtol=1e-6, atol=0)


def test_ties_of_languages(spark):
    """Equal code lengths: the first name wins, in one block or several."""
    df = spark.createDataFrame([(i, "same words here", x) for i, x in enumerate(["b", "a", "c"] * 8)], "doc_id long, text string, lang string")
    tree = tree_of("", [b"same words here"])
    model = [langid.ContextTree(x, tree.seen, tree.escapes) for x in "abc"]
    for size in (1 << 20, 1):
        got = langid.identify(df, model, block_bytes=size).collect()
        assert {r.lang_pred for r in got} == {"a"} and all(math.isclose(r.score, 1 / 3, rel_tol=1e-6) for r in got)


def test_langid_query_against_brute_force(spark):
    """The registered query's every row, by the textbook recursion over all training documents of its languages."""
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang").collect()]
    langs = sorted({lang for _, _, lang in docs if lang})
    bits = [ppm(context_counts([t.encode() for i, t, x in docs if x == lang and t is not None and zlib.crc32(str(i).encode()) % 4 != 2])) for lang in langs]
    got = {r.doc_id: r for r in langid.op1_langid(spark, d).collect()}
    assert len(got) == len(docs)
    for i, text, _ in docs:
        if not text or not any(c.isalpha() for c in text):
            assert (got[i].lang_pred, got[i].score) == ("und", 0)
            continue
        own = [b(text.encode()) for b in bits]
        low = min(own)
        assert got[i].lang_pred == langs[own.index(low)]
        assert math.isclose(got[i].score, 1 / sum(2 ** max(low - x, -1000) for x in own), rel_tol=1e-3)
        assert math.isclose(got[i].bits_per_byte, low / len(text.encode()), rel_tol=1e-5)


def test_langid(spark):
    rng = random.Random(1)
    make = {"xx": lambda: words(rng, 30), "yy": lambda: " ".join(rng.choice(["quiz", "jolly", "fox", "zebu", "vex"]) for _ in range(30))}
    rows = [(i, make[k](), k) for i in range(200) for k in ("xx" if i % 2 else "yy",)] + [(900, None, "xx"), (901, "123 !?", "yy"), (None, make["xx"](), "xx"), (902, "é" * 50_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df, langid.train(df)).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:200]) and all(0 <= r.score <= 1 for r in got.values())
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[None].lang_pred == "xx"
    none = langid.train(df.where("false"))
    assert none == [] and {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    held = {r.doc_id for r in df.where(langid.held_out(F.col("doc_id"))).collect()}
    assert None in held and all((zlib.crc32(str(i).encode()) % 4 == 2) == (i in held) for i in range(200))


def test_tables_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = langid.op1_langid(spark, d).join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    labels = spark.read.parquet(f"{d}/labels.parquet")
    tox = toxicity.op4_toxicity(spark, d).join(labels, "doc_id").toPandas()
    assert ((tox.predicted == 1) & (tox.toxic == 0)).mean() < 0.02 and tox[tox.toxic == 1].predicted.mean() > 0.6


def test_toxicity(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        sentences = [words(rng, 8) + "." for _ in range(rng.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            sentences.insert(rng.randrange(len(sentences)), f"you are a {rng.choice(['grumblehead', 'snorkface', 'grumbleheads'])} now.")
        rows.append((i, " ".join(sentences), "other"))
        labels.append((i, int(toxic)))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "a snorkface.", "x")]
    labels += [(0, None), (0, 0), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all((got[i].score >= toxicity.THRESHOLD) == (i % 5 == 0) for i in range(400))
    text = rows[0][1]
    assert [("grumble" in text[s.start : s.end] or "snork" in text[s.start : s.end]) for s in got[0].offending] == [True]
    assert got[1001].score == got[1000].score < 0.3 <= got[None].score
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    nothing = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert nothing is None and toxicity.score(docs.where("false"), nothing).count() == 0 and toxicity.score(docs, nothing).agg(F.max("score")).first()[0] == 0


def distance(a, b):
    """Least edit distance of a to any substring of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers():
    rng = random.Random(4)
    for _ in range(100):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, n))) for n in (80, 120))
        d, end = decontaminate.Myers(a).search(b)
        assert d == distance(a, b) and (d == len(a) or distance(a, b[:end]) == d)


def least_between_bounds(item, text, errors):
    """Least edit distance of a short item to any stretch of a text that begins and ends at word bounds, ``errors`` at most."""
    starts = [a for a in range(len(text)) if not text[a - 1 : a].isalnum()]
    best = errors + 1
    for a in starts:
        row = list(range(len(item) + 1))
        for e in range(a, min(len(text), a + len(item) + errors)):
            new = [row[0] + 1]
            for j, x in enumerate(item, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != text[e])))
            row = new
            if not text[e + 1 : e + 2].isalnum():
                best = min(best, row[-1])
    return best


def test_short_items():
    """Items below the length keep their budget of edits, and are not found inside longer words."""
    rng = random.Random(12)
    items = [(i, words(rng, rng.randint(1, 5))[: rng.choice([5, 9, 10, 19, 25, 39])].strip()) for i in range(30)] + [(90, "ab"), (91, "cat sat on the mat"), (92, "new york"), (93, "???")]
    matcher = decontaminate.Matcher(items)
    texts = ["the cat sat on teh mat", "concat sat on the mats", "newyork", "in new york.", "xnew york", "cat sat on the mat", "catsat on the mat!", "cab ab", "cabs", "", "so ??? so", "a??? b", "cat sat on the ma"]
    for _ in range(240):
        parts = [words(rng, rng.randint(0, 6)) for _ in range(2)]
        item = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 3)):
            if item:
                rng.choice([lambda: item.pop(rng.randrange(len(item))), lambda: item.insert(rng.randrange(len(item)), "z"), lambda: item.__setitem__(rng.randrange(len(item)), "q")])()
        texts.append(rng.choice(["", " ", ", "]).join([parts[0], "".join(item), parts[1]]))
    found = edited = 0
    for text in map(decontaminate.normalise, texts):
        want = {}
        for i, item in items:
            p = decontaminate.normalise(item)
            d = least_between_bounds(p, text, len(p) // 10) if p else 1
            if p and d <= len(p) // 10:
                want[i] = d
        got = matcher.match(text)
        assert {i: d for i, d, _ in got} == want and all(e <= len(text) for _, _, e in got)
        found, edited = found + len(want), edited + sum(d > 0 for d in want.values())
    assert found > 50 and edited > 10
    assert matcher.match("cat sat on the mat, cat sat on the mat") == [(91, 0, 18)]  # of equal distances the first end


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(i, words(rng, 14).capitalize() + ".\n" + words(rng, 8)) for i in range(12)] + [(50, "short"), (51, None), (None, words(rng, 20))]
    items += [items[3], (60, items[3][1])]
    rows = []
    for i in range(60):
        text = words(rng, 40)
        if i % 3 == 0:
            item = list(items[i % 12][1])
            for _ in range(rng.choice([0, 2, 8, 14, 30])):
                p = rng.randrange(len(item))
                rng.choice([lambda p=p: item.pop(p), lambda p=p: item.insert(p, "z"), lambda p=p: item.__setitem__(p, "q")])()
            text += " " + "".join(item) + " " + words(rng, 10)
        rows.append((i, text))
    rows += [(100, None), (101, ""), (None, "short " + items[14][1]), (7, rows[0][1]), (7, rows[0][1]), (102, "a Short, one"), (103, "shortest"), (104, "x " * 20_000 + items[2][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    clash = docs.select("*", *(F.lit(-1).alias(x) for x in ("item_id", "distance", "end", "n")))
    want, hit = [], set()
    for doc, text in rows:
        for item, pattern in dict.fromkeys(items):
            p, whole = decontaminate.normalise(pattern), decontaminate.normalise(text)
            if not p:
                continue
            if len(p) < decontaminate.MIN_CHARS:
                d = least_between_bounds(p, whole, int(0.1 * len(p)))
            else:
                d = distance(p, whole if len(whole) < 5000 else whole[-400:])
            if d <= int(0.1 * len(p)):
                want.append((doc, item, d))
                hit.add((doc, text))
    got = [(r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(docs, bench).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 10
    # Two rows with the id 7 have different texts, of which only one holds an item: rows go, not ids.
    assert sorted(map(tuple, decontaminate.clean(docs, bench).collect()), key=repr) == sorted((r for r in rows if r not in hit), key=repr)
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(clash, bench.withColumn("doc_id", F.lit(-1))).collect()), key=repr) == sorted(want, key=repr)
    assert decontaminate.clean(clash, bench).columns == clash.columns
    assert decontaminate.matches(docs.where("false"), bench).count() == 0 and decontaminate.matches(docs, bench.where("false")).count() == 0


def test_media(spark, docs):
    for n in (0, 1, 191, 192, 193, 5000, 70_000):
        data = media.pad(bytes(random.Random(n).randrange(256) for _ in range(n)))
        assert len(data) % 192 == 0 and data and media.decode(media.encode(data)).tobytes() == data
    broken = bytearray(media.encode(media.pad(b"x")))
    broken[40] ^= 1
    with pytest.raises(ValueError):
        media.decode(bytes(broken))
    rows = media.media_features(media.to_media(docs)).collect()
    texts = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert len(rows) == docs.count() and {(r.doc_id, bytes(r.payload)[: r.n_bytes].decode()) for r in rows} == texts
    by = {}
    for r in rows:
        assert by.setdefault(bytes(r.payload), (r.feature, bytes(r.media))) == (r.feature, bytes(r.media))
    assert media.media_features(media.to_media(docs.where("false"))).count() == 0


def test_all_filters():
    """Rows filtered by hand in all five ways are undone."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (12, 9), dtype=np.uint8)
    rows, kinds, bpp = [], [i % 5 for i in range(12)], 3
    for y, kind in enumerate(kinds):
        up = x[y - 1].astype(int) if y else np.zeros(9, int)
        left = np.concatenate([np.zeros(bpp, int), x[y, :-bpp].astype(int)])
        corner = np.concatenate([np.zeros(bpp, int), up[:-bpp]])
        p = left + up - corner
        paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        rows.append((x[y].astype(int) - [0 * left, left, up, (left + up) // 2, paeth][kind]) % 256)
    assert (media._unfilter(np.array(kinds), np.array(rows, np.uint8), bpp) == x).all()


def test_warc(spark):
    html = [b"<p>one</p>", b"", "é\r\n\r\nWARC/1.1".encode(), b"x" * 300_000]
    rows = [(i, f"http://user@WWW.site{i % 3}.org:80/p{i % 5}?q={i % 2}#f", html[i % 4].decode()) for i in range(40)] + [(100, None, None), (101, "not a url", "own"), (102, "http://[bad", "own2"), (None, "http://a.b/", "own"), (5, "http://a.b/", html[1].decode())]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_path(spark, "test-warc")
    captures = warc.write_archives(pages, folder).cache()
    root = warc.build_index(captures, folder, block=4).cache()
    assert root.agg(F.sum("blocks")).first()[0] > 5 and root.agg(F.sum("captures")).first()[0] == len(rows)
    found = warc.find_captures(warc.surt_keys(pages).distinct(), root, folder)
    assert found.count() == len(rows)
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(best.get(h or "", -1), i)
    for r in warc.read_captures(found, folder).collect():
        h = next((x or "") for i, u, x in rows if i == r.page_id and (u or "").split("#")[0] in r.url)
        raw = h.encode()
        assert r.payload_digest == warc.digest(raw) and r.payload_bytes == len(raw)
        original = best[h] == r.page_id
        assert r.record_type == ("response" if original else "revisit") and r.refers_to == (None if original else best[h])
        assert bytes(r.payload) == (raw if original else b"")
    index = warc.CaptureIndex.open(root, folder)
    for _, url, _ in rows:
        assert len(index.find(url)) == sum(warc.surt(u) == warc.surt(url) for _, u, _ in rows)
    index = warc.CaptureIndex.open(root, folder)
    index.find(rows[3][1])
    assert index.reads <= 2 * root.count()  # directories and blocks that can hold the key only
    assert index.find("http://nowhere.net/") == [] and warc.surt("https://a.b.c/d") == "c,b,a)/d"
    none = new_path(spark, "test-warc")
    assert warc.write_archives(pages.where("false"), none).count() == 0
    only_responses = warc.read_captures(warc.write_archives(pages, new_path(spark, "w"), 1 << 30).limit(0), none)
    assert only_responses.count() == 0


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    odd = "İstanbul ŉ ſ <|endoftext|>x a<|startoftext|>b ǅ Éé don't DON'T 12_3 x²y ½ __a é ﬁ ß ẞ Σας \x1c a\x85b c 中文 ×÷ 're're I'LL a\x00b \x7f"
    docs = docs.select("doc_id", "text").unionAll(spark.createDataFrame([(5000, odd), (5001, "word " * 9000)], "doc_id long, text string"))
    got = packing.pack(packing.pieces(docs)).collect()
    want = {}
    for r in docs.collect():
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), 2048):
            part = ids[s : s + 2048]
            want.setdefault((r.doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids)), 0)
            want[r.doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    have, sequences = {}, {}
    for r in got:
        k = (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
        have[k] = have.get(k, 0) + 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert have == want
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert packing.pack(packing.pieces(docs.where("false"))).count() == 0


@pytest.mark.parametrize(("n", "low", "high", "waste", "better"), [(300, 1, 1200, 0.03, False), (2000, 500, 1500, 0.012, True), (2000, 450, 600, 0.035, True), (50, 1, 50, 1, False), (200, 1100, 1200, 1, False)])
def test_plan(n, low, high, waste, better):
    """Column generation never loses to plain filling, and wins where filling leaves room."""
    x = np.random.default_rng(n).integers(low, high, n)
    counts = dict(zip(*(v.tolist() for v in np.unique(x, return_counts=True)), strict=True))
    planned = packing.plan(counts)
    used = {}
    for p, k in planned:
        assert sum(a * b for a, b in p.items()) <= 2048
        for a, b in p.items():
            used[a] = used.get(a, 0) + b * k
    assert used == counts
    total = sum(int(packing.taken(np.array(sum(a * b for a, b in p.items())), 2048)) * k for p, k in planned)
    assert 1 - x.sum() / total <= waste
    filled = sum(int(packing.taken(np.array(sum(a * b for a, b in p.items())), 2048)) * k for p, k in packing.fill(counts, 2048))
    assert total < filled if better else total <= filled


def test_pricing():
    duals = np.full(31, -np.inf)
    duals[[4, 7, 10]] = [5.0, 9.0, 13.0]
    value, last = packing.price(duals, 30)
    for t in range(31):
        best = max((a * 5 + b * 9 + c * 13 for a in range(8) for b in range(5) for c in range(4) if 4 * a + 7 * b + 10 * c == t), default=-math.inf)
        assert value[t] == best
        if best > -math.inf:
            assert sum(k * v for k, v in packing._pattern(last, t).items()) == t


def test_sha(spark):
    assert spark.createDataFrame([("é",)], "t string").select(F.sha2("t", 256)).first()[0] == hashlib.sha256("é".encode()).hexdigest()


def test_hash_against_brute_force():
    """Block means, cosine transform and median by loops."""
    rng = np.random.default_rng(3)
    for shape in ((64, 192, 1), (1, 192, 1), (50, 40, 3), (32, 32, 1)):
        x = rng.integers(0, 256, shape, dtype=np.uint8)
        grey = x.mean(axis=2)
        small = np.zeros((32, 32))
        for i in range(32):
            for j in range(32):
                cells = []
                for k, n in ((i, shape[0]), (j, shape[1])):
                    a, b = k * n // 32, (k + 1) * n // 32
                    cells.append(slice(a, b) if n >= 32 else slice(a, a + 1))
                small[i, j] = grey[cells[0], cells[1]].mean()
        low = []
        for u in range(8):
            for v in range(8):
                low.append(round(sum(small[i, j] * math.cos(math.pi * (2 * i + 1) * u / 64) * math.cos(math.pi * (2 * j + 1) * v / 64) for i in range(32) for j in range(32)), 6))
        low = low[1:]
        want = int("".join(["0", *("1" if c > np.median(low) else "0" for c in low)]), 2)
        assert media.dct_hash(x) == f"{want:016x}"


def test_likelihood_against_brute_force():
    """A fitted model scores by the noisy-or, and its likelihood is better than that of its neighbours."""
    rng = random.Random(4)
    names = ["bad", "odd"]
    bags = [[{0: 1}] * (i % 3 == 0) + [{1: 1}] * rng.randint(0, 2) for i in range(90)]
    y = np.array([int(i % 3 == 0) for i in range(90)])
    model = toxicity.NoisyOr.fit(bags, y, np.ones(90), names)

    def likelihood(weights, bias, leak):
        total = 0.0
        for bag, label in zip(bags, y, strict=True):
            clean = 1 - leak
            for s in bag:
                clean *= 1 - 1 / (1 + math.exp(-(sum(weights.get(names[f], 0.0) * n for f, n in s.items()) + bias)))
            total += math.log(1 - clean if label else clean)
        return total

    best = likelihood(model.weights, model.bias, model.leak)
    assert model.weights["bad"] > 2 and model.weights.get("odd", 0) < 0.5
    assert all(best >= likelihood(model.weights, model.bias + d, model.leak) - 0.5 for d in (-1.0, 0.8))
    p = model.sentence("a bad thing")
    assert math.isclose(model.score("a bad thing. another bad thing."), 1 - (1 - model.leak) * (1 - p) ** 2)
    assert model.score("x " * 200_000) == model.score("") == model.score("nothing here")


def test_clashes_and_repeats(spark):
    """Repeated rows and columns of the operators' own names."""
    rows = [(1, "you are a fine text of words", "x", 5)] * 3 + [(None, None, "y", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").withColumns({"held_out": F.lit(1), "lang_pred": F.lit("z"), "bits_per_byte": F.lit(0)})
    assert [r.lang_pred for r in langid.identify(df, langid.train(df)).orderBy(F.desc("doc_id")).collect()] == ["x", "x", "x", "und"]
    pages = spark.createDataFrame([(1, "http://a.b/c", "same", "z", 1)] * 3 + [(2, "http://a.b/c", "same", "z", 1)], "page_id long, url string, html string, payload_digest string, n int")
    folder = new_path(spark, "test-warc")
    captures = warc.write_archives(pages, folder).cache()
    back = warc.read_captures(warc.find_captures(warc.surt_keys(pages).distinct(), warc.build_index(captures, folder, 2), folder), folder).toPandas()
    assert sorted(back.page_id) == [1, 1, 1, 2] and set(back[back.page_id == 1].record_type) == {"revisit"}
    packed = packing.pack(packing.pieces(df.withColumns({"length": F.lit(1), "offset": F.lit(2), "pid": F.lit(3)}))).toPandas()
    assert len(packed) == 4 and packed.doc_tokens.iloc[0] == packed.length.iloc[0]
