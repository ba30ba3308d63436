"""Fill-in-the-middle transformation of documents, in Spark SQL expressions alone.

``regexp_extract_all`` splits a text into units (code points, unless another pattern is given); numbers read from a sha-256
of the seed and the document's id by ``substring`` and ``conv`` choose the form and two cuts; ``slice`` and ``array_join`` put
the parts together again behind sentinels.  ``restored`` parses the sentinels and gives the text back.

There is no shuffle and no Python: a document's result depends on its own row, so a lost task is simply run again.

Defined results: a null text is an empty one; empty texts and texts that contain a sentinel stay plain; a null id is
hashed as no digits at all; repeated rows get the same cuts; both cuts may fall together (an empty middle) or at an end;
parts that the unit pattern does not match belong to no unit and would be lost, so such a text stays plain; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

#: Sentinels before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
CODE_POINT = "(?s)."
#: Of a hundred documents so many are transformed, and so many of those with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
SEED = "1:"


def checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """The sentinels, if their places in an output are plain: none is part of another, or ends as one begins."""
    for i, a in enumerate(sentinels):
        for j, b in enumerate(sentinels):
            if not a or i != j and a in b or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels {a!r} and {b!r} can run into each other")
    return sentinels


def draw(seed: str, doc_id: Column, k: int) -> Column:
    """The k-th number, from 0 to 2**32 - 1, of a document."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, unit: str = CODE_POINT, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: str = SEED, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` (doc_id, text) with n (units), form (plain, psm, spm), prefix_chars, middle_chars (units; null if plain) and output."""
    p, s, m = (F.lit(x) for x in checked(sentinels))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.lit(True) if unit == CODE_POINT else F.array_join("_units", "") == F.col("_text")
    cuts = docs.withColumn("_text", text).withColumn("_units", F.regexp_extract_all("_text", F.lit(unit), F.lit(0))).withColumn("n", F.size("_units").cast("long"))
    a, b = (F.pmod(draw(seed, F.col("doc_id"), k), F.col("n") + 1) for k in (1, 2))
    plain = (F.col("n") == 0) | F.contains("_text", p) | F.contains("_text", s) | F.contains("_text", m) | (F.pmod(draw(seed, F.col("doc_id"), 3), F.lit(100)) >= rate) | ~whole
    form = F.when(plain, "plain").when(F.pmod(draw(seed, F.col("doc_id"), 4), F.lit(100)) < suffix_first, "spm").otherwise("psm")
    cuts = cuts.withColumns({"form": form, "_a": F.least(a, b).cast("int"), "_b": F.greatest(a, b).cast("int")})
    part = lambda start, length: F.array_join(F.slice("_units", start, length), "")
    cuts = cuts.withColumns({"_prefix": part(F.lit(1), F.col("_a")), "_middle": part(F.col("_a") + 1, F.col("_b") - F.col("_a")), "_suffix": part(F.col("_b") + 1, F.col("n").cast("int") - F.col("_b"))})
    x = {k: F.col(f"_{k}") for k in ("prefix", "middle", "suffix")}
    output = F.when(F.col("form") == "psm", F.concat(p, x["prefix"], s, x["suffix"], m, x["middle"])).when(F.col("form") == "spm", F.concat(s, x["suffix"], p, x["prefix"], m, x["middle"])).otherwise(F.col("_text"))
    chosen = F.col("form") != "plain"
    kept = [c for c in docs.columns if c not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    return cuts.select(*kept, "n", "form", F.when(chosen, F.col("_a").cast("long")).alias("prefix_chars"), F.when(chosen, (F.col("_b") - F.col("_a")).cast("long")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that was transformed: what follows each sentinel up to the next one, in the order of the text."""
    p, s, m = (F.lit(x) for x in checked(sentinels))
    after = lambda x, mark: F.split_part(x, mark, F.lit(2))
    before = lambda x, mark: F.split_part(x, mark, F.lit(1))
    middle = after(output, m)
    psm = F.concat(before(after(output, p), s), middle, before(after(output, s), m))
    spm = F.concat(before(after(output, p), m), middle, before(after(output, s), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transformed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = lambda x: F.sha2(x.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = """
with hashed as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
drawn as (
  select *, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2, cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from hashed),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
part as (
  select *, substring(t, 1, a) as pre, substring(t, a + 1, b - a) as mid, substring(t, b + 1, n - b) as suf from cut)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(t) as restored_sha256
from part
"""
