import random

import pytest


def words(rng, n):
    return " ".join("".join(rng.choice(["an", "er", "th", "on", "e", "st", "ou"]) for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Small texts with copies, near copies, shared lines and passages, toxic words, nulls, empties and a long one."""
    rng = random.Random(7)
    line, passage = words(rng, 9), words(rng, 60)
    out = []
    for i in range(60):
        parts = [words(rng, rng.randint(5, 80)) for _ in range(rng.randint(1, 4))]
        if i % 4 == 0:
            parts.insert(rng.randint(0, len(parts)), line if i % 8 else f"  {line.upper()}\t")
        if i % 5 == 0:
            parts.insert(rng.randint(0, len(parts)), passage)
        out.append("\n".join(parts))
    out += [out[3], out[3], out[4] + " é end", out[5].replace("an", "on", 1), "", None, "  \n \t\n", "a b c", "a  b\nc", "x" * 250 + "é" * 70, ("ab " * 4000).strip(), passage, passage[:150]]
    return out


#: Columns whose names could clash with those of the operators.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, n int, score string, value double, h string, span int, node string, bands int, length int, offset int, start int"


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (2, texts[2]), (7, "another text with the id of seven")]
    langs = ["en", "de", None]
    return spark.createDataFrame([(i, t, langs[(i or 0) % 3], None, len(t or ""), 1, "s", 0.5, "h", 1, "n", 2, 3, 4, 5) for i, t in rows], CLASH)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
