"""Exact quantiles of columns of any size, for many groups at once."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one look at the data may bring to the driver, about.
LIMIT = 100_000
BINS = 4096


def quantiles_by(df: DataFrame, keys: list[str], columns: list[str], probabilities: list[float]) -> dict[tuple, dict[str, list[float | None]]]:
    """Linearly interpolated quantiles of the finite values of each column, for each group of ``keys`` (which must be few).

    Every pass looks at all groups, columns and ranks together: it counts a histogram of each stretch of values in which a wanted
    rank lies, and goes on with one bin of each, until a stretch is a single value.  So neither a task nor the driver ever
    holds all values, unlike the ``percentile`` aggregate.  Values in all: 2 passes if they are few, else about 2 more.
    """
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(keys, columns, "_column", "x")
    long = long.where(F.abs("x") < math.inf)  # neither missing nor infinite
    group = [*keys, "_column"]
    first = long.groupBy(*group).agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).collect()
    ranks = {}
    for r in first:
        g = tuple(r[k] for k in group)
        for p in probabilities:
            place = (r["n"] - 1) * p
            for rank in {math.floor(place), math.ceil(place)}:
                ranks[g, rank] = (r["a"], r["b"], 0, r["n"])  # the stretch, values before it, values in it
    sizes = {tuple(r[k] for k in group): r["n"] for r in first}
    while pending := {k: s for k, s in ranks.items() if s[0] < s[1]}:
        stretches = {}
        for (g, _), s in pending.items():
            stretches.setdefault((g, s), len(stretches))
        few = sum(s[3] for _, s in stretches) <= LIMIT
        bins = max(16, min(BINS, LIMIT // len(stretches)))
        schema = ", ".join([*(f"_k{i} {long.schema[k].dataType.simpleString()}" for i, k in enumerate(group)), "_id int", "_a double", "_b double"])
        at = df.sparkSession.createDataFrame([(*g, i, s[0], s[1]) for (g, s), i in stretches.items()], schema)
        same = F.col("x").between(F.col("_a"), F.col("_b"))
        for i, k in enumerate(group):
            same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
        share = F.try_divide(F.col("x") / 2 - F.col("_a") / 2, F.col("_b") / 2 - F.col("_a") / 2)
        place = F.col("x") if few else F.floor(F.coalesce(share, F.when(F.col("x") == F.col("_b"), 1.0).otherwise(0.0)) * (bins - 1))
        counted = long.join(F.broadcast(at), same).groupBy("_id", place.alias("bin"))  # a row for each group, column and rank
        found: dict[int, list[tuple]] = {}
        for r in counted.agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).collect():
            found.setdefault(r["_id"], []).append((r["a"], r["b"], r["n"]))
        for rows in found.values():
            rows.sort()
        for (g, rank), s in pending.items():
            before = s[2]
            for a, b, n in found[stretches[g, s]]:
                if before + n > rank:
                    ranks[g, rank] = (a, b, before, n)
                    break
                before += n
    out: dict[tuple, dict[str, list[float | None]]] = {}
    for g, n in sizes.items():
        values = out.setdefault(g[:-1], {c: [None] * len(probabilities) for c in columns})[g[-1]] = []
        for p in probabilities:
            place = (n - 1) * p
            low, high = ranks[g, math.floor(place)][0], ranks[g, math.ceil(place)][0]
            values.append(low + (high - low) * (place % 1))
    return out


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> list[float | None]:
    return quantiles_by(df, [], [column], probabilities).get((), {column: [None] * len(probabilities)})[column]
