"""Features and labels to a dataset without missing values."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AssembleConfig
from ..functions.blocks import filled_in_blocks, long_symbols
from ..functions.columns import fill
from ..schemas import KEYS, LABEL, feature_columns, require
from ..sources.scratch import saved
from .features import missing_ratios


def common_symbols(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("symbol").distinct().intersect(b.select("symbol").distinct())


def join_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join on time and symbol; other names that both have get ``_label`` on the right."""
    require(features, KEYS)
    require(labels, [*KEYS, LABEL])
    clash = {c: f"{c}_label" for c in labels.columns if c in features.columns and c not in KEYS}
    return features.join(labels.withColumnsRenamed(clash), KEYS, "inner")


def retention(df: DataFrame) -> DataFrame:
    """One row: rows, rows with a label, the share of missing labels."""
    return df.agg(F.count("*").alias("initial"), F.count(LABEL).alias("kept"), F.avg(F.col(LABEL).isNull().cast("double")).alias("null_ratio"))


def retention_by(df: DataFrame, by: tuple[str, ...] = ("symbol",), config: AssembleConfig = AssembleConfig()) -> DataFrame:
    """The gate of each group: initial, kept, least, passes."""
    g = df.groupBy(*by).agg(F.count("*").alias("initial"), F.count(LABEL).alias("kept"))
    least = F.when(F.try_divide(F.col("initial") - F.col("kept"), "initial") > config.relax_above, config.relaxed_retention).otherwise(config.min_retention)
    return g.withColumn("least", least).withColumn("passes", F.coalesce(F.try_divide("kept", "initial") >= F.col("least"), F.lit(False)))


def retention_gate(initial: int, kept: int, config: AssembleConfig = AssembleConfig()) -> float:
    """The least retention, or an error.  It is relaxed if very many labels are missing."""
    least = config.relaxed_retention if initial and (initial - kept) / initial > config.relax_above else config.min_retention
    if not initial or kept / initial < least:
        raise ValueError(f"{kept} of {initial} rows stay; at least {least:.0%} are needed")
    return least


def join_efficiency(features: DataFrame, labels: DataFrame, joined: DataFrame) -> DataFrame:
    """One row: rows of both sides and of their join; the join's share of the larger side and of the features."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    one = n(features, "n_features").join(F.broadcast(n(labels, "n_labels"))).join(F.broadcast(n(joined, "n_joined")))  # one row each
    return one.withColumns({"of_larger": F.try_divide("n_joined", F.greatest("n_features", "n_labels")), "of_features": F.try_divide("n_joined", "n_features")})


def handle_missing(df: DataFrame, config: AssembleConfig = AssembleConfig(), backward: bool = True) -> DataFrame:
    """Sparse columns go, rows without label go, the rest is filled within each symbol; gates raise errors.

    One aggregate by symbol answers all gates.  Filling leaves nothing missing in a column just if every symbol has a value
    there (if only forward: at its first row), so completeness is known before anything is filled.
    """
    cols = feature_columns(df)
    y = F.col(LABEL).isNotNull()
    first = F.min_by(F.struct(*[F.col(c).isNotNull().alias(c) for c in cols]), F.when(y, F.col("timestamp")))
    by_symbol = df.groupBy("symbol").agg(F.count("*").alias("_n"), F.count(LABEL).alias("_kept"), first.alias("_first"), *[F.count(c).alias(c) for c in cols], *[F.count_if(y & F.col(c).isNotNull()).alias(f"_seen_{c}") for c in cols])
    # Of all symbols: sums, and for each column the least symbol that could not be filled.
    lacks = lambda c: (F.col("_kept") > 0) & ((F.col(f"_seen_{c}") == 0) if backward else ~F.col(f"_first.{c}"))
    one = by_symbol.agg(F.sum("_n").alias("_n"), F.sum("_kept").alias("_kept"), *[F.sum(c).alias(c) for c in cols], *[F.sum(f"_seen_{c}").alias(f"_seen_{c}") for c in cols], *[F.min(F.when(lacks(c), F.col("symbol"))).alias(f"_bad_{c}") for c in cols]).first()
    n, kept = one["_n"] or 0, one["_kept"] or 0
    seen = {c: one[f"_seen_{c}"] for c in cols}
    retention_gate(n, kept, config)
    if kept < config.min_samples:
        raise ValueError(f"{kept} samples; at least {config.min_samples} are needed")
    gone = {c for c in cols if 1 - one[c] / n > config.max_nan_ratio} | set(config.drop_features)
    stays = [c for c in cols if c not in gone]
    if bad := {c: one[f"_bad_{c}"] for c in stays if one[f"_bad_{c}"] is not None}:
        raise ValueError(f"values are missing and cannot be filled (column and symbol): {bad}")
    df, gaps = df.drop(*gone).where(y), [c for c in stays if seen[c] < kept]
    if gaps and long_symbols(df):
        return filled_in_blocks(df, gaps, backward)
    return df.withColumns({c: fill(F.col(c), backward=backward) for c in gaps})


def require_complete(df: DataFrame) -> DataFrame:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first().asDict()
    if bad := {c: n for c, n in row.items() if n}:
        raise ValueError(f"missing values are left: {bad}")
    return df


def assemble(features: DataFrame, labels: DataFrame, config: AssembleConfig = AssembleConfig(), backward: bool = True) -> DataFrame:
    """The dataset.  The join is written once: gates and result read it."""
    joined = saved(join_labels(features, labels), "joined")
    if not joined.limit(1).count():
        raise ValueError("the join of features and labels is empty" if common_symbols(features, labels).limit(1).count() else "features and labels have no symbol in common")
    out = handle_missing(joined, config, backward)
    ratio = imbalance(joined).first()[0]
    if ratio is not None and ratio > config.imbalance:
        warnings.warn(f"the largest class has {ratio:.1f} times as many rows as the smallest", stacklevel=2)
    return out


def imbalance(df: DataFrame) -> DataFrame:
    """One row: rows of the largest class over those of the smallest."""
    n = df.where(F.col(LABEL).isNotNull()).groupBy(LABEL).agg(F.count("*").alias("n"))
    return n.agg(F.try_divide(F.max("n"), F.min("n")).alias("imbalance"))


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(LABEL).agg(F.count("*").alias("n"))


def ratios_of(df: DataFrame) -> DataFrame:
    return missing_ratios(df, (*KEYS, LABEL))
