"""The stages, one after the other; tables that are read more than once are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AssembleConfig, BarrierConfig, FeatureConfig, SplitConfig
from ..operators import assemble, features, labels, splits
from ..schemas import bar_format
from ..sources.scratch import saved


def build_dataset(bars: DataFrame, feature_config: FeatureConfig = FeatureConfig(), barrier_config: BarrierConfig = BarrierConfig(), assemble_config: AssembleConfig = AssembleConfig()) -> DataFrame:
    """Bars -> features -> labels -> dataset.  The features are written once; gates, statistics and quantiles read that table.

    Symbols of more than ``blocks.LONG`` rows go by blocks of rows, in features, labels and fills.
    """
    kind, bars = bar_format(bars), saved(bars, "bars")
    features.warn_missing(features.require_rows(bars, feature_config.min_rows), feature_config.max_missing_ratio)
    table = saved(features.features_of(bars, feature_config), "features")
    table = saved(features.validate_features(table, feature_config), "features")
    if kind == "bidask" and barrier_config.price_col == "close":
        barrier_config = BarrierConfig(**{**barrier_config.__dict__, "price_col": "mid_close"})
    return assemble.assemble(table, labels.label_data(table, barrier_config), assemble_config, backward=not feature_config.leak_safe)


def build_splits(dataset: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    return splits.split_dataset(dataset, config)


def labels_by_symbol(bars: DataFrame, config: BarrierConfig = BarrierConfig()) -> DataFrame:
    """The smallest slice through all layers: features, warm-up cut, barriers, counts."""
    table = features.compute_features(bars)
    return labels.triple_barrier(table, config).groupBy("symbol", "label").agg(F.count("*").alias("n"))
