"""What training needs from the data: encoding, scaling, sequences, metrics, out-of-fold predictions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BoostConfig
from ..functions.columns import by_time, fill
from ..functions.quantiles import quantiles_by
from ..sources.scratch import saved
from .boosting import fit_boosting

MISSING = -999.0  # fixed value: no out-of-fold prediction
NEUTRAL = 1


def encode_label(y: Column) -> Column:
    """-1, 0, 1 -> 0, 1, 2; anything else is 1."""
    return F.when(y == -1, 0).when(y == 0, 1).when(y == 1, 2).otherwise(NEUTRAL)


def fill_missing(df: DataFrame, cols: list[str], keys: tuple[str, ...] = ("split_id", "role", "symbol")) -> DataFrame:
    """Forward, backward, then 0: training and validation rows apart."""
    w = by_time(*keys)
    return df.withColumns({c: F.coalesce(fill(F.col(c), w), F.lit(0.0)) for c in cols})


def scale(df: DataFrame, cols: list[str], kind: str = "standard", by: str = "split_id", fit: str = "train") -> DataFrame:
    """Scales every row by statistics of the ``fit`` rows of its split.  A spread of zero counts as one."""
    rows = df.where(F.col("role") == fit)
    x = {c: F.col(c) for c in cols}
    if kind == "none":
        return df
    if kind == "standard":
        stats = rows.groupBy(by).agg(*[F.avg(x[c]).alias(f"_a_{c}") for c in cols], *[F.stddev_pop(x[c]).alias(f"_b_{c}") for c in cols])
    elif kind == "minmax":
        stats = rows.groupBy(by).agg(*[F.min(x[c]).alias(f"_a_{c}") for c in cols], *[(F.max(x[c]) - F.min(x[c])).alias(f"_b_{c}") for c in cols])
    elif kind == "robust":
        # All splits and columns in the same few passes; the number of splits is small, the rows of one are not.
        got = quantiles_by(rows, [by], cols, [0.25, 0.5, 0.75])
        schema = ", ".join([f"{by} {df.schema[by].dataType.simpleString()}", *(f"_{k}_{c} double" for c in cols for k in "ab")])
        line = lambda q: [x for q1, q2, q3 in (q[c] for c in cols) for x in (q2, None if q1 is None else q3 - q1)]
        stats = df.sparkSession.createDataFrame([(*k, *line(q)) for k, q in got.items()], schema)
    else:
        raise ValueError(f"unknown scaler: {kind}")
    scaled = {c: (x[c] - F.col(f"_a_{c}")) / F.when(F.col(f"_b_{c}") > 0, F.col(f"_b_{c}")).otherwise(1.0) for c in cols}
    # One row a split, and of splits there are at most MAX_WINDOWS (splits.py): no row is shuffled by its split.
    return df.join(F.broadcast(stats), by, "left").select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def sequences(df: DataFrame, cols: list[str], length: int = 64, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """``sequence`` (length x columns) up to each row, for rows with that many before them."""
    w = by_time(*keys)
    frame = w.rowsBetween(-(length - 1), 0)
    packed = df.withColumn("_row", F.array(*[F.col(c).cast("float") for c in cols]))
    return packed.withColumns({"_rn": F.row_number().over(w), "sequence": F.collect_list("_row").over(frame)}).where(F.col("_rn") >= length).drop("_rn", "_row")


def pad_predictions(p: Column) -> Column:
    """Rows without a whole sequence get the neutral class."""
    return F.coalesce(p, F.lit(NEUTRAL))


def confusion(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, "y", "p").agg(F.count("*").alias("n"))


def per_class(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """precision, recall and f1 of each class that is true or predicted anywhere; 0 where undefined."""
    m = confusion(df, by)
    long = m.select(*by, F.explode(F.array(F.struct(F.col("y").alias("class"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted")), F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted")))).alias("x")).select(*by, "x.*")
    s = long.groupBy(*by, "class").agg(F.sum("tp").alias("tp"), F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"))
    share = lambda b: F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col(b)), F.lit(0.0))
    s = s.withColumns({"precision": share("predicted"), "recall": share("support")})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return s.select(*by, "class", "support", "precision", "recall", f1.alias("f1"))


def macro(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """accuracy and macro averages."""
    classes = per_class(df, by).groupBy(*by).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))
    overall = df.groupBy(*by).agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"))
    return overall.join(classes, list(by)) if by else overall.join(F.broadcast(classes))  # one row each


def directional_accuracy(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    moves = (F.col("y") != NEUTRAL) & (F.col("p") != NEUTRAL)
    return df.groupBy(*by).agg(F.coalesce(F.avg(F.when(moves, (F.col("y") == F.col("p")).cast("double"))), F.lit(0.0)).alias("directional_accuracy"))


def log_loss(df: DataFrame, probabilities: str = "proba", floor: float = 1e-15, by: tuple[str, ...] = ()) -> DataFrame:
    p = F.get(probabilities, F.col("y"))
    return df.groupBy(*by).agg((-F.avg(F.ln(F.greatest(F.least(p, F.lit(1 - floor)), F.lit(floor))))).alias("log_loss"))


def auc(df: DataFrame, probabilities: str = "proba", classes: int = 3, ranges: int = 256, by: tuple[str, ...] = ()) -> DataFrame:
    """class (and the columns ``by``), auc: one against the rest, by rank sums with average ranks; missing if a class has all rows or none.

    Equal scores are aggregated first and written.  What is left is ranked within ranges of scores, whose bounds are approximate quantiles
    (they only balance the work), and the rows of all lower ranges are added: no task ever holds a class.
    """
    long = df.select(*by, "y", F.posexplode(probabilities).alias("class", "score")).where(F.col("class") < classes)
    group = [*by, "class"]
    tied = saved(long.groupBy(*group, "score").agg(F.count("*").alias("n"), F.count_if(F.col("y") == F.col("class")).alias("pos")), "scores")
    bounds = sorted(set(tied.approxQuantile("score", [i / ranges for i in range(1, ranges)], 0.25 / ranges))) if ranges > 1 else []
    part = F.size(F.filter(F.lit(bounds) if bounds else F.array().cast("array<double>"), lambda b: b <= F.col("score")))
    tied = tied.withColumn("part", part)
    w = Window.partitionBy(*group, "part").orderBy("score")
    inside = tied.withColumn("rank", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - (F.col("n") - 1) / 2)
    parts = inside.groupBy(*group, "part").agg(F.sum(F.col("rank") * F.col("pos")).alias("r"), F.sum("pos").alias("p"), F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # of at most ``ranges`` rows
    s = parts.withColumn("r", F.col("r") + before * F.col("p")).groupBy(*group).agg(F.sum("r").alias("r"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return s.select(*group, F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * (F.col("n") - F.col("p"))).alias("auc"))


def macro_auc(df: DataFrame, probabilities: str = "proba", classes: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """The mean of the classes' auc: one row, or one for each group of ``by``."""
    return auc(df, probabilities, classes, by=by).groupBy(*by).agg(F.avg("auc").alias("auc"))


def fold_auc(predicted: DataFrame, probabilities: str = "proba", by: tuple[str, ...] = ("split_id", "role")) -> DataFrame:
    """log_loss and roc_auc_ovr (macro) of each fold and role.  Where a class is missing from the rows the loss is infinite and the area 0, as nothing can be said."""
    loss = log_loss(predicted, probabilities, by=by)
    area = auc(predicted, probabilities, by=by).groupBy(*by).agg(F.avg("auc").alias("_auc"), F.bool_and(F.col("auc").isNotNull()).alias("_all"))
    both = loss.join(area, list(by))
    return both.select(*by, F.when(F.col("_all"), F.col("log_loss")).otherwise(float("inf")).alias("log_loss"), F.when(F.col("_all"), F.col("_auc")).otherwise(0.0).alias("roc_auc_ovr"))


def compile_oof(rows: DataFrame, predictions: DataFrame) -> DataFrame:
    """The rows with ``oof``: the prediction of the last fold that has the row, else MISSING.  Both have symbol and row_idx."""
    last = predictions.groupBy("symbol", "row_idx").agg(F.max_by("pred", "fold_id").alias("_pred"))
    return rows.join(last, ["symbol", "row_idx"], "left").withColumn("oof", F.coalesce(F.col("_pred").cast("double"), F.lit(MISSING))).drop("_pred")


def oof_coverage(oof: DataFrame) -> DataFrame:
    return oof.agg(F.count("*").alias("n_rows"), F.avg((F.col("oof") != MISSING).cast("double")).alias("coverage"))


def fold_summary(metrics: DataFrame) -> DataFrame:
    """metrics: fold_id, metric, value -> metric, mean, std (population), min, max, folds."""
    return metrics.where(F.col("value").isNotNull()).groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("folds"))


def importance_summary(importance: DataFrame) -> DataFrame:
    """importance: fold_id, type, feature, value -> type, feature, mean, std (population), folds."""
    return importance.groupBy("type", "feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("folds"))


# ---- folds ---------------------------------------------------------------------------------------------------------


def first_symbol(assigned: DataFrame) -> DataFrame:
    """The rows of each split's first symbol, by name: a fold is trained on one symbol."""
    first = assigned.groupBy("split_id").agg(F.min("symbol").alias("symbol"))
    return assigned.join(F.broadcast(first), ["split_id", "symbol"], "left_semi")  # a row for each split


def centroids(df: DataFrame, cols: list[str], by: str = "split_id") -> DataFrame:
    """The model of each fold: the mean of each class's training rows."""
    return df.where(F.col("role") == "train").groupBy(by, "y").agg(*[F.avg(c).alias(f"_c_{c}") for c in cols])


def nearest(df: DataFrame, model: DataFrame, cols: list[str], by: str = "split_id") -> DataFrame:
    """``df`` with ``p``, the class of the nearest centroid of its fold (of equally near ones the least class).  A fold's model is one row."""
    every = model.groupBy(by).agg(F.sort_array(F.collect_list(F.struct("y", *[f"_c_{c}" for c in cols]))).alias("_model"))  # as many elements as classes
    places = F.transform("_model", lambda m: F.struct(sum(((F.col(c) - m[f"_c_{c}"]) ** 2 for c in cols), F.lit(0.0)).alias("far"), m["y"].alias("y")))
    return df.join(F.broadcast(every), by).withColumn("p", F.array_min(places)["y"]).drop("_model")


def run_folds(assigned: DataFrame, cols: list[str], scaler: str = "standard", model: str = "centroids", keep_missing: bool = False, boost: BoostConfig = BoostConfig()) -> DataFrame:
    """All folds: rows of each split's first symbol with ``y`` -> filled, scaled, fitted on the training rows, and ``p`` for every row.

    ``centroids`` and ``boosting`` (which also gives ``proba``) keep all folds in one plan keyed by split_id; ``forest`` fits one Spark ML model
    for each split in turn.  The folds' rows are written once; statistics and models read that table.
    """
    rows = saved(first_symbol(assigned), "folds")
    rows = scale(rows if keep_missing else saved(fill_missing(rows, cols), "folds"), cols, scaler)
    if model == "centroids":
        return nearest(rows, centroids(rows, cols), cols)
    if model == "boosting":
        return fit_boosting(rows, cols, boost).predict(rows)
    if model != "forest":
        raise ValueError(f"unknown model: {model}")
    rows, out = saved(rows, "folds"), None
    for r in rows.select("split_id").distinct().orderBy("split_id").collect():
        own = rows.where(F.col("split_id") == r["split_id"])
        got = fit_forest(own.where("role = 'train'"), cols).transform(own).select(*rows.columns, F.col("prediction").cast("int").alias("p"), vector_to_array("probability").alias("proba"))
        out = got if out is None else out.unionAll(got)
    return out


def fold_metrics(predicted: DataFrame) -> DataFrame:
    """split_id, role, n, accuracy, precision, recall, f1 (macro), directional_accuracy."""
    by = ("split_id", "role")
    n = predicted.groupBy(*by).agg(F.count("*").alias("n"))
    return n.join(macro(predicted, by), list(by)).join(directional_accuracy(predicted, by), list(by))


def flat_sequences(df: DataFrame, cols: list[str], length: int = 64, keys: tuple[str, ...] = ("split_id", "role", "symbol")) -> DataFrame:
    """``sequences`` as one vector a row: what a network without recurrence takes in."""
    return sequences(df, cols, length, keys).withColumn("_features", array_to_vector(F.flatten("sequence"))).drop("sequence")


def fit_network(df: DataFrame, hidden: tuple[int, ...] = (32,), classes: int = 3, seed: int = 42, steps: int = 100):
    """A Spark ML perceptron on the vectors of ``flat_sequences`` and encoded labels ``y``."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    width = df.select(F.size(vector_to_array("_features"))).first()[0]
    return MultilayerPerceptronClassifier(featuresCol="_features", labelCol="y", layers=[width, *hidden, classes], seed=seed, maxIter=steps).fit(df)


def fit_forest(df: DataFrame, cols: list[str], seed: int = 42, trees: int = 50):
    """A Spark ML classifier on encoded labels ``y``; the features are used as they are."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="keep"), RandomForestClassifier(featuresCol="_features", labelCol="y", numTrees=trees, seed=seed)]).fit(df)
