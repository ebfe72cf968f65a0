"""Feature importance and what missed or risky samples look like."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabgauge.operators.evaluate import LABEL, SCORE, curve_areas, top_risk_ids
from fabgauge.operators.forest import GrownForest
from fabgauge.operators.models import FOREST, LOGISTIC, SEED
from fabgauge.operators.ordered import exact_median, hash_key, with_hash_rank, with_rank
from fabgauge.operators.profile import melt
from fabgauge.operators.rescoring import OTHER, VALUES, ForestRescorer, LinearRescorer, Rescorer
from fabgauge.session import fix

# Names of importance types and sample groups, list lengths.
COEFFICIENT = "coefficient_abs"
IMPURITY = "impurity_importance"
PERMUTATION = "permutation_average_precision"
TOP_RISK_GROUP = "top_risk_samples"
FALSE_NEGATIVE_GROUP = "false_negative_samples"
ALL_GROUP = "all_test_samples"
REPEATS = 10
TOP_FEATURES = 20
TOP_RISK_RANKS = 30


def rank_importance(values: DataFrame) -> DataFrame:
    """Rank features by importance, names breaking ties, per model and importance type."""
    order = Window.partitionBy("model_name", "importance_type").orderBy(
        F.desc("importance"), F.asc("feature")
    )
    return values.select(
        "model_name",
        "importance_type",
        "feature",
        "importance",
        F.row_number().over(order).alias("rank"),
    )


def _importance_rows(
    name: str, kind: str, features: Sequence[str], values: Sequence[float]
) -> DataFrame:
    # One row per column of the table the model was trained on.
    rows = [(name, kind, f, float(v)) for f, v in zip(features, values, strict=True)]
    schema = "model_name string, importance_type string, feature string, importance double"
    return rank_importance(SparkSession.active().createDataFrame(rows, schema))


def coefficient_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Absolute coefficients of the standardized features."""
    values = [abs(v) for v in model.stages[-1].coefficients.toArray()]
    return _importance_rows(LOGISTIC, COEFFICIENT, features, values)


def impurity_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Share of the forest's gains; a grown forest adds them up without Spark's model, an object per node on the driver."""
    grown = isinstance(model, GrownForest)
    values = model.importances(len(features)) if grown else model.stages[-1].featureImportances.toArray()
    return _importance_rows(FOREST, IMPURITY, features, values)


def linear_scorer(
    weights: Mapping[str, float], intercept: float = 0.0
) -> Callable[[DataFrame], DataFrame]:
    """Scorer of a fixed linear model over the feature columns."""

    def score(rows: DataFrame) -> DataFrame:
        margin: Column = F.lit(float(intercept))
        for name, weight in weights.items():
            margin = margin + F.col(name) * F.lit(float(weight))
        return rows.withColumn(SCORE, margin)

    return score


def permuted_pairs(
    ids: DataFrame, repeats: int = REPEATS, seed: int = SEED, key: str = "sample_id"
) -> DataFrame:
    """For each repeat and row the row whose values it takes: ``repeat, key, _donor``.

    In repeat r the row with id rank i takes the value of the row with rank i in the order of
    md5(id|r|seed). Only ids are ranked, cell by cell, and paired by (repeat, rank), which is
    unique. All features share one order.
    """
    ids = ids.select(key)
    numbered = with_rank(
        ids.withColumn("_all", F.lit(1)), ["_all"], key, key, descending=False, name="_at"
    ).drop("_all")
    again = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")
    receivers = numbered.select(again, key, "_at")
    keyed = ids.select(again, F.col(key).alias("_donor"))
    keyed = keyed.withColumn("_order", hash_key(F.col("_donor"), F.col("repeat"), seed))
    donors = with_hash_rank(keyed, ["repeat"], "_order", "_donor", "_at").drop("_order")
    return receivers.join(donors, ["repeat", "_at"]).drop("_at")


def permutation_importance(
    test: DataFrame,
    features: Sequence[str],
    scorer: Rescorer,
    model_name: str,
    repeats: int = REPEATS,
    seed: int = SEED,
    key: str = "sample_id",
    label: str = LABEL,
) -> DataFrame:
    """Mean drop of average precision when one feature's values are shuffled.

    A row meets the values of the row it is paired with once per repeat, as two arrays; the scores
    with each single feature replaced come from there, so no wide row is repeated per feature. Scores are
    checkpointed, since the curve areas read them several times.
    """
    inputs = scorer.inputs(test, [key, label])
    plain = scorer.scores(inputs, [label]).withColumn("_all", F.lit(1))
    baseline = curve_areas(fix(plain), ["_all"], label)
    others = inputs.select(F.col(key).alias("_donor"), F.col(VALUES).alias(OTHER))
    paired = permuted_pairs(inputs, repeats, seed, key).join(inputs, key).join(others, "_donor")
    names = F.lit(list(features))
    shuffled = scorer.changed(paired, ["repeat", label])
    scores = fix(shuffled.select(F.get(names, F.col("_at")).alias("feature"), "repeat", label, SCORE))
    areas = curve_areas(scores, ["feature", "repeat"], label)
    drops = areas.groupBy("feature").agg(
        (baseline.select("average_precision").scalar() - F.avg("average_precision")).alias(
            "importance"
        )
    )
    named = drops.select(
        F.lit(model_name).alias("model_name"),
        F.lit(PERMUTATION).alias("importance_type"),
        "feature",
        "importance",
    )
    return rank_importance(named)


def feature_importance(
    logistic: PipelineModel,
    forest: PipelineModel,
    test: DataFrame,
    features: Sequence[str],
    include_permutation: bool = True,
    repeats: int = REPEATS,
) -> DataFrame:
    """All importance tables of both models in one."""
    tables = [coefficient_importance(logistic, features), impurity_importance(forest, features)]
    if include_permutation:
        scorers = {LOGISTIC: LinearRescorer.of(logistic, features), FOREST: ForestRescorer.of(forest)}
        tables += [
            permutation_importance(test, features, scorer, name, repeats)
            for name, scorer in scorers.items()
        ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def top_features(importance: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    return importance.where(F.col("rank") <= n)


def consistent_features(
    top: DataFrame, n: int = TOP_FEATURES, more_than: int = 1
) -> DataFrame:
    """Features in more than ``more_than`` top lists: ``feature, top_list_count``."""
    counts = (
        top.where(F.col("rank") <= n)
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("top_list_count"))
    )
    return counts.where(F.col("top_list_count") > more_than).orderBy(
        F.desc("top_list_count"), "feature"
    )


def rows_of(test: DataFrame, ids: DataFrame, key: str = "sample_id") -> DataFrame:
    """Test rows whose id occurs in ``ids``."""
    return test.join(ids.select(key).distinct(), key, "left_semi")


def error_feature_profile(
    test: DataFrame,
    ranked: DataFrame,
    missed: DataFrame,
    features: Sequence[str],
    rank_limit: int = TOP_RISK_RANKS,
    key: str = "sample_id",
) -> DataFrame:
    """Mean, median, deviation and counts per feature for risky, missed and all test rows."""
    groups = {
        TOP_RISK_GROUP: rows_of(test, top_risk_ids(ranked, rank_limit, key), key),
        FALSE_NEGATIVE_GROUP: rows_of(test, missed, key),
        ALL_GROUP: test,
    }
    parts = [
        melt(rows, features).withColumn("group_name", F.lit(name)) for name, rows in groups.items()
    ]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    keys = ["group_name", "feature"]
    stats = long.groupBy(*keys).agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.count_if(F.col("value").isNull()).alias("missing_count"),
        F.count(F.lit(1)).alias("sample_count"),
    )
    medians = exact_median(long, keys, "value").drop("n")
    return stats.join(medians, keys, "left").select(
        *keys, "mean", "median", "std", "missing_count", "sample_count"
    )
