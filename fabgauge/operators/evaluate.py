"""Evaluation of scored rows: ``model, label (0/1), score``, grouped by model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabgauge.functions.columns import require_columns
from fabgauge.functions.rules import check_open_unit, f_beta, predicted_label, safe_ratio
from fabgauge.operators.ordered import cell_offsets, cut_points, with_cell, with_rank
from fabgauge.session import pin

# The threshold grid 0.05 to 0.95, names of thresholds, warning text.
THRESHOLDS = [round(i * 5 / 100, 2) for i in range(1, 20)]
DEFAULT_THRESHOLD = 0.5
DEFAULT_THRESHOLD_TYPE = "default_0.5"
BEST_F2_THRESHOLD_TYPE = "best_f2"
ONE_CLASS_TEST_WARNING = (
    "official test split contains one class only; average_precision and roc_auc are null"
)

# Columns of a metric table, in order, after those that name the model.
METRIC_COLUMNS = [
    "threshold", "accuracy", "precision", "recall", "f1", "f2", "average_precision", "roc_auc",
    "true_positive", "false_positive", "true_negative", "false_negative", "warnings",
]

LABEL = "label_binary"
SCORE = "defect_probability"


def confusion_counts(label: Column, predicted: Column) -> list[Column]:
    return [
        F.count_if((label == 1) & (predicted == 1)).alias("tp"),
        F.count_if((label == 0) & (predicted == 1)).alias("fp"),
        F.count_if((label == 0) & (predicted == 0)).alias("tn"),
        F.count_if((label == 1) & (predicted == 0)).alias("fn"),
    ]


def rates() -> dict[str, Column]:
    """Rates over the columns ``tp, fp, tn, fn``; every empty denominator gives 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return {
        "accuracy": safe_ratio(tp + tn, tp + fp + tn + fn),
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": f_beta(tp, fp, fn, 1.0),
        "f2": f_beta(tp, fp, fn, 2.0),
        "false_negative_rate": safe_ratio(fn, tp + fn),
    }


def confusion_matrix(
    scored: DataFrame,
    group: Sequence[str] = ("model_name",),
    threshold: float = DEFAULT_THRESHOLD,
    label: str = LABEL,
    score: str = SCORE,
) -> DataFrame:
    """``group..., tp, fp, tn, fn`` at one threshold."""
    predicted = predicted_label(F.col(score), threshold)
    return scored.groupBy(*group).agg(*confusion_counts(F.col(label), predicted))


def curve_areas(
    scored: DataFrame,
    group: Sequence[str] = ("model_name",),
    label: str = LABEL,
    score: str = SCORE,
) -> DataFrame:
    """Exact ``average_precision`` and ``roc_auc`` per group; NULL where one class is absent.

    Rows with one score are one step of the curve. Steps are summed inside score cells and
    shifted by the totals of the cells above, so a model's rows never meet in one task.
    """
    group = list(group)
    rows = scored.where(F.col(score).isNotNull()).select(
        *group, F.col(score).alias("_s"), F.col(label).alias("_y")
    )
    cuts = cut_points(rows, ["_s"])["_s"]
    placed = with_cell(rows, "_s", cuts, "_cell").drop("_cell_single")
    rows = placed.withColumn("_cell", -F.col("_cell"))
    counts = {"_p": F.count_if(F.col("_y") == 1), "_q": F.count_if(F.col("_y") == 0)}
    above = cell_offsets(rows, group, ["_cell"], counts).withColumnsRenamed(
        {"_p": "_p0", "_q": "_q0"}
    )
    upto = (
        Window.partitionBy(*group, "_cell")
        .orderBy(F.desc("_s"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    steps = (
        rows.groupBy(*group, "_cell", "_s")
        .agg(*[e.alias(n) for n, e in counts.items()])
        .withColumns({"_tp": F.sum("_p").over(upto), "_fp": F.sum("_q").over(upto)})
        .join(above, [*group, "_cell"])
        .withColumns({"_tp": F.col("_tp") + F.col("_p0"), "_fp": F.col("_fp") + F.col("_q0")})
    )
    positives, negatives = F.sum("_p"), F.sum("_q")
    precision = F.col("_tp") / (F.col("_tp") + F.col("_fp"))
    pairs_won = F.col("_q") * (F.col("_tp") - F.col("_p") / 2)
    both = (positives > 0) & (negatives > 0)
    return steps.groupBy(*group).agg(
        F.when(both, F.sum(F.col("_p") * precision) / positives).alias("average_precision"),
        F.when(both, F.sum(pairs_won) / (positives.cast("double") * negatives)).alias("roc_auc"),
    )


def classification_metrics(
    scored: DataFrame,
    group: Sequence[str] = ("model_name",),
    threshold: float = DEFAULT_THRESHOLD,
    label: str = LABEL,
    score: str = SCORE,
) -> DataFrame:
    """Rates at a threshold, curve areas and counts, one row per group.

    With one class only in the scored rows the areas are NULL and ``warnings`` says so.
    """
    counts = confusion_matrix(scored, group, threshold, label, score)
    table = counts.join(curve_areas(scored, group, label, score), list(group), "left")
    positives, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    warning = F.when((positives == 0) | (negatives == 0), ONE_CLASS_TEST_WARNING).otherwise("")
    values = rates()
    return table.select(
        *group,
        F.lit(float(threshold)).alias("threshold"),
        *[values[n].alias(n) for n in ("accuracy", "precision", "recall", "f1", "f2")],
        "average_precision",
        "roc_auc",
        F.col("tp").alias("true_positive"),
        F.col("fp").alias("false_positive"),
        F.col("tn").alias("true_negative"),
        F.col("fn").alias("false_negative"),
        warning.alias("warnings"),
    )


def metric_table(metrics: DataFrame) -> DataFrame:
    """The columns of a metric table in their order, whatever wrote it; a missing one is an error."""
    require_columns(metrics, METRIC_COLUMNS, "Metric table")
    before = [c for c in metrics.columns if c not in METRIC_COLUMNS]
    return metrics.select(*before, *METRIC_COLUMNS)


def threshold_metrics(
    scored: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    group: Sequence[str] = ("model_name",),
    label: str = LABEL,
    score: str = SCORE,
) -> DataFrame:
    """Counts and rates per group and threshold.

    Each row is counted once, in the bin of the thresholds it reaches; the grid is laid over
    the bins afterwards. Rows are neither repeated per threshold nor shuffled.
    """
    for t in thresholds:
        check_open_unit("threshold", t)
    grid = sorted(thresholds)
    reached = sum((predicted_label(F.col(score), t) for t in grid), F.lit(0))
    bins = scored.groupBy(*group, F.coalesce(reached, F.lit(0)).alias("_bin")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_q")
    )

    def total(count: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(count)).otherwise(0))

    cells = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            total("_p", F.col("_bin") > i).alias("tp"),
            total("_q", F.col("_bin") > i).alias("fp"),
            total("_q", F.col("_bin") <= i).alias("tn"),
            total("_p", F.col("_bin") <= i).alias("fn"),
        )
        for i, t in enumerate(grid)
    ]
    table = (
        bins.groupBy(*group)
        .agg(F.array(*cells).alias("_grid"))
        .select(*group, F.inline("_grid"))
    )
    values = rates()
    return table.select(
        *group,
        "threshold",
        *[values[n].alias(n) for n in ("accuracy", "precision", "recall", "f1", "f2")],
        "tp",
        "fp",
        "tn",
        "fn",
        values["false_negative_rate"].alias("false_negative_rate"),
        (F.col("tp") + F.col("fp")).alias("predicted_positive_count"),
    )


def operating_point(metrics: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return metrics.where(F.abs(F.col("threshold") - F.lit(threshold)) < 1e-9)


def best_f2(metrics: DataFrame) -> DataFrame:
    """The threshold row with the best F2 per model, the lower threshold on ties."""
    order = Window.partitionBy("model_name").orderBy(F.desc("f2"), F.asc("threshold"))
    return metrics.withColumn("_at", F.row_number().over(order)).where("_at = 1").drop("_at")


def false_negative_reduction(metrics: DataFrame) -> DataFrame:
    """Missed defects at the default threshold against the best-F2 one, per model."""
    default = operating_point(metrics).select(
        "model_name",
        F.col("threshold").alias("default_threshold"),
        F.col("fn").alias("default_false_negative"),
    )
    best = best_f2(metrics).select(
        "model_name",
        F.col("threshold").alias("best_f2_threshold"),
        F.col("fn").alias("best_f2_false_negative"),
    )
    return default.join(best, "model_name").withColumn(
        "false_negative_reduction",
        F.col("default_false_negative") - F.col("best_f2_false_negative"),
    )


def false_negatives(
    scored: DataFrame,
    threshold: float | Column,
    threshold_type: str | Column,
    label: str = LABEL,
    score: str = SCORE,
) -> DataFrame:
    """Defects scored under the threshold or not at all, with the threshold they were missed at."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    kind = threshold_type if isinstance(threshold_type, Column) else F.lit(threshold_type)
    missed = scored.where((F.col(label) == 1) & (predicted_label(F.col(score), limit) == 0))
    context = [c for c in ("timestamp", "label_original") if c in scored.columns]
    return missed.select(
        "model_name",
        kind.alias("threshold_type"),
        limit.alias("threshold"),
        "sample_id",
        *context,
        label,
        score,
        F.lit(0).alias("predicted_label"),
        F.lit("false_negative").alias("error_type"),
    )


def false_negative_analysis(
    scored: DataFrame, metrics: DataFrame, label: str = LABEL, score: str = SCORE
) -> DataFrame:
    """Defects missed at 0.5 and at the model's best-F2 threshold, in one pass over the scores."""
    best = pin(best_f2(metrics).select("model_name", F.col("threshold").alias("_best")))
    limits = F.array(
        F.struct(
            F.lit(DEFAULT_THRESHOLD_TYPE).alias("_type"),
            F.lit(DEFAULT_THRESHOLD).alias("_limit"),
        ),
        F.struct(F.lit(BEST_F2_THRESHOLD_TYPE).alias("_type"), F.col("_best").alias("_limit")),
    )
    defects = scored.where(F.col(label) == 1).join(best, "model_name")
    checked = defects.select(*scored.columns, F.inline(limits))
    return false_negatives(checked, F.col("_limit"), F.col("_type"), label, score)


def false_negative_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("model_name", "threshold_type").agg(F.count(F.lit(1)).alias("count"))


def top_risk_samples(scored: DataFrame, score: str = SCORE, key: str = "sample_id") -> DataFrame:
    """Every scored row with its position by score, highest first, per model."""
    return with_rank(scored, ["model_name"], score, key, descending=True, name="rank")


def top_risk_head(
    scored: DataFrame, n: int = 30, score: str = SCORE, key: str = "sample_id"
) -> DataFrame:
    """Only ranks 1 to ``n`` per model; each task keeps its own ``n`` before the shuffle."""
    order = Window.partitionBy("model_name").orderBy(F.col(score).desc_nulls_last(), F.asc(key))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_risk_ids(ranked: DataFrame, n: int = 30, key: str = "sample_id") -> DataFrame:
    return ranked.where(F.col("rank") <= n).select(key).distinct()


def prediction_sample(
    scored: DataFrame,
    n: int = 30,
    threshold: float = DEFAULT_THRESHOLD,
    key: str = "sample_id",
    label: str = LABEL,
    score: str = SCORE,
) -> DataFrame:
    """The first ``n`` rows per model by id: ``model_name, row_index, y_true, y_pred, y_score``."""
    order = Window.partitionBy("model_name").orderBy(key)
    head = scored.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= n)
    return head.select(
        "model_name",
        F.col(key).alias("row_index"),
        F.col(label).alias("y_true"),
        predicted_label(F.col(score), threshold).alias("y_pred"),
        F.col(score).alias("y_score"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("average_precision"), "model_name").limit(1)


def stack(tables: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union of result tables, each tagged with its name."""
    parts = [t.withColumn(tag, F.lit(name)) for name, t in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
