"""Queries that fit models or explain them, on the wide master and the material master."""

from __future__ import annotations

from functools import lru_cache, partial

from pyspark.sql import functions as F

from fabgauge.operators import evaluate, explain, impute, models, rescoring, split
from fabgauge.operators.profile import melt
from fabgauge.plans.wide_run import checked_parts, scored_run
from fabgauge.queries import adapters as A
from fabgauge.queries.events import d1_master
from fabgauge.queries.registry import query, rounded, rounded_sql, with_tables
from fabgauge.queries.scoring import areas_sql
from fabgauge.queries.wide import BINARY, LONG, WIDE_SPLIT, wide_master
from fabgauge.session import pin, release, together


def version(spark, folder, name):
    """The files of a table and when they were written, so that fits of other data are not reused."""
    files = A.table(spark, folder, name).select("_metadata.file_path", "_metadata.file_modification_time")
    return tuple(sorted(map(tuple, files.distinct().collect())))


@lru_cache(maxsize=4)
def _parts(spark, folder, files):
    built = wide_master(spark, folder)
    return built.features, *checked_parts(built)


@lru_cache(maxsize=8)
def _fitted(spark, folder, files, name):
    """One of the models, so that a query on the other one does not wait for it."""
    features, train, _ = _parts(spark, folder, files)
    fit = {models.LOGISTIC: models.train_logistic, models.FOREST: models.train_forest}[name]
    return fit(train, features)


@lru_cache(maxsize=4)
def _run(spark, folder, files):
    features, _, test = _parts(spark, folder, files)
    names = (models.LOGISTIC, models.FOREST)
    fitted = together(*[partial(_fitted, spark, folder, files, n) for n in names])
    return scored_run(features, test, dict(zip(names, fitted, strict=True)))


def wide_run(spark, folder):
    """Both models and their scores; shared by the queries below."""
    return _run(spark, folder, version(spark, folder, "embeddings"))


def wide_model(spark, folder, name):
    files = version(spark, folder, "embeddings")
    return _fitted(spark, folder, files, name), _parts(spark, folder, files)[0]


@query("train_logistic")
def train_logistic(spark, folder):
    return explain.coefficient_importance(*wide_model(spark, folder, models.LOGISTIC))


@query("train_forest")
def train_forest(spark, folder):
    return explain.impurity_importance(*wide_model(spark, folder, models.FOREST))


@query("coefficient_importance")
def coefficient_importance(spark, folder):
    return explain.top_features(train_logistic(spark, folder))


@query("impurity_importance")
def impurity_importance(spark, folder):
    return explain.top_features(train_forest(spark, folder))


@query("positive_score")
def positive_score(spark, folder):
    return wide_run(spark, folder).scored.select("model_name", "sample_id", "label_binary", models.SCORE)


@query("model_metrics")
def model_metrics(spark, folder):
    return wide_run(spark, folder).metrics()


@query("feature_importance")
def feature_importance(spark, folder):
    return wide_run(spark, folder).importance()


@query("wide_branch_thresholds")
def wide_branch_thresholds(spark, folder):
    return wide_run(spark, folder).thresholds()


@query("wide_branch_missed_defects")
def wide_branch_missed_defects(spark, folder):
    return wide_run(spark, folder).missed_defects()


@query("wide_branch_error_profile")
def wide_branch_error_profile(spark, folder):
    return wide_run(spark, folder).error_profile()


def trained_on(master):
    """Train on a material master written to the checkpoint folder first, by columns, of which most passes read a few."""
    stored = pin(master)
    release(stored.sparkSession)
    return models.train_and_evaluate(stored)


@lru_cache(maxsize=4)
def _trained_files(spark, folder, files):
    return trained_on(d1_master(spark, folder))


def _trained(spark, folder):
    return _trained_files(spark, folder, version(spark, folder, "lineitem"))


@query("predictions")
def predictions(spark, folder):
    return _trained(spark, folder).predictions


@query("train_and_evaluate")
def train_and_evaluate(spark, folder):
    return _trained(spark, folder).metrics


# Importance values both engines can compute: absolute mean and deviation of each sensor.
_VALUES = {
    **LONG,
    "values_": """SELECT 'model_a' AS model_name, 'abs_mean' AS importance_type, feature,
      coalesce(round(abs(avg(value)), 6), 0) AS importance FROM long GROUP BY feature
      UNION ALL SELECT 'model_b', 'deviation', feature,
      coalesce(round(stddev_pop(value), 6), 0) FROM long GROUP BY feature""",
    "ranked": """SELECT *, CAST(row_number() OVER (PARTITION BY model_name, importance_type
      ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM values_""",
}


def _ranked(spark, folder):
    stats = (
        melt(A.sensor_wide(spark, folder), A.SENSORS)
        .groupBy("feature")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))
    )

    def values(model, kind, column):
        return stats.select(
            F.lit(model).alias("model_name"),
            F.lit(kind).alias("importance_type"),
            "feature",
            F.coalesce(F.round(column, 6), F.lit(0.0)).alias("importance"),
        )

    both = values("model_a", "abs_mean", F.abs("mean")).unionByName(
        values("model_b", "deviation", "deviation")
    )
    return explain.rank_importance(both)


@query("rank_importance", with_tables(_VALUES, "SELECT * FROM ranked"))
def rank_importance(spark, folder):
    return _ranked(spark, folder)


@query("top_features", with_tables(_VALUES, "SELECT * FROM ranked WHERE rank <= 20"))
def top_features(spark, folder):
    return explain.top_features(_ranked(spark, folder))


@query(
    "consistent_features",
    with_tables(
        _VALUES,
        """SELECT feature, count(*) AS top_list_count FROM ranked WHERE rank <= 20
        GROUP BY feature HAVING count(*) > 1""",
    ),
)
def consistent_features(spark, folder):
    return explain.consistent_features(explain.top_features(_ranked(spark, folder)))


# A fixed linear model over all selected sensors, missing values read as 0.
WEIGHTS = {name: (2 * (i * 37 % 13) - 13) / 2 for i, name in enumerate(A.SELECTED)}
REPEATS = explain.REPEATS


def _margin(columns: dict[str, str]) -> str:
    text = "0.0E0"
    for name, weight in WEIGHTS.items():
        text = f"({text} + {columns[name]} * {weight}E0)"
    return text


_PLAIN = {name: name for name in WEIGHTS}
_FILLED = ", ".join(f"coalesce({s}, 0.0E0) AS {s}" for s in WEIGHTS)
LINEAR = {
    **WIDE_SPLIT,
    "t": f"SELECT sample_id, {BINARY} AS label_binary, {_FILLED} FROM parted WHERE split = 'test'",
    "base": "SELECT average_precision AS ap FROM ("
    + areas_sql(
        f"(SELECT 1 AS one, label_binary, {_margin(_PLAIN)} AS score FROM t)",
        "one",
        "label_binary",
        "score",
    )
    + ")",
    "receivers": f"SELECT *, {_margin(_PLAIN)} AS margin, row_number() OVER (ORDER BY sample_id) AS at_ FROM t",
    "donors": f"""SELECT repeat, {', '.join(f'{s} AS new_{s}' for s in WEIGHTS)}, row_number()
      OVER (PARTITION BY repeat ORDER BY md5(CAST(sample_id AS VARCHAR) || '|'
        || CAST(repeat AS VARCHAR) || '|42'), sample_id) AS at_
      FROM t CROSS JOIN (SELECT range AS repeat FROM range(1, {REPEATS + 1}))""",
    "paired": "SELECT * FROM receivers JOIN donors USING (at_)",
    "changed": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, repeat, label_binary, "
        f"margin + (new_{f} - {f}) * {weight}E0 AS score FROM paired"
        for f, weight in WEIGHTS.items()
    ),
    "areas": areas_sql("changed", "feature, repeat", "label_binary", "score"),
    "drops": """SELECT 'linear' AS model_name, 'permutation_average_precision' AS importance_type,
      feature, (SELECT ap FROM base) - avg(average_precision) AS importance
      FROM areas GROUP BY feature""",
}


def _linear_test(spark, folder):
    rows = split.stratified_split(A.sensor_wide(spark, folder), "label", "sample_id")
    test = rows.where("split = 'test'").withColumn("label_binary", F.expr(BINARY))
    filled = impute.fill(test, dict.fromkeys(WEIGHTS, 0.0))
    return filled.select("sample_id", "label_binary", *WEIGHTS)


@query(
    "permutation_importance",
    rounded_sql(
        with_tables(
            LINEAR,
            """SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER)
            AS rank FROM drops""",
        ),
        ["importance"],
    ),
)
def permutation_importance(spark, folder):
    scorer = rescoring.LinearRescorer(list(WEIGHTS), list(WEIGHTS.values()))
    test = _linear_test(spark, folder)
    return rounded(explain.permutation_importance(test, list(WEIGHTS), scorer, "linear"))


# Error profile of the test rows, scored by the fixed linear model.
PROFILE = {
    **{k: v for k, v in LINEAR.items() if k in ("w", "parted", "t")},
    "scored": f"SELECT 'linear' AS model_name, sample_id, label_binary, {_margin(_PLAIN)} "
    "AS defect_probability FROM t",
    "risky": """SELECT sample_id FROM (SELECT *, row_number() OVER (
      ORDER BY defect_probability DESC, sample_id) AS rank FROM scored) WHERE rank <= 30""",
    "missed": "SELECT sample_id FROM scored WHERE label_binary = 1 AND defect_probability < 0.1",
    "test_rows": "SELECT * FROM parted WHERE split = 'test'",
    "grouped": """SELECT 'all_test_samples' AS group_name, * FROM test_rows
      UNION ALL SELECT 'top_risk_samples', * FROM test_rows
        WHERE sample_id IN (SELECT sample_id FROM risky)
      UNION ALL SELECT 'false_negative_samples', * FROM test_rows
        WHERE sample_id IN (SELECT sample_id FROM missed)""",
    "long": f"SELECT group_name, feature, value FROM grouped UNPIVOT INCLUDE NULLS "
    f"(value FOR feature IN ({', '.join(A.SENSORS)}))",
}
PROFILE_SQL = """SELECT group_name, feature, avg(value) AS mean, median(value) AS median,
  stddev_samp(value) AS std, count(*) - count(value) AS missing_count,
  count(*) AS sample_count FROM long GROUP BY ALL"""


def error_profile(spark, folder):
    scored = explain.linear_scorer(WEIGHTS)(_linear_test(spark, folder)).withColumn(
        "model_name", F.lit("linear")
    )
    rows = split.stratified_split(A.sensor_wide(spark, folder), "label", "sample_id")
    return explain.error_feature_profile(
        rows.where("split = 'test'"),
        evaluate.top_risk_head(scored),
        evaluate.false_negatives(scored, 0.1, "fixed"),
        A.SENSORS,
    )


@query(
    "error_feature_profile",
    rounded_sql(with_tables(PROFILE, PROFILE_SQL), ["mean", "median", "std"]),
)
def error_feature_profile(spark, folder):
    return rounded(error_profile(spark, folder))
