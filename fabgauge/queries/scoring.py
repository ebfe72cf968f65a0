"""Queries on scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabgauge.functions.rules import f_beta, predicted_label
from fabgauge.operators import evaluate, explain
from fabgauge.queries import adapters as A
from fabgauge.queries.registry import query, rounded, rounded_sql, with_tables

SCORED = {"s": A.SCORED_SQL}
MODELS = ("model_a", "model_b")


def areas_sql(source: str, group: str, label: str, score: str) -> str:
    """Average precision and ROC area by plain windows over distinct scores."""
    return f"""SELECT {group},
      CASE WHEN sum(p) > 0 AND sum(q) > 0
        THEN sum(p * (CAST(tp AS DOUBLE) / (tp + fp))) / sum(p) END AS average_precision,
      CASE WHEN sum(p) > 0 AND sum(q) > 0
        THEN sum(q * (tp - p / 2.0E0)) / (CAST(sum(p) AS DOUBLE) * sum(q)) END AS roc_auc
    FROM (SELECT *, sum(p) OVER (PARTITION BY {group} ORDER BY score_ DESC) AS tp,
        sum(q) OVER (PARTITION BY {group} ORDER BY score_ DESC) AS fp
      FROM (SELECT {group}, {score} AS score_, count(*) FILTER ({label} = 1) AS p,
        count(*) FILTER ({label} = 0) AS q FROM {source} GROUP BY {group}, {score}))
    GROUP BY {group}"""


def _counts(condition: str, source: str, group: str) -> str:
    return f"""SELECT {group},
      count(*) FILTER (label_binary = 1 AND {condition}) AS tp,
      count(*) FILTER (label_binary = 0 AND {condition}) AS fp,
      count(*) FILTER (label_binary = 0 AND NOT {condition}) AS tn,
      count(*) FILTER (label_binary = 1 AND NOT {condition}) AS fn
    FROM {source} GROUP BY ALL"""


_RATES = """CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0
    ELSE 2.0E0 * tp / (2 * tp + fp + fn) END AS f1,
  CASE WHEN 5 * tp + 4 * fn + fp = 0 THEN 0
    ELSE 5.0E0 * tp / (5 * tp + 4 * fn + fp) END AS f2"""
RATE_COLUMNS = ["accuracy", "precision", "recall", "f1", "f2"]

GRID = {
    **SCORED,
    "grid": "SELECT CAST(i AS DOUBLE) * 5 / 100 AS threshold FROM range(1, 20) r(i)",
    "grid_rows": "SELECT * FROM s CROSS JOIN grid",
    "grid_counts": _counts(
        "defect_probability >= threshold", "grid_rows", "model_name, threshold"
    ),
    "grid_metrics": f"""SELECT model_name, threshold, {_RATES}, tp, fp, tn, fn,
      CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(fn AS DOUBLE) / (tp + fn) END AS false_negative_rate,
      tp + fp AS predicted_positive_count FROM grid_counts""",
    "best": """SELECT * EXCLUDE (at_) FROM (SELECT *, row_number() OVER (
      PARTITION BY model_name ORDER BY f2 DESC, threshold) AS at_ FROM grid_metrics)
      WHERE at_ = 1""",
}
GRID_DOUBLES = ["threshold", *RATE_COLUMNS, "false_negative_rate"]
METRICS = {
    **SCORED,
    "areas": areas_sql("s", "model_name", "label_binary", "defect_probability"),
    "counts": _counts("defect_probability >= 0.5", "s", "model_name"),
}
METRICS_SQL = f"""SELECT model_name, 0.5E0 AS threshold, {_RATES}, average_precision, roc_auc,
  tp AS true_positive, fp AS false_positive, tn AS true_negative, fn AS false_negative,
  CASE WHEN tp + fn = 0 OR fp + tn = 0 THEN '{evaluate.ONE_CLASS_TEST_WARNING}' ELSE '' END
    AS warnings FROM counts JOIN areas USING (model_name)"""
METRIC_DOUBLES = [*RATE_COLUMNS, "average_precision", "roc_auc"]


def grid_metrics(spark, folder):
    return evaluate.threshold_metrics(A.scored(spark, folder))


@query(
    "predict_at_threshold",
    with_tables(
        SCORED,
        """SELECT model_name, sample_id,
        CASE WHEN defect_probability >= 0.3 THEN 1 ELSE 0 END AS predicted_label FROM s""",
    ),
)
def predict_at_threshold(spark, folder):
    label = predicted_label(F.col("defect_probability"), 0.3).alias("predicted_label")
    return A.scored(spark, folder).select("model_name", "sample_id", label)


_MISSED = """model_name, threshold_type, threshold, sample_id, label_binary, defect_probability,
  0 AS predicted_label, 'false_negative' AS error_type"""


@query(
    "false_negatives",
    with_tables(
        SCORED,
        f"""SELECT {_MISSED} FROM (SELECT *, 'default_0.5' AS threshold_type,
        0.5E0 AS threshold FROM s) WHERE label_binary = 1 AND defect_probability < threshold""",
    ),
)
def false_negatives(spark, folder):
    return evaluate.false_negatives(A.scored(spark, folder), 0.5, "default_0.5")


@query(
    "threshold_metrics",
    rounded_sql(with_tables(GRID, "SELECT * FROM grid_metrics"), GRID_DOUBLES),
)
def threshold_metrics(spark, folder):
    return rounded(grid_metrics(spark, folder))


@query(
    "threshold_grid",
    rounded_sql(with_tables(GRID, "SELECT * FROM grid_counts"), ["threshold"]),
)
def threshold_grid(spark, folder):
    counts = grid_metrics(spark, folder)
    return rounded(counts.select("model_name", "threshold", "tp", "fp", "tn", "fn"))


@query(
    "operating_point_rows",
    rounded_sql(
        with_tables(GRID, "SELECT * FROM grid_metrics WHERE abs(threshold - 0.5) < 1e-9"),
        GRID_DOUBLES,
    ),
)
def operating_point_rows(spark, folder):
    return rounded(evaluate.operating_point(grid_metrics(spark, folder)))


@query(
    "best_f2_threshold", rounded_sql(with_tables(GRID, "SELECT * FROM best"), GRID_DOUBLES)
)
def best_f2_threshold(spark, folder):
    return rounded(evaluate.best_f2(grid_metrics(spark, folder)))


@query(
    "fbeta",
    rounded_sql(
        with_tables(
            {
                "o": "SELECT o_custkey AS batch, o_orderstatus AS st, "
                "o_totalprice > 250000 AS p FROM orders"
            },
            """SELECT batch, CASE WHEN 5 * tp + 4 * fn + fp = 0 THEN 0
            ELSE 5.0E0 * tp / (5 * tp + 4 * fn + fp) END AS f2 FROM (
            SELECT batch, count(*) FILTER (st = 'F' AND p) AS tp,
            count(*) FILTER (st <> 'F' AND p) AS fp, count(*) FILTER (st = 'F' AND NOT p) AS fn
            FROM o GROUP BY batch)""",
        ),
        ["f2"],
    ),
)
def fbeta(spark, folder):
    # Many small batches, some without any positive, so empty denominators occur.
    rows = A.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("batch"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") > 250000).cast("int").alias("p"),
    )
    counts = rows.groupBy("batch").agg(*evaluate.confusion_counts(F.col("y"), F.col("p")))
    return rounded(
        counts.select("batch", f_beta(F.col("tp"), F.col("fp"), F.col("fn")).alias("f2"))
    )


@query(
    "confusion_matrix",
    with_tables(METRICS, "SELECT model_name, tp, fp, tn, fn FROM counts"),
)
def confusion_matrix(spark, folder):
    return evaluate.confusion_matrix(A.scored(spark, folder))


@query(
    "average_precision",
    rounded_sql(
        with_tables(METRICS, "SELECT model_name, average_precision FROM areas"),
        ["average_precision"],
    ),
)
def average_precision(spark, folder):
    areas = evaluate.curve_areas(A.scored(spark, folder))
    return rounded(areas.select("model_name", "average_precision"))


@query(
    "roc_auc",
    rounded_sql(with_tables(METRICS, "SELECT model_name, roc_auc FROM areas"), ["roc_auc"]),
)
def roc_auc(spark, folder):
    return rounded(evaluate.curve_areas(A.scored(spark, folder)).select("model_name", "roc_auc"))


@query(
    "classification_metrics", rounded_sql(with_tables(METRICS, METRICS_SQL), METRIC_DOUBLES)
)
def classification_metrics(spark, folder):
    return rounded(evaluate.classification_metrics(A.scored(spark, folder)))


_ONE_CLASS = {"s": f"SELECT * FROM ({A.SCORED_SQL}) WHERE label_binary = 0 OR model_name = 'model_a'"}


@query(
    "safe_metrics",
    rounded_sql(with_tables({**METRICS, **_ONE_CLASS}, METRICS_SQL), METRIC_DOUBLES),
)
def safe_metrics(spark, folder):
    # The second model is scored on rows of one class only.
    rows = A.scored(spark, folder).where("label_binary = 0 OR model_name = 'model_a'")
    return rounded(evaluate.classification_metrics(rows))


@query(
    "best_model",
    rounded_sql(
        with_tables(METRICS, f"{METRICS_SQL} ORDER BY average_precision DESC, model_name LIMIT 1"),
        METRIC_DOUBLES,
    ),
)
def best_model(spark, folder):
    return rounded(evaluate.best_model(evaluate.classification_metrics(A.scored(spark, folder))))


@query(
    "fn_reduction",
    rounded_sql(
        with_tables(
            GRID,
            """SELECT d.model_name, d.threshold AS default_threshold,
            d.fn AS default_false_negative, b.threshold AS best_f2_threshold,
            b.fn AS best_f2_false_negative, d.fn - b.fn AS false_negative_reduction
            FROM grid_metrics d JOIN best b USING (model_name)
            WHERE abs(d.threshold - 0.5) < 1e-9""",
        ),
        ["default_threshold", "best_f2_threshold"],
    ),
)
def fn_reduction(spark, folder):
    return rounded(evaluate.false_negative_reduction(grid_metrics(spark, folder)))


MISSED = {
    **GRID,
    "limits": """SELECT model_name, 'default_0.5' AS threshold_type, 0.5E0 AS threshold FROM best
      UNION ALL SELECT model_name, 'best_f2', threshold FROM best""",
    "missed": f"""SELECT {_MISSED} FROM s JOIN limits USING (model_name)
      WHERE label_binary = 1 AND defect_probability < threshold""",
}


def missed(spark, folder):
    return evaluate.false_negative_analysis(A.scored(spark, folder), grid_metrics(spark, folder))


@query(
    "false_negative_analysis",
    rounded_sql(
        with_tables(MISSED, "SELECT * FROM missed"), ["threshold", "defect_probability"]
    ),
)
def false_negative_analysis(spark, folder):
    return rounded(missed(spark, folder))


@query(
    "fn_counts",
    with_tables(
        MISSED,
        'SELECT model_name, threshold_type, count(*) AS "count" FROM missed GROUP BY ALL',
    ),
)
def fn_counts(spark, folder):
    return evaluate.false_negative_counts(missed(spark, folder))


RANKED = {
    **SCORED,
    "ranked": """SELECT *, row_number() OVER (PARTITION BY model_name
      ORDER BY defect_probability DESC, sample_id) AS rank FROM s""",
}


@query(
    "top_risk_samples",
    rounded_sql(with_tables(RANKED, "SELECT * FROM ranked"), ["defect_probability"]),
)
def top_risk_samples(spark, folder):
    return rounded(evaluate.top_risk_samples(A.scored(spark, folder)))


@query(
    "top_risk_materials",
    rounded_sql(
        with_tables(
            SCORED,
            """SELECT * EXCLUDE (sample_id), CAST(sample_id AS VARCHAR) AS material_id,
            row_number() OVER (PARTITION BY model_name
              ORDER BY defect_probability DESC, CAST(sample_id AS VARCHAR)) AS rank FROM s""",
        ),
        ["defect_probability"],
    ),
)
def top_risk_materials(spark, folder):
    """Ranks of materials, whose ids are texts."""
    named = A.scored(spark, folder).withColumn("material_id", F.col("sample_id").cast("string"))
    return rounded(evaluate.top_risk_samples(named.drop("sample_id"), key="material_id"))


@query(
    "top_n_risk_ids",
    with_tables(RANKED, "SELECT DISTINCT sample_id FROM ranked WHERE rank <= 30"),
)
def top_n_risk_ids(spark, folder):
    return evaluate.top_risk_ids(evaluate.top_risk_head(A.scored(spark, folder)))


_ORDER_ROWS = "SELECT o_orderkey AS sample_id, o_totalprice, o_orderpriority FROM orders"


def _order_rows(spark, folder):
    return A.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS sample_id", "o_totalprice", "o_orderpriority"
    )


@query(
    "top_risk_rows",
    with_tables(
        RANKED,
        f"""SELECT * FROM ({_ORDER_ROWS})
        WHERE sample_id IN (SELECT sample_id FROM ranked WHERE rank <= 30)""",
    ),
)
def top_risk_rows(spark, folder):
    ids = evaluate.top_risk_ids(evaluate.top_risk_head(A.scored(spark, folder)))
    return explain.rows_of(_order_rows(spark, folder), ids)


@query(
    "fn_rows",
    with_tables(
        MISSED,
        f"SELECT * FROM ({_ORDER_ROWS}) WHERE sample_id IN (SELECT sample_id FROM missed)",
    ),
)
def fn_rows(spark, folder):
    return explain.rows_of(_order_rows(spark, folder), missed(spark, folder))


@query(
    "distinct_ids", with_tables(MISSED, "SELECT DISTINCT sample_id FROM missed")
)
def distinct_ids(spark, folder):
    return missed(spark, folder).select("sample_id").distinct()


@query(
    "prediction_sample",
    rounded_sql(
        with_tables(
            SCORED,
            """SELECT model_name, sample_id AS row_index, label_binary AS y_true,
            CASE WHEN defect_probability >= 0.5 THEN 1 ELSE 0 END AS y_pred,
            defect_probability AS y_score FROM (SELECT *, row_number() OVER (
            PARTITION BY model_name ORDER BY sample_id) AS at_ FROM s) WHERE at_ <= 30""",
        ),
        ["y_score"],
    ),
)
def prediction_sample(spark, folder):
    return rounded(evaluate.prediction_sample(A.scored(spark, folder)))


_COUNTS_OF = (
    "SELECT '{0}' AS run, model_name, tp, fp, tn, fn FROM ("
    + _counts("defect_probability >= 0.5", "s", "model_name")
    + ") WHERE model_name = '{0}'"
)


@query(
    "union_models",
    with_tables(SCORED, " UNION ALL ".join(_COUNTS_OF.format(m) for m in MODELS)),
)
def union_models(spark, folder):
    rows = A.scored(spark, folder)
    tables = {
        m: evaluate.confusion_matrix(rows.where(F.col("model_name") == m)) for m in MODELS
    }
    return evaluate.stack(tables, "run")
