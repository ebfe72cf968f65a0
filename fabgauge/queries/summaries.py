"""Queries for the catalog and the summary tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabgauge.operators import evaluate, explain, profile
from fabgauge.plans import master, summary
from fabgauge.queries import adapters as A
from fabgauge.queries import events, modeling, scoring, wide
from fabgauge.queries.registry import query, rounded, rounded_sql, with_tables
from fabgauge.session import together
from fabgauge.sources import catalog

CATALOG = {"c": A.CATALOG_SQL}


@query("source_inventory")
def source_inventory(spark, folder):
    return catalog.source_inventory(spark, f"{folder}/*.parquet").drop("modified_at")


@query(
    "dataset_inventory",
    with_tables(
        {
            "c": A.INVENTORY_CATALOG_SQL,
            "f": A.FILES_SQL,
            "owned": """SELECT path, length, modificationTime, max_by('file:/lake/' || local_raw_path,
                length(local_raw_path)) AS folder FROM f
              JOIN (SELECT DISTINCT local_raw_path FROM c) d
                ON starts_with(path, 'file:/lake/' || local_raw_path || '/')
              GROUP BY path, length, modificationTime""",
            "t": """SELECT folder, count(*) AS file_count, CAST(sum(length) AS BIGINT) AS size_bytes,
                max(modificationTime) AS modified_at FROM owned GROUP BY folder""",
        },
        """SELECT dataset_id, source_url, local_raw_path, license_note, file_count, size_bytes, modified_at
        FROM c LEFT JOIN t ON folder = 'file:/lake/' || local_raw_path""",
    ),
)
def dataset_inventory(spark, folder):
    return catalog.dataset_inventory(A.inventory_catalog(spark, folder), A.files(spark, folder), "/lake")


@query("dataset_catalog", with_tables(CATALOG, f"SELECT {', '.join(catalog.CATALOG_FIELDS)} FROM c"))
def dataset_catalog(spark, folder):
    return catalog.dataset_catalog(A.catalog(spark, folder))


@query("catalog_plan", with_tables(CATALOG, f"SELECT {', '.join(catalog.PLAN_FIELDS)} FROM c"))
def catalog_plan(spark, folder):
    return catalog.catalog_plan(A.catalog(spark, folder))


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query(
    "check_catalog",
    with_tables(
        CATALOG,
        f"""SELECT dataset_id, 'empty_source_url' AS rule FROM c
          WHERE source_url IS NULL OR trim(source_url) = ''
        UNION ALL SELECT dataset_id, 'unsupported_modality' FROM c
          WHERE modality NOT IN ({_in(catalog.MODALITIES)})
        UNION ALL SELECT dataset_id, 'unsupported_use_in_project' FROM c
          WHERE use_in_project NOT IN ({_in(catalog.USES)})
        UNION ALL SELECT dataset_id, 'duplicate_dataset_id' FROM c
          GROUP BY dataset_id HAVING count(*) > 1""",
    ),
)
def check_catalog(spark, folder):
    return catalog.catalog_violations(A.catalog(spark, folder))


def _item(item: str, name: str, value: str, source: str) -> str:
    return (
        f"SELECT '{item}' AS item, CAST({name} AS VARCHAR) AS name, "
        f"CAST({value} AS DOUBLE) AS value FROM {source}"
    )


@query(
    "summary_profile",
    rounded_sql(
        with_tables(
            {
                **wide.LONG,
                "report": wide.MISSING_REPORT,
                "top": "SELECT * FROM report ORDER BY missing_ratio DESC, missing_count DESC, "
                "feature LIMIT 10",
                "labels_": "SELECT label, count(*) AS n FROM w GROUP BY label",
            },
            " UNION ALL ".join(
                [
                    _item("label_distribution", "label", "n", "labels_"),
                    _item("totals", "'feature_count'", "count(*)", "report"),
                    _item("totals", "'total_missing_values'", "sum(missing_count)", "report"),
                    _item("top_missing_features", "feature", "missing_ratio", "top"),
                ]
            ),
        ),
        ["value"],
    ),
)
def summary_profile(spark, folder):
    rows = A.sensor_wide(spark, folder)
    return rounded(
        summary.summary_profile(profile.missing_values(rows), profile.label_distribution(rows))
    )


def _group_item(item: str, column: str, source: str) -> str:
    return _item(item, column, "count(*)", source) + f" GROUP BY {column}"


@query(
    "summary_quality",
    with_tables(
        wide.QUALITY,
        " UNION ALL ".join(
            [
                _group_item("recommended_action_counts", "recommended_action", "quality"),
                _group_item("missing_bucket_counts", "missing_bucket", "quality"),
                _item("totals", "'feature_count'", "count(*)", "quality"),
                _item(
                    "totals",
                    "'constant_drop_candidates'",
                    "count(*) FILTER (is_constant AND recommended_action = 'drop_candidate')",
                    "quality",
                ),
            ]
        ),
    ),
)
def summary_quality(spark, folder):
    return summary.summary_quality(wide.graded(spark, folder))


@query(
    "summary_features",
    with_tables(
        {**wide.QUALITY, "parted": wide.split_sql("w", "label")},
        f"""SELECT q.*, count(*) FILTER (recommended_action <> 'drop_candidate')
            AS final_feature_count,
          (SELECT count(*) FROM parted WHERE split = 'train') AS train_row_count,
          (SELECT count(*) FROM parted WHERE split = 'test') AS test_row_count,
          'median' AS imputation_strategy, '{master.LEAKAGE_NOTE}' AS leakage_prevention_note
        FROM quality CROSS JOIN ({wide._QUALITY_COUNTS}) q GROUP BY ALL""",
    ),
)
def summary_features(spark, folder):
    rows = A.sensor_wide(spark, folder)
    graded = wide.graded(spark, folder)
    built = master.build_feature_set(rows, graded)
    return summary.summary_features(master.feature_set_metadata(built, graded))


@query(
    "summary_master",
    with_tables(
        {**wide.MASTER_TABLES, "m": wide.MASTER_SQL},
        f"""SELECT {', '.join(master.WIDE_LINEAGE)}, count(*) AS row_count,
          CAST({len(A.SELECTED)} AS BIGINT) AS selected_feature_count,
          count(*) FILTER (split = 'train') AS train_row_count,
          count(*) FILTER (split = 'test') AS test_row_count,
          {', '.join(f"count(*) FILTER (split = '{p}' AND label_binary = {v}) AS {p}_label_{v}_count"
                     for p in ('train', 'test') for v in (0, 1))}
        FROM m GROUP BY ALL""",
    ),
)
def summary_master(spark, folder):
    built = wide.wide_master(spark, folder)
    return summary.summary_master(built.table, len(built.features))


@query(
    "summary_models",
    rounded_sql(
        with_tables(
            {**scoring.METRICS, "m": scoring.METRICS_SQL},
            """SELECT *, row_number() OVER (ORDER BY average_precision DESC, model_name) = 1
            AS is_best FROM m""",
        ),
        scoring.METRIC_DOUBLES,
    ),
)
def summary_models(spark, folder):
    metrics = evaluate.classification_metrics(A.scored(spark, folder))
    return rounded(summary.summary_models(metrics))


_GRID_COLUMNS = [*scoring.GRID_DOUBLES, "tp", "fp", "tn", "fn", "predicted_positive_count"]
_TOP_ROW = "model_name || '.' || importance_type || '.' || feature"


@query(
    "summary_thresholds",
    rounded_sql(
        with_tables(
            scoring.MISSED,
            " UNION ALL ".join(
                [
                    _item("totals", "'threshold_count'", "count(DISTINCT threshold)", "grid_metrics"),
                    _item("totals", "'top_risk_sample_count'", "count(*)", "s"),
                    _item("totals", "'false_negative_rows'", "count(*)", "missed"),
                    _item("default_f2", "model_name", "f2", "grid_metrics")
                    + " WHERE abs(threshold - 0.5) < 1e-9",
                    *[
                        _item("default_row", f"model_name || '.{c}'", c, "grid_metrics")
                        + " WHERE abs(threshold - 0.5) < 1e-9"
                        for c in _GRID_COLUMNS
                    ],
                    *[_item("best_row", f"model_name || '.{c}'", c, "best") for c in _GRID_COLUMNS],
                    _item("best_f2", "model_name", "f2", "best"),
                    _item("best_threshold", "model_name", "threshold", "best"),
                    _item(
                        "false_negatives",
                        "model_name || '.' || threshold_type",
                        "count(*)",
                        "missed",
                    )
                    + " GROUP BY model_name, threshold_type",
                ]
            ),
        ),
        ["value"],
    ),
)
def summary_thresholds(spark, folder):
    scored = A.scored(spark, folder)
    metrics = evaluate.threshold_metrics(scored)
    missed = evaluate.false_negative_analysis(scored, metrics)
    ranked = scored.agg(F.count(F.lit(1)))
    return rounded(summary.summary_thresholds(metrics, ranked, missed))


@query(
    "summary_explain",
    with_tables(
        {
            **modeling._VALUES,
            **{f"p_{k}" if k == "long" else k: v for k, v in modeling.PROFILE.items() if k != "w"},
            "profile": modeling.PROFILE_SQL.replace("FROM long", "FROM p_long"),
            "importance_": modeling._VALUES["ranked"],
            "shared": """SELECT feature, count(*) AS n FROM importance_ WHERE rank <= 20
              GROUP BY feature ORDER BY n DESC, feature LIMIT 20""",
        },
        " UNION ALL ".join(
            [
                _item("totals", "'importance_row_count'", "count(*)", "importance_"),
                _item("totals", "'profile_row_count'", "count(*)", "profile"),
                _group_item("importance_types", "importance_type", "importance_"),
                _group_item("error_profile_groups", "group_name", "profile"),
                _item("top_features", _TOP_ROW, "rank", "importance_") + " WHERE rank <= 20",
                _item("top_importance", _TOP_ROW, "importance", "importance_") + " WHERE rank <= 20",
                _item("consistent_top_features", "feature", "n", "shared"),
            ]
        ),
    ),
)
def summary_explain(spark, folder):
    ranked = modeling._ranked(spark, folder)
    profiled = modeling.error_profile(spark, folder)
    return summary.summary_explain(ranked, explain.top_features(ranked), profiled)


@query("quality_summary")
def quality_summary(spark, folder):
    sections = {
        "data_profile": summary_profile(spark, folder),
        "quality_rules": summary_quality(spark, folder),
        "feature_engineering": summary_features(spark, folder),
        "modeling_master_table": summary_master(spark, folder),
        "baseline_modeling": summary_models(spark, folder),
        "threshold_error_analysis": summary_thresholds(spark, folder),
        "explainability": summary_explain(spark, folder),
    }
    return summary.quality_summary(sections, "quality-summary", "sensor table")


@query("model_comparison")
def model_comparison(spark, folder):
    trained = together(
        lambda: modeling._trained(spark, folder),
        lambda: modeling.trained_on(events.d2_master(spark, folder)),
    )
    return summary.model_comparison([t.metrics for t in trained])
