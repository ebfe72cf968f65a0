"""Profiles, grades and master tables on small hand-made sensor tables."""

import pytest
from pyspark.sql import functions as F

from fabgauge.functions.columns import WIDE_LINEAGE_COLUMNS, missing_columns, sensor_columns
from fabgauge.functions.columns import reject_metadata_features, statistic_columns
from fabgauge.operators import contracts, evaluate, impute, profile, quality, split
from fabgauge.plans import master, summary
from fabgauge.plans.wide_run import run_wide_branch
from fabgauge.queries import adapters
from fabgauge.queries.wide import wide_master

SAMPLES = "sample_id long, sensor_000 double, sensor_001 double, sensor_002 double, label int, timestamp string"


def samples(spark):
    rows = [(0, 1.0, None, 1.0, -1, "a"), (1, 2.0, 2.0, 2.0, 1, "b"), (2, None, None, None, -1, "c")]
    return spark.createDataFrame(rows, SAMPLES)


def test_profile_counts(spark):
    row = profile.dataset_profile(samples(spark)).first()
    assert (row.row_count, row.feature_count, row.duplicate_row_count) == (3, 3, 0)
    assert row.total_missing_values == 4
    assert row.overall_missing_value_ratio == pytest.approx(4 / 9)
    labels = profile.label_distribution(samples(spark)).collect()
    assert [(r.label, r["count"]) for r in labels] == [(-1, 2), (1, 1)]
    top = profile.top_missing(profile.missing_values(samples(spark)), 2).collect()
    assert [(r.feature, r.missing_count) for r in top] == [("sensor_001", 2), ("sensor_000", 1)]


def test_duplicates_ignore_the_id(spark):
    df = spark.createDataFrame(
        [(1, 5.0, -1, "t"), (2, 5.0, -1, "t")],
        "sample_id long, sensor_000 double, label int, timestamp string",
    )
    assert profile.duplicate_rows(df).first()[0] == 1


def test_empty_table_has_rows_with_zero(spark):
    empty = samples(spark).limit(0)
    assert {r.missing_ratio for r in profile.missing_values(empty).collect()} == {0.0}
    graded = quality.feature_quality(empty).collect()
    assert len(graded) == 3 and all(r.is_constant for r in graded)
    assert profile.dataset_profile(empty).first().overall_missing_value_ratio == 0.0


def test_wide_table_is_turned_in_batches(spark):
    names = [f"sensor_{i:03d}" for i in range(150)]
    df = spark.range(4).selectExpr("id AS sample_id", *[f"IF(id % 2 = 0, {i}.0D, NULL) AS {n}" for i, n in enumerate(names)])
    report = {r.feature: r.missing_count for r in profile.missing_values(df).collect()}
    assert report == dict.fromkeys(names, 2)
    medians = {r.feature: r.median for r in impute.column_medians(df, names).collect()}
    assert medians == {n: float(i) for i, n in enumerate(names)}


def test_buckets_and_actions_at_their_limits(spark):
    rows = [(i, *[None if i < m else float(i) for m in (1, 2, 3, 4)]) for i in range(5)]
    rows += [(5 + i, *[float(9 + i)] * 4) for i in range(5)]
    names = ["sensor_000", "sensor_001", "sensor_002", "sensor_003"]
    df = spark.createDataFrame(rows, "sample_id long, " + ", ".join(f"{n} double" for n in names))
    graded = {r.feature: r for r in quality.feature_quality(df).collect()}
    assert graded["sensor_002"].missing_ratio == 0.3
    assert graded["sensor_001"].missing_bucket == "low_missing_keep"
    assert graded["sensor_002"].missing_bucket == "medium_missing_review"
    assert graded["sensor_002"].recommended_action == "review"
    five = spark.createDataFrame(
        [(None, None, None), (1.0, None, None), (2.0, None, None), (3.0, 1.0, None), (4.0, 2.0, 1.0)],
        "sensor_000 double, sensor_001 double, sensor_002 double",
    )
    buckets = {r.feature: r.missing_bucket for r in quality.feature_quality(five).collect()}
    assert buckets == {
        "sensor_000": "low_missing_keep",
        "sensor_001": "medium_missing_review",
        "sensor_002": "high_missing_drop_candidate",
    }


def test_constant_sensor_is_dropped(spark):
    df = spark.createDataFrame(
        [(7.0, 1.0), (7.0, 2.0), (None, 3.0)], "sensor_000 double, sensor_001 double"
    )
    graded = {r.feature: r for r in quality.feature_quality(df).collect()}
    assert graded["sensor_000"].is_constant and graded["sensor_000"].unique_non_null_count == 1
    assert graded["sensor_000"].recommended_action == "drop_candidate"
    assert not graded["sensor_001"].is_constant
    counts = {r.recommended_action: r.feature_count for r in quality.action_counts(quality.feature_quality(df)).collect()}
    assert counts == {"drop_candidate": 1, "review": 0, "keep": 1}


DECISIONS = [("sensor_000", "keep"), ("sensor_001", "review"), ("sensor_002", "drop_candidate")]


def decisions(spark):
    return spark.createDataFrame(DECISIONS, "feature string, recommended_action string")


def test_selection_keeps_table_order(spark):
    assert quality.selected_features(samples(spark), decisions(spark)) == ["sensor_000", "sensor_001"]
    row = quality.quality_counts(decisions(spark), ["sensor_000"]).first()
    assert tuple(row) == (3, 1, 1, 0)


def master_input(spark):
    rows = [
        (i, f"t{i}", None if i == 4 else float(i), None if i == 1 else 10.0 * i, 1.0, -1 if i < 3 else 1)
        for i in range(6)
    ]
    return spark.createDataFrame(
        rows,
        "sample_id long, timestamp string, sensor_000 double, sensor_001 double, sensor_002 double, label int",
    )


def test_master_table(spark):
    built = master.build_master(master_input(spark), decisions(spark), test_size=0.34)
    table = built.table
    assert table.columns[:9] == WIDE_LINEAGE_COLUMNS
    assert table.columns[9:] == ["sensor_000", "sensor_001"]
    rows = table.collect()
    assert len(rows) == 6 and {r.split for r in rows} == {"train", "test"}
    assert all(v is not None for r in rows for v in r)
    assert {r.label_binary for r in rows} == {0, 1}
    train = [r.sensor_000 for r in rows if r.split == "train" and r.sample_id != 4]
    assert built.medians["sensor_000"] == pytest.approx(sorted(train)[len(train) // 2]) or len(train) % 2 == 0
    document = master.master_metadata(built, decisions(spark)).first()
    assert document.row_count == 6 and document.selected_feature_count == 2
    assert document.split.train_row_count + document.split.test_row_count == 6
    assert set(document.train_median_imputation_values) == {"sensor_000", "sensor_001"}
    assert sum(document.split.train_label_distribution.values()) == document.split.train_row_count


def test_feature_set_metadata(spark):
    built = master.build_feature_set(master_input(spark), decisions(spark), test_size=0.34)
    document = master.feature_set_metadata(built, decisions(spark))
    row = summary.summary_features(document).first()
    assert (row.original_feature_count, row.final_feature_count) == (3, 2)
    assert row.train_row_count + row.test_row_count == 6
    assert row.imputation_strategy == "median"


def test_unexpected_labels_are_rejected(spark):
    df = spark.createDataFrame([(1, 3)], "sample_id long, label int")
    with pytest.raises(ValueError, match="Unexpected"):
        contracts.assert_labels(df, "label")


def test_train_medians_ignore_test_rows(spark):
    df = spark.createDataFrame(
        [("train", 1.0, 10.0), ("train", 3.0, 20.0), ("train", None, 30.0), ("test", None, None), ("test", 100.0, 40.0)],
        "split string, sensor_000 double, sensor_001 double",
    )
    medians = impute.fit_medians(df, ["sensor_000", "sensor_001"])
    assert medians == {"sensor_000": 2.0, "sensor_001": 20.0}
    filled = impute.fill(df, medians).where("split = 'test'").collect()
    assert {(r.sensor_000, r.sensor_001) for r in filled} == {(2.0, 20.0), (100.0, 40.0)}


def test_feature_without_train_values(spark):
    df = spark.createDataFrame(
        [("train", None, 1.0), ("test", 5.0, 2.0)], "split string, sensor_000 double, sensor_001 double"
    )
    with pytest.raises(ValueError, match="sensor_000"):
        impute.fit_medians(df, ["sensor_000", "sensor_001"])
    assert impute.fit_medians(df, ["sensor_000", "sensor_001"], on_empty="drop") == {"sensor_001": 1.0}
    with pytest.raises(ValueError, match="sensor_000"):
        impute.assert_imputable(df.where("split = 'train'"), ["sensor_000", "sensor_001"])


def test_split_needs_both_parts(spark):
    df = spark.createDataFrame([(0, "train")], "label_binary int, split string")
    with pytest.raises(ValueError, match="train and test"):
        split.train_test(df)
    with pytest.raises(ValueError, match="label_binary"):
        split.train_test(df.drop("label_binary"))


def test_schema_helpers(spark):
    df = samples(spark)
    assert sensor_columns(df) == ["sensor_000", "sensor_001", "sensor_002"]
    assert missing_columns(df, ["label", "zone"]) == ["zone"]
    assert statistic_columns(["feature_2", "feature_10"], ["mean"]) == ["feature_10_mean", "feature_2_mean"]
    with pytest.raises(ValueError, match="label"):
        reject_metadata_features(["sensor_000", "label"], ["label"])


def test_grades_equal_those_with_distinct_counts(spark):
    wide = adapters.sensor_wide(spark, "/root/testdata/sf0.001")
    odd = wide.withColumns({"sensor_000": F.lit(None).cast("double"), "sensor_001": F.when(F.col("sample_id") == 1, -0.0).otherwise(0.0)})
    for table in (odd, odd.limit(1), odd.limit(0)):
        full = quality.feature_quality(table).drop("unique_non_null_count")
        assert sorted(quality.feature_grades(table).collect()) == sorted(full.collect())
    plan = quality.feature_grades(wide)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "hashpartitioning" not in plan


def test_wide_branch_as_one_call(spark):
    built = wide_master(spark, "/root/testdata/sf0.001")
    few = master.Master(built.table, built.features[:5], built.medians)
    run = run_wide_branch(few, trees=4, depth=3)
    rows = run.test.count()
    assert run.scored.count() == 2 * rows
    metrics = {r.model_name: r for r in run.metrics().collect()}
    assert set(metrics) == {"logistic_regression", "random_forest"}
    grid = run.thresholds().where("abs(threshold - 0.5) < 1e-9").collect()
    for r in grid:
        m = metrics[r.model_name]
        counts = (m.true_positive, m.false_positive, m.true_negative, m.false_negative)
        assert counts == (r.tp, r.fp, r.tn, r.fn) and sum(counts) == rows
    missed = run.missed_defects().where("threshold_type = 'default_0.5'").groupBy("model_name").count().collect()
    assert {r[0]: r[1] for r in missed} == {n: m.false_negative for n, m in metrics.items() if m.false_negative}
    assert run.top_risk().agg(F.max("rank")).first()[0] == rows
    profile_rows = run.error_profile().where("group_name = 'all_test_samples'").collect()
    assert {r.feature for r in profile_rows} == set(few.features) and {r.sample_count for r in profile_rows} == {rows}
    assert run.importance(repeats=1).count() == 4 * 5


def test_wide_branch_refuses_what_it_cannot_judge(spark):
    rows = [(i, i % 2, "train" if i < 8 else "test", float(i)) for i in range(12)]
    table = spark.createDataFrame(rows, "sample_id long, label_binary int, split string, sensor_000 double")
    with pytest.raises(ValueError, match="Metadata columns"):
        run_wide_branch(master.Master(table, ["sensor_000", "timestamp"], {}))
    for part in ("train", "test"):
        one = table.where(f"split <> '{part}' OR label_binary = 0")
        with pytest.raises(ValueError, match="both classes"):
            run_wide_branch(master.Master(one, ["sensor_000"], {}))
    scored = spark.createDataFrame([("m", 1, 0.5)], "model_name string, label_binary int, defect_probability double")
    metrics = evaluate.classification_metrics(scored)
    assert evaluate.metric_table(metrics.select(*reversed(metrics.columns))).columns == metrics.columns
    with pytest.raises(ValueError, match="Metric table is missing required columns: ..recall"):
        evaluate.metric_table(metrics.drop("recall"))
