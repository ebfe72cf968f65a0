"""Event tables and material masters on small hand-made events."""

import json

import pytest

from fabgauge.functions.columns import MATERIAL_METADATA_COLUMNS, event_features, material_features
from fabgauge.operators import contracts, events, materials, models
from fabgauge.plans import summary

EVENTS = "MaterialID string, StepID int, duration_ms double, feature_1 double, feature_2 double, target int, is_test int"


def raw(spark):
    rows = [
        ("A", 1, 10.0, 1.0, 2.0, 0, 0),
        ("A", 2, 12.0, 3.0, 4.0, 0, 0),
        ("B", 1, 20.0, 5.0, 6.0, 1, 1),
        ("B", 2, None, None, 8.0, 1, 1),
    ]
    return spark.createDataFrame(rows, EVENTS)


def inconsistent(spark):
    rows = [("A", 1, 1.0, 1.0, 0, 0), ("A", 2, 2.0, 2.0, 1, 1), ("B", 1, 3.0, 3.0, 1, 1)]
    return spark.createDataFrame(
        rows, "MaterialID string, StepID int, duration_ms double, feature_1 double, target int, is_test int"
    )


def test_master_values(spark):
    df = raw(spark)
    master = materials.material_master(df, "d1", "manifest")
    assert master.columns[: len(MATERIAL_METADATA_COLUMNS)] == MATERIAL_METADATA_COLUMNS
    rows = {r.material_id: r.asDict() for r in master.collect()}
    assert [rows[m]["official_split"] for m in "AB"] == ["train", "test"]
    assert rows["A"]["duration_ms_mean"] == 11.0 and rows["B"]["duration_ms_missing_ratio"] == 0.5
    assert rows["A"]["duration_ms_std"] == pytest.approx(2**0.5) and rows["B"]["duration_ms_std"] is None
    assert rows["A"]["feature_1_step_1_mean"] == 1.0 and rows["B"]["feature_1_step_2_mean"] is None
    assert rows["B"]["feature_2_max"] == 8.0 and rows["B"]["step_count"] == 2
    assert event_features(df) == ["feature_1", "feature_2"]


@pytest.mark.parametrize(("features", "steps", "columns"), [(15, 7, 185), (20, 2, 145)])
def test_column_count_identity(spark, features, steps, columns):
    names = [f"feature_{i}" for i in range(features)]
    df = spark.range(40).selectExpr(
        "id % 5 AS MaterialID", f"CAST(id % {steps} AS INT) AS StepID", "1.0D AS duration_ms",
        *[f"CAST(id * {i} AS DOUBLE) AS {n}" for i, n in enumerate(names)],
        "0 AS target", "CAST(id % 5 % 2 AS INT) AS is_test",
    )
    master = materials.material_master(df, "d", "m")
    assert len(master.columns) == len(MATERIAL_METADATA_COLUMNS) + columns
    assert len(material_features(master)) == columns
    assert master.count() == 5


def test_more_groupings_give_the_same_master(spark, monkeypatch):
    df = raw(spark)
    few = materials.material_master(df, "d1", "m")
    monkeypatch.setattr(materials, "AGGREGATES_PER_GROUPING", 8)
    many = materials.material_master(df, "d1", "m")
    assert many.columns == few.columns
    assert many.exceptAll(few).count() == 0 and few.exceptAll(many).count() == 0
    one = df.drop("feature_2")
    turned = materials.step_means(one, ["feature_1"], [1, 2])
    assert turned.columns == ["material_id", "feature_1_step_1_mean", "feature_1_step_2_mean"]


def groupings(df):
    """Aggregations of the plan, each of which may hold a group per material in a task."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("HashAggregate(")


def test_step_means_group_by_step_once(spark):
    df, steps = raw(spark), [1, 2, 3]
    few = materials.step_means(df, event_features(df), steps)
    # Each grouping has a part before its shuffle and one after it.
    assert groupings(few) == 4
    many = materials.step_means(df, event_features(df), [*steps, *range(100, 160)]).select(few.columns)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))


def test_master_without_features(spark):
    master = materials.material_master(raw(spark).drop("feature_1", "feature_2"), "d", "m")
    assert len(master.columns) == len(MATERIAL_METADATA_COLUMNS) + 5 and master.count() == 2


def test_rows_without_material_are_left_out_of_the_master(spark):
    extra = spark.createDataFrame([(None, 1, 1.0, 1.0, 1.0, 0, 0)], EVENTS)
    df = raw(spark).unionByName(extra)
    assert materials.material_master(df, "d", "m").count() == 2
    assert events.material_count(df).first().unique_material_id_count == 3


def test_thousands_of_steps_stay_rows(spark):
    df = spark.range(9000).selectExpr(
        "id % 2 AS MaterialID", "CAST(id % 3000 AS INT) AS StepID", "1.0D AS duration_ms",
        "0 AS target", "0 AS is_test",
    )
    base = materials.material_base(df).collect()
    assert [(r.step_count, r.source_record_count) for r in base] == [(1500, 4500)] * 2
    manifest = materials.sequence_manifest(df, "d", "f").collect()
    lists = {r.material_id: r.observed_step_ids for r in manifest}
    assert lists == {0: list(range(0, 3000, 2)), 1: list(range(1, 3000, 2))}


def test_manifest(spark):
    rows = {r.material_id: r for r in materials.sequence_manifest(raw(spark), "d1", "D1.csv").collect()}
    assert rows["A"].observed_step_ids == [1, 2]
    assert json.loads(rows["A"].observed_step_ids_json) == [1, 2]
    assert rows["B"].duration_ms_max == 20.0 and rows["B"].sequence_available
    assert rows["A"].raw_event_file_path == "D1.csv"


def test_contracts(spark):
    contracts.assert_binary(raw(spark), "target")
    bad = raw(spark).selectExpr("*", "IF(StepID = 1, 2, NULL) AS flag")
    with pytest.raises(ValueError, match="binary"):
        contracts.assert_binary(bad, "flag")
    contracts.assert_constant_in_group(raw(spark), "MaterialID", "target")
    with pytest.raises(ValueError, match="varies within MaterialID"):
        contracts.assert_constant_in_group(inconsistent(spark), "MaterialID", "target")
    half = raw(spark).selectExpr("MaterialID", "IF(StepID = 1, 1, NULL) AS flag")
    assert contracts.mixed_groups(half, "MaterialID", "flag").count() == 2


def test_event_profile(spark):
    row = events.event_profile(inconsistent(spark), "d1", "D1.csv").first()
    assert len(row) == 19
    assert row.mixed_target_material_id_count == 1 and not row.target_consistent_by_material_id
    assert row.target_distribution == {"0": 1, "1": 2}
    assert row.step_id_distribution == {"1": 2, "2": 1}
    assert row.feature_columns == ["feature_1"] and row.unique_material_id_count == 2
    sizes = row.material_id_row_count_distribution
    assert (sizes.min, sizes.max, sizes.mean, sizes.median) == (1.0, 2.0, 1.5, 1.5)
    assert (sizes.p25, sizes.p75) == (1.25, 1.75)
    assert row.duration_ms.asDict() == {"min": 1.0, "max": 3.0, "missing_count": 0}
    missing = events.event_profile(raw(spark), "d1", "x").first().missing_value_counts
    assert missing["duration_ms"] == 1 and missing["feature_1"] == 1 and missing["target"] == 0


def test_design_decision(spark):
    profiles = events.event_profile(inconsistent(spark), "d1", "x").unionByName(
        events.event_profile(raw(spark).drop("feature_2"), "d2", "x"), allowMissingColumns=True
    )
    row = events.design_decision(profiles).first()
    assert not row.target_safe and row.mixed_target_materials == 1
    assert row.feature_columns == ["feature_1"]


MASTER = (
    "dataset_id string, material_id string, label_original int, label_binary int, official_split string, "
    "source_record_count int, step_count int, feature_set_version string, preprocessing_version string, "
    "aggregation_strategy string, sequence_manifest_path string, observed_step_ids_json string, "
    "feature_a_mean double, feature_b_std double"
)


def fixture_master(spark, dataset="d1", labels=(0, 1, 0, 1, 0, 1)):
    a = [1.0, 3.0, None, 5.0, 1000.0, None]
    b = [2.0, 4.0, 6.0, 8.0, 2000.0, 3000.0]
    rows = [
        (dataset, "ABCDEF"[i], labels[i], labels[i], "train" if i < 4 else "test", 10, 2, "v1", "v1", "r", "m", "[1,2]", a[i], b[i])
        for i in range(6)
    ]
    return spark.createDataFrame(rows, MASTER)


def test_master_contract(spark):
    df = fixture_master(spark)
    assert contracts.material_master_violations(df).count() == 0
    repeated = df.unionByName(df.where("material_id = 'A'").selectExpr("* EXCEPT (official_split)", "'test' AS official_split"))
    rules = {r.rule: r.violation_count for r in contracts.material_master_violations(repeated).collect()}
    assert rules == {"duplicate_material_id": 1, "material_in_both_splits": 1}
    with pytest.raises(ValueError, match="contract"):
        contracts.assert_material_master(repeated)
    only_train = contracts.material_master_violations(df.where("official_split = 'train'"))
    assert [r.rule for r in only_train.collect()] == ["no_test_rows"]
    with pytest.raises(ValueError, match="label_binary"):
        contracts.assert_material_master(df.drop("label_binary"))


def test_train_only_imputer_and_scaler(spark):
    from fabgauge.operators import impute

    df = fixture_master(spark)
    features = material_features(df)
    assert features == ["feature_a_mean", "feature_b_std"]
    medians = impute.fit_medians(df, features, split="official_split")
    assert list(medians.values()) == [3.0, 5.0]
    train = impute.fill(df.where("official_split = 'train'"), medians)
    scaler = impute.fit_scaler(train, features)
    assert [scaler[f][0] for f in features] == [3.0, 5.0]
    assert scaler["feature_b_std"][1] == pytest.approx(5**0.5)


def test_train_and_evaluate(spark):
    trained = models.train_and_evaluate(fixture_master(spark), trees=5, depth=3)
    metrics = {r.model_name: r for r in trained.metrics.collect()}
    assert set(metrics) == {"logistic_regression", "random_forest"}
    for row in metrics.values():
        assert row.true_positive + row.false_positive + row.true_negative + row.false_negative == 2
        assert 0 <= row.average_precision <= 1 and row.dataset_id == "d1"
    rows = trained.predictions.collect()
    assert len(rows) == 4 and all(0 <= r.defect_probability <= 1 for r in rows)
    assert all(r.predicted_label == int(r.defect_probability >= 0.5) for r in rows)


def test_one_class_train_is_skipped(spark):
    trained = models.train_and_evaluate(fixture_master(spark, labels=(0, 0, 0, 0, 0, 1)))
    assert trained.models == {}
    for row in trained.metrics.collect():
        assert row.accuracy is None and row.true_positive is None
        assert row.warnings == models.ONE_CLASS_TRAIN_WARNING
    assert all(r.defect_probability is None and r.warning for r in trained.predictions.collect())
    assert trained.predictions.count() == 4


def test_datasets_stay_apart(spark):
    tables = [
        models.train_and_evaluate(fixture_master(spark, d, (0, 0, 0, 0, 0, 1))).metrics for d in ("d1", "d2")
    ]
    rows = summary.model_comparison(tables).collect()
    assert sorted(r.dataset_id for r in rows) == ["d1", "d1", "d2", "d2"]
    document = summary.baseline_feature_metadata(fixture_master(spark), ["feature_a_mean"]).first()
    assert (document.train_row_count, document.test_row_count, document.train_class_count) == (4, 2, 2)
