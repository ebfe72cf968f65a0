"""Metrics, error analysis and explanations."""

import pytest
from pyspark.sql import functions as F

from fabgauge.functions.rules import f_beta
from fabgauge.operators import evaluate, explain, models, rescoring, split
from fabgauge.plans import summary
from fabgauge.queries import adapters
from fabgauge.queries.wide import wide_master

SCORED = "model_name string, sample_id long, label_binary int, defect_probability double"

# Published counts with the rates published for them:
# tp, fp, tn, fn, accuracy, precision, recall, f1, f2, false negative rate.
PUBLISHED = [
    (8, 71, 222, 13, 0.732484076433121, 0.10126582278481013, 0.38095238095238093, 0.16, 0.24539877300613497, 0.6190476190476191),
    (7, 56, 237, 14, 0.7770700636942676, 0.1111111111111111, 0.3333333333333333, 0.16666666666666666, 0.23809523809523808, 0.6666666666666666),
]


# The same at threshold 0.5 and for the best F2 of the second model, to the digits published:
# tp, fp, tn, fn and some of the rates.
PUBLISHED_DIGITS = [
    ((3, 38, 255, 18), {"accuracy": 0.821656, "precision": 0.073171, "recall": 0.142857, "f1": 0.096774}),
    ((0, 0, 293, 21), {"accuracy": 0.933121, "precision": 0.0, "recall": 0.0, "f1": 0.0}),
    ((9, 43, 250, 12), {"f2": 0.330882}),
]


def scored(spark):
    rows = [("m", 1, 0, 0.1), ("m", 2, 1, 0.8), ("m", 3, 0, 0.6), ("m", 4, 1, 0.4)]
    return spark.createDataFrame(rows, SCORED)


def test_f2_from_counts(spark):
    row = spark.range(1).select(
        f_beta(F.lit(2), F.lit(1), F.lit(3)).alias("some"), f_beta(F.lit(0), F.lit(0), F.lit(0)).alias("none")
    ).first()
    assert row.some == pytest.approx(10 / 23) and row.none == 0.0


def test_published_rates(spark):
    df = spark.createDataFrame([r[:4] for r in PUBLISHED], "tp long, fp long, tn long, fn long")
    names = ["accuracy", "precision", "recall", "f1", "f2", "false_negative_rate"]
    rates = evaluate.rates()
    rows = df.select("tp", *[rates[n].alias(n) for n in names]).collect()
    found = {r.tp: tuple(r)[1:] for r in rows}
    for expected in PUBLISHED:
        assert found[expected[0]] == pytest.approx(expected[4:])


@pytest.mark.parametrize(("counts", "expected"), PUBLISHED_DIGITS)
def test_published_digits(spark, counts, expected):
    df = spark.createDataFrame([counts], "tp long, fp long, tn long, fn long")
    row = df.select(*[e.alias(n) for n, e in evaluate.rates().items()]).first()
    assert {n: round(row[n], 6) for n in expected} == expected


def test_counts_at_one_threshold(spark):
    row = evaluate.operating_point(evaluate.threshold_metrics(scored(spark))).first()
    assert (row.tp, row.fp, row.tn, row.fn) == (1, 1, 1, 1)
    assert row.predicted_positive_count == 2 and row.accuracy == 0.5


def test_grid(spark):
    assert len(evaluate.THRESHOLDS) == 19
    assert (evaluate.THRESHOLDS[0], evaluate.THRESHOLDS[-1]) == (0.05, 0.95)
    rows = evaluate.threshold_metrics(scored(spark)).collect()
    assert len(rows) == 19 and all(r.tp + r.fp + r.tn + r.fn == 4 for r in rows)
    with pytest.raises(ValueError, match="threshold"):
        evaluate.threshold_metrics(scored(spark), [1.0])
    unsorted = evaluate.threshold_metrics(scored(spark), [0.7, 0.3]).collect()
    assert {r.threshold: r.tp for r in unsorted} == {0.7: 1, 0.3: 2}


def test_score_on_the_threshold_is_positive(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.15), ("m", 2, 0, 0.5)], SCORED)
    rows = {r.threshold: r for r in evaluate.threshold_metrics(df).collect()}
    assert rows[0.15].tp == 1 and rows[0.2].tp == 0 and rows[0.5].fp == 1


def test_best_f2_prefers_the_lower_threshold(spark):
    rows = [("m", 0.3, 0.4), ("m", 0.1, 0.4), ("m", 0.2, 0.1)]
    df = spark.createDataFrame(rows, "model_name string, threshold double, f2 double")
    assert evaluate.best_f2(df).first().threshold == 0.1


def test_false_negatives(spark):
    rows = [("m", 10, 0, 0.2), ("m", 11, 1, 0.4), ("m", 12, 1, 0.9)]
    found = evaluate.false_negatives(spark.createDataFrame(rows, SCORED), 0.5, "default_0.5").collect()
    assert [r.sample_id for r in found] == [11]
    assert found[0].error_type == "false_negative" and found[0].predicted_label == 0


def test_confusion_metrics_and_ranking(spark):
    row = evaluate.classification_metrics(scored(spark)).first()
    assert (row.true_positive, row.false_positive, row.true_negative, row.false_negative) == (1, 1, 1, 1)
    assert row.precision == row.recall == row.f1 == 0.5 and row.warnings == ""
    assert row.average_precision == pytest.approx((1 + 2 / 3) / 2) and row.roc_auc == 0.75
    ranked = evaluate.top_risk_samples(scored(spark)).orderBy("rank").collect()
    assert [r.sample_id for r in ranked] == [2, 3, 4, 1]
    assert evaluate.top_risk_head(scored(spark), 2).count() == 2
    sample = evaluate.prediction_sample(scored(spark), 3).collect()
    assert [(r.row_index, r.y_true, r.y_pred) for r in sample] == [(1, 0, 0), (2, 1, 1), (3, 0, 1)]


def test_top_risk_head_is_limited_before_the_shuffle(spark):
    plan = evaluate.top_risk_head(scored(spark), 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def importance(spark, kind, values, model="m"):
    rows = [(model, kind, f"sensor_{i:03d}", v) for i, v in enumerate(values)]
    schema = "model_name string, importance_type string, feature string, importance double"
    return explain.rank_importance(spark.createDataFrame(rows, schema))


def test_importance_ranks_and_shared_features(spark):
    first = importance(spark, "coefficient_abs", [0.2, 1.5, 0.7])
    second = importance(spark, "impurity_importance", [0.1, 0.8, 0.1])
    both = first.unionByName(second)
    tops = explain.top_features(both, 1).collect()
    assert [r.feature for r in tops] == ["sensor_001", "sensor_001"]
    assert {r.feature: r["rank"] for r in second.collect()} == {"sensor_001": 1, "sensor_000": 2, "sensor_002": 3}
    shared = explain.consistent_features(both, 1).collect()
    assert [(r.feature, r.top_list_count) for r in shared] == [("sensor_001", 2)]


def test_error_profile_groups(spark):
    test = spark.createDataFrame(
        [(1, 1.0, 5.0), (2, 2.0, None), (3, 4.0, 7.0)], "sample_id long, sensor_000 double, sensor_001 double"
    )
    ranked = spark.createDataFrame([(2, 1), (1, 31)], "sample_id long, rank int")
    missed = spark.createDataFrame([(3,), (3,)], "sample_id long")
    rows = explain.error_feature_profile(test, ranked, missed, ["sensor_000", "sensor_001"]).collect()
    found = {(r.group_name, r.feature): r for r in rows}
    assert len(found) == 6
    assert found["top_risk_samples", "sensor_000"].mean == 2.0
    assert found["top_risk_samples", "sensor_001"].median is None
    assert found["false_negative_samples", "sensor_000"].sample_count == 1
    everything = found["all_test_samples", "sensor_000"]
    assert (everything.median, everything.sample_count, everything.missing_count) == (2.0, 3, 0)
    assert found["all_test_samples", "sensor_001"].missing_count == 1


def test_permuted_pairs_are_a_permutation(spark):
    test = spark.range(1, 301).selectExpr("id * 13 AS sample_id")
    pairs = explain.permuted_pairs(test, repeats=2).collect()
    assert len(pairs) == 300 * 2
    for repeat in (1, 2):
        mine = [(r.sample_id, r._donor) for r in pairs if r.repeat == repeat]
        assert {a for a, _ in mine} == {b for _, b in mine} == {13 * k for k in range(1, 301)}
        assert sum(a != b for a, b in mine) > 250
    assert explain.permuted_pairs(test.limit(0)).collect() == []


def plain_permutation(test, features, score, repeats):
    """Score every row again with one feature of its donor in place, all features at hand."""
    pairs = explain.permuted_pairs(test, repeats)
    rows = [f.alias(n) for f, n in ((F.col(f"t.{f}"), f) for f in features)]
    news = [F.col(f"d.{f}").alias(f"new_{f}") for f in features]
    both = pairs.join(test.alias("t"), "sample_id").join(test.alias("d"), F.col("_donor") == F.col("d.sample_id"))
    wide = both.select("repeat", F.col("t.label_binary").alias("label_binary"), *rows, *news)
    parts = [
        score(wide.withColumn(f, F.col(f"new_{f}"))).select(F.lit(f).alias("feature"), "repeat", "label_binary", "defect_probability")
        for f in features
    ]
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return scores


@pytest.mark.parametrize("name", ["logistic", "forest", "linear"])
def test_rescored_rows_equal_scores_of_changed_rows(spark, name):
    built = wide_master(spark, "/root/testdata/sf0.001")
    features = built.features[:7]
    train, test = split.train_test(built.table)
    test = test.select("sample_id", "label_binary", *features)
    if name == "linear":
        weights = {f: k - 2.5 for k, f in enumerate(features)}
        scorer, score = rescoring.LinearRescorer(features, list(weights.values())), explain.linear_scorer(weights)
    elif name == "logistic":
        model = models.train_logistic(train, features)
        scorer, score = rescoring.LinearRescorer.of(model, features), lambda rows: models.positive_score(model, rows)
    else:
        model = models.train_forest(train, features, trees=40, depth=6)
        scorer, score = rescoring.ForestRescorer.of(model), lambda rows: models.positive_score(model, rows)
    keep = ["sample_id", "label_binary"]
    inputs = scorer.inputs(test, keep)
    plain = {r.sample_id: r.defect_probability for r in scorer.scores(inputs, keep).collect()}
    for row in score(test).collect():
        assert plain[row.sample_id] == pytest.approx(row.defect_probability, rel=1e-12, abs=1e-12)
    others = inputs.select(F.col("sample_id").alias("_donor"), F.col("_values").alias("_other"))
    paired = explain.permuted_pairs(inputs, 3).join(inputs, "sample_id").join(others, "_donor")
    changed = scorer.changed(paired, ["repeat", "label_binary"])
    found = sorted((features[r["_at"]], r.repeat, r.label_binary, r.defect_probability) for r in changed.collect())
    expected = sorted(tuple(r) for r in plain_permutation(test, features, score, 3).collect())
    assert len(found) == len(expected) == 3 * 7 * test.count()
    for one, other in zip(found, expected, strict=True):
        assert one[:3] == other[:3] and one[3] == pytest.approx(other[3], rel=1e-9, abs=1e-12)
    # No wide row is left: repeat, label, number of the feature and score.
    assert changed.columns == ["repeat", "label_binary", "_at", "defect_probability"]
    areas = evaluate.curve_areas(plain_permutation(test, features, score, 3), ["feature", "repeat"])
    base = evaluate.curve_areas(score(test).withColumn("g", F.lit(1)), ["g"]).first().average_precision
    drops = {r.feature: base - r.a for r in areas.groupBy("feature").agg(F.avg("average_precision").alias("a")).collect()}
    for row in explain.permutation_importance(test, features, scorer, name, repeats=3).collect():
        assert row.importance == pytest.approx(drops[row.feature], abs=1e-9)


def test_models_on_the_sensor_master(spark):
    folder = "/root/testdata/sf0.001"
    built = wide_master(spark, folder)
    features = built.features[:6]
    train, test = split.train_test(built.table)
    logistic = models.train_logistic(train, features)
    forest = models.train_forest(train, features, trees=5, depth=4)
    # At the optimum the balanced loss gradient equals the penalty: check it by its value.
    weights = logistic.stages[-1].coefficients.toArray()
    assert len(weights) == 6
    n = train.count()
    z = models.positive_score(logistic, train)
    scaler = models.fit_scaler(train, features)
    counts = {r.label_binary: r["count"] for r in train.groupBy("label_binary").count().collect()}
    for i, name in enumerate(features):
        mean, scale = scaler[name]
        weight = F.when(F.col("label_binary") == 1, n / (2 * counts[1])).otherwise(n / (2 * counts[0]))
        residual = weight * (F.col("defect_probability") - F.col("label_binary"))
        gradient = z.agg(F.sum(residual * (F.col(name) - mean) / scale)).first()[0]
        assert gradient + weights[i] == pytest.approx(0, abs=1e-3)
    table = explain.feature_importance(logistic, forest, test, features, repeats=1)
    assert table.count() == 4 * 6
    assert {r.importance_type for r in table.select("importance_type").distinct().collect()} == {
        "coefficient_abs", "impurity_importance", "permutation_average_precision",
    }


def test_a_model_that_never_saw_a_defect_has_no_score(spark):
    train = spark.createDataFrame([(0, float(k)) for k in range(8)], "label_binary int, sensor_000 double")
    model = models.train_forest(train, ["sensor_000"], trees=2, depth=2)
    if model.stages[-1].numClasses < 2:
        with pytest.raises(ValueError, match="without class 1"):
            models.positive_score(model, train)


def test_summary_document(spark):
    folder = "/root/testdata/sf0.001"
    metrics = evaluate.threshold_metrics(adapters.scored(spark, folder))
    sections = {"thresholds": summary.columns_as_items(metrics.agg(F.count(F.lit(1)).alias("n")), "totals")}
    row = summary.quality_summary(sections, "p", "d").first()
    assert row.thresholds[0].value == 38.0 and row.project_name == "p"


def test_missing_scores_are_predicted_good_everywhere(spark):
    rows = [(1, 1, 0.9), (2, 1, None), (3, 0, None), (4, 0, 0.1)]
    scored = spark.createDataFrame(rows, "sample_id long, label_binary int, defect_probability double")
    scored = scored.selectExpr("'m' AS model_name", "*")
    counts = evaluate.confusion_matrix(scored).first()
    assert (counts.tp, counts.fp, counts.tn, counts.fn) == (1, 0, 2, 1)
    grid = evaluate.threshold_metrics(scored)
    at_half = grid.where("abs(threshold - 0.5) < 1e-9").first()
    assert (at_half.tp, at_half.fp, at_half.tn, at_half.fn) == (1, 0, 2, 1)
    missed = evaluate.false_negatives(scored, 0.5, "default")
    assert [r.sample_id for r in missed.collect()] == [2]
