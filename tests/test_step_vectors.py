"""Step means as sparse vectors against step means as columns."""

import pytest
from pyspark.sql import functions as F

from fabgauge.functions.columns import material_features
from fabgauge.operators import impute, materials, models, step_vectors
from fabgauge.session import fix

EVENTS = "MaterialID string, StepID int, duration_ms double, feature_1 double, feature_2 double, target int, is_test int"


def made(spark, steps=6, materials_count=60):
    """Events with missing values, materials that lack steps, and a step that only test materials have."""
    rows = []
    for m in range(materials_count):
        for step in range(steps):
            if (m * 7 + step * 3) % 5 == 0:
                continue
            one = None if (m + step) % 6 == 0 else float((m * 31 + step * 17) % 23) + 3.0 * (m % 3 == 0)
            rows.append((f"m{m}", step, 1.0 + m, one, float((m * step) % 11), int(m % 3 == 0), int(m % 4 == 0)))
            rows.append((f"m{m}", step, 2.0, 4.0, None, int(m % 3 == 0), int(m % 4 == 0)))
    rows += [("m0", 99, 1.0, 1.0, 1.0, 1, 1), ("m1", None, 1.0, 1.0, 1.0, 0, 0), (None, 1, 1.0, 900.0, 1.0, 0, 0)]
    rows += [("bare", None, 1.0, None, None, 0, 0)]
    return spark.createDataFrame(rows, EVENTS)


def by_hand(rows, columns):
    """Filled and scaled columns less what a missing value becomes."""
    train = [r for r in rows if r["official_split"] == "train"]
    result = {}
    for c in columns:
        seen = sorted(r[c] for r in train if r[c] is not None)
        if not seen:
            continue
        n = len(seen)
        median = (seen[(n - 1) // 2] + seen[n // 2]) / 2
        filled = [median if r[c] is None else r[c] for r in train]
        mean = sum(filled) / len(filled)
        scale = (sum((v - mean) ** 2 for v in filled) / len(filled)) ** 0.5 or 1.0
        result[c] = {r["material_id"]: 0.0 if r[c] is None else (r[c] - median) / scale for r in rows}
    return result


def test_vectors_equal_filled_and_scaled_columns(spark):
    df = made(spark)
    features = ["feature_1", "feature_2"]
    steps = materials.observed_steps(df)
    wide = materials.step_means(df, features, steps).join(
        materials.material_base(df).select("material_id", "official_split"), "material_id"
    )
    columns = [c for c in wide.columns if "_step_" in c]
    expected = by_hand([r.asDict() for r in wide.collect()], columns)
    master = step_vectors.sparse_material_master(df, "d1", "manifest")
    positions = {r.position: materials.step_column(r.feature, r.StepID) for r in master.positions.collect()}
    assert sorted(positions) == list(range(len(positions)))
    assert [positions[i] for i in sorted(positions)] == [c for c in columns if c in expected]
    assert "feature_1_step_99_mean" not in expected
    vectors = {r.material_id: r.step_means for r in master.table.collect()}
    assert set(vectors) == {f"m{m}" for m in range(60)} | {"bare"}
    assert vectors["bare"].size == len(positions) and vectors["bare"].numNonzeros() == 0
    for i, name in positions.items():
        for material, value in expected[name].items():
            assert vectors[material][i] == pytest.approx(value, abs=1e-9)


def test_statistics_are_those_of_the_wide_master(spark):
    df = made(spark)
    wide = materials.material_master(df, "d1", "manifest")
    sparse = step_vectors.sparse_material_master(df, "d1", "manifest").table
    shared = [c for c in sparse.columns if c != step_vectors.STEP_VECTOR]
    assert shared == [c for c in wide.columns if "_step_" not in c]
    assert sorted(map(str, sparse.select(shared).collect())) == sorted(map(str, wide.select(shared).collect()))


def test_models_read_vectors(spark):
    df = made(spark)
    # A feature without any train value is left out of the wide fit, as its pair is of the positions.
    wide = materials.material_master(df, "d1", "manifest")
    wide = fix(wide.drop("feature_1_step_99_mean", "feature_2_step_99_mean"))
    sparse = fix(step_vectors.sparse_material_master(df, "d1", "manifest").table)
    features = material_features(wide)
    train = F.col("official_split") == "train"
    medians = impute.fit_medians(wide, features, split="official_split")
    wide_model = models.train_logistic(wide.where(train), features, medians=medians)
    dense = [f for f in features if "_step_" not in f]
    assert material_features(sparse) == dense
    vector_model = models.train_logistic(
        sparse.where(train), dense, medians={f: medians[f] for f in dense}, vectors=[step_vectors.STEP_VECTOR]
    )
    scores = [
        {r.material_id: r[models.SCORE] for r in models.positive_score(m, t).collect()}
        for m, t in ((wide_model, wide), (vector_model, sparse))
    ]
    assert scores[0].keys() == scores[1].keys()
    assert all(scores[0][k] == pytest.approx(scores[1][k], abs=1e-4) for k in scores[0])
    trained = models.train_and_evaluate(sparse, trees=5, depth=3, vectors=[step_vectors.STEP_VECTOR])
    assert trained.metrics.count() == 2 and set(trained.models) == {models.LOGISTIC, models.FOREST}


def test_plan_does_not_grow_with_the_steps(spark):
    sizes = []
    for steps in (5, 900):
        df = spark.range(steps * 4).selectExpr(
            "CAST(id % 4 AS STRING) AS MaterialID", "CAST(id DIV 4 AS INT) AS StepID", "1.0D AS duration_ms",
            "CAST(id AS DOUBLE) AS feature_1", "CAST(id % 2 AS INT) AS target",
            "CAST(id % 4 DIV 2 AS INT) AS is_test",
        )
        master = step_vectors.sparse_material_master(df, "d", "m")
        sizes.append((len(master.table.columns), len(master.table._jdf.queryExecution().logical().toString().splitlines())))
        assert {r.step_means.size for r in master.table.select("step_means").collect()} == {steps}
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("features", [["feature_1"], []])
def test_empty_tables_and_no_features(spark, features):
    df = made(spark).select("MaterialID", "StepID", "duration_ms", *features, "target", "is_test")
    for rows in (df.where("false"), df):
        entries, positions = step_vectors.fitted_steps(rows, features)
        expected = 0 if rows is not df or not features else 6
        assert positions.count() == expected
        assert (step_vectors.step_cells(entries, positions).count() > 0) == (expected > 0)
