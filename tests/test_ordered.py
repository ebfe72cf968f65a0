"""Ranks, running sums and medians against brute force on skewed rows."""

import random
from statistics import median

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fabgauge.operators import evaluate, ordered, split
from fabgauge.operators.profile import duplicate_rows
from fabgauge.session import fix, pin


def skewed_scores(spark, n=4000):
    """One model holds most rows, one score a third of them, some scores are missing."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        model = "a" if i % 10 else "b"
        score = 0.25 if i % 3 == 0 else (None if i % 101 == 0 else round(rng.random(), 3))
        rows.append((i * 7919 % 100_003, model, int(rng.random() < 0.2), score))
    return spark.createDataFrame(
        rows, "sample_id long, model_name string, label_binary int, defect_probability double"
    )


@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_plain_window(spark, descending):
    rows = skewed_scores(spark)
    score = F.col("defect_probability")
    order = score.desc_nulls_last() if descending else score.asc_nulls_last()
    plain = Window.partitionBy("model_name").orderBy(order, "sample_id")
    ranked = ordered.with_rank(
        rows, ["model_name"], "defect_probability", "sample_id", descending, "rank"
    )
    both = ranked.withColumn("expected", F.row_number().over(plain))
    assert both.count() == rows.count()
    assert both.where("rank <> expected").count() == 0


TEXT_ID = "concat('M-', CAST(sample_id AS string))"


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize(
    ("key", "tie"),
    [
        ("defect_probability", TEXT_ID),
        ("CAST(defect_probability AS DECIMAL(9, 4))", "CAST(sample_id AS DECIMAL(20, 2))"),
        ("date_add(DATE'2020-01-01', CAST(defect_probability * 9 AS int))", TEXT_ID),
        ("timestamp_seconds(defect_probability * 100)", "date_add(DATE'1900-01-01', CAST(sample_id AS int))"),
        (TEXT_ID, TEXT_ID),
    ],
)
def test_ranks_of_other_types_equal_plain_window(spark, key, tie, descending):
    rows = skewed_scores(spark).selectExpr("model_name", f"{key} AS k", f"{tie} AS t")
    order = F.col("k").desc_nulls_last() if descending else F.col("k").asc_nulls_last()
    plain = Window.partitionBy("model_name").orderBy(order, "t")
    ranked = ordered.with_rank(rows, ["model_name"], "k", "t", descending)
    both = ranked.withColumn("expected", F.row_number().over(plain))
    assert both.agg(F.count_if(F.expr("rank = expected")), F.count("*")).first() == (4000, 4000)


def test_ranks_refuse_types_without_an_order_number(spark):
    rows = spark.range(3).selectExpr("id % 2 = 0 AS flag", "id")
    with pytest.raises(TypeError, match="flag"):
        ordered.with_rank(rows, [], "flag", "id")


def test_repeated_score_is_spread_over_several_cells(spark):
    rows = skewed_scores(spark).where("defect_probability = 0.25")
    cuts = ordered.cut_points(rows, ["defect_probability", "sample_id"])
    assert cuts["defect_probability"].values == (0.25,)
    placed = ordered.with_cell(rows, "sample_id", cuts["sample_id"], "cell")
    sizes = [r["count"] for r in placed.groupBy("cell").count().collect()]
    assert max(sizes) < sum(sizes) / 4


def test_cells_grow_with_the_value(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MIN_CELLS", 3)
    monkeypatch.setattr(ordered, "MAX_CELLS", 3)
    rows = skewed_scores(spark)
    cuts = ordered.cut_points(rows, ["defect_probability"])["defect_probability"]
    assert cuts.pieces == 3
    placed = ordered.with_cell(rows, "defect_probability", cuts, "cell")
    cells = placed.groupBy("cell", "cell_single").agg(
        F.min("defect_probability").alias("low"), F.max("defect_probability").alias("high")
    )
    found = sorted(cells.collect(), key=lambda r: r.cell)
    assert found[0].cell == -1 and found[0].low is None and found[0].cell_single
    for below, above in zip(found[1:], found[2:]):
        assert below.high < above.low
    assert any(r.cell_single and r.low == r.high == 0.25 for r in found)
    assert len(found) > 6


@pytest.mark.parametrize("descending", [True, False])
def test_rank_with_cut_intervals(spark, monkeypatch, descending):
    monkeypatch.setattr(ordered, "MIN_CELLS", 3)
    monkeypatch.setattr(ordered, "MAX_CELLS", 3)
    test_rank_equals_plain_window(spark, descending)
    test_curve_areas_equal_brute_force(spark)


def test_rank_of_constant_and_of_empty_table(spark):
    one = spark.createDataFrame([(i, "m", 0.5) for i in range(9)], "id long, m string, s double")
    ranked = ordered.with_rank(one, ["m"], "s", "id")
    assert [r["rank"] for r in ranked.orderBy("id").collect()] == list(range(1, 10))
    assert ordered.with_rank(one.limit(0), ["m"], "s", "id").count() == 0


def test_median_equals_brute_force(spark):
    rng = random.Random(3)
    values = {
        "even": [rng.gauss(0, 1) for _ in range(1000)],
        "odd": [rng.random() ** 9 * 1e9 for _ in range(2001)],
        "hot": [1.0] * 700 + [rng.random() for _ in range(301)],
        "two": [1.0, 10.0],
        "single": [-3.5],
    }
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("even", None), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "feature string, value double").repartition(6)
    found = {r.feature: (r.n, r.median) for r in ordered.exact_median(df, ["feature"], "value").collect()}
    assert set(found) == set(values)
    for name, vs in values.items():
        assert found[name] == (len(vs), pytest.approx(median(vs), abs=1e-12))


def test_median_recovers_from_a_misplaced_bracket(spark):
    # A sketch this coarse cannot place the brackets, so they have to be widened.
    rng = random.Random(11)
    rows = [(str(i % 5), rng.random()) for i in range(5000)]
    df = spark.createDataFrame(rows, "feature string, value double").repartition(8)
    found = ordered.exact_median(df, ["feature"], "value", margin=0.0001, accuracy=2)
    expected = {k: median(v for f, v in rows if f == k) for k in "01234"}
    assert {r.feature: pytest.approx(r.median, abs=1e-12) for r in found.collect()} == expected


@pytest.mark.parametrize(("low", "high"), [(0.0, 0.2), (0.8, 1.0), (0.45, 0.55)])
def test_bracket_beside_the_median_finds_nothing(spark, low, high):
    rows = [("f", i / 1000) for i in range(1001)]
    df = spark.createDataFrame(rows, "feature string, _v double")
    bracket = spark.createDataFrame(
        [("f", 1001, low, high)], "feature string, n long, _low double, _high double"
    )
    found = ordered._medians_in(df, ["feature"], bracket).where("hit").collect()
    assert [r.median for r in found] == ([0.5] if low < 0.5 < high else [])


def _brute_areas(rows):
    positives = sum(y for y, _ in rows)
    negatives = len(rows) - positives
    precision_sum = won = seen_p = seen_q = 0
    for score in sorted({s for _, s in rows}, reverse=True):
        p = sum(1 for y, s in rows if s == score and y == 1)
        q = sum(1 for y, s in rows if s == score and y == 0)
        seen_p, seen_q = seen_p + p, seen_q + q
        precision_sum += p * seen_p / (seen_p + seen_q)
        won += q * (seen_p - p / 2)
    return precision_sum / positives, won / (positives * negatives)


def test_curve_areas_equal_brute_force(spark):
    rows = skewed_scores(spark, 900).where("defect_probability IS NOT NULL")
    found = {r.model_name: r for r in evaluate.curve_areas(rows).collect()}
    for model in ("a", "b"):
        own = [
            (r.label_binary, r.defect_probability)
            for r in rows.where(F.col("model_name") == model).collect()
        ]
        average_precision, roc_auc = _brute_areas(own)
        assert found[model].average_precision == pytest.approx(average_precision)
        assert found[model].roc_auc == pytest.approx(roc_auc)


def test_areas_are_null_for_one_class(spark):
    rows = skewed_scores(spark, 300).where("label_binary = 0")
    for row in evaluate.classification_metrics(rows).collect():
        assert row.average_precision is None and row.roc_auc is None
        assert row.warnings == evaluate.ONE_CLASS_TEST_WARNING
        assert row.recall == 0.0


def test_split_sizes_and_singletons(spark):
    rows = [(i, 0) for i in range(63)] + [(100 + i, 1) for i in range(5)] + [(900, 2), (901, None)]
    df = spark.createDataFrame(rows, "id long, y int")
    done = split.stratified_split(df, "y", "id", 0.2)
    counts = {
        (r.y, r.split): r["count"] for r in done.groupBy("y", "split").count().collect()
    }
    assert counts == {
        (0, "train"): 50,
        (0, "test"): 13,
        (1, "train"): 4,
        (1, "test"): 1,
        (2, "train"): 1,
        (None, "train"): 1,
    }
    again = split.stratified_split(df.repartition(5), "y", "id", 0.2)
    assert done.exceptAll(again).count() == 0


def test_split_rounds_half_to_even(spark):
    # 1463 * 0.2 = 292.6 and 104 * 0.2 = 20.8 as in the published split; 25 * 0.1 = 2.5 gives 2.
    for n, size, expected in ((1463, 0.2, 293), (104, 0.2, 21), (25, 0.1, 2), (3, 0.9, 2)):
        df = spark.range(n).withColumn("y", F.lit(1))
        assert split.stratified_split(df, "y", "id", size).where("split = 'test'").count() == expected


@pytest.mark.parametrize("size", [0, 1, -0.5])
def test_split_rejects_bad_sizes(spark, size):
    with pytest.raises(ValueError, match="test_size"):
        split.stratified_split(spark.range(4).withColumn("y", F.lit(1)), "y", "id", size)


def test_duplicates_with_a_hot_row(spark):
    rows = [(i, 1.0, None) for i in range(500)] + [(i, float(i), "x") for i in range(500, 600)]
    rows += [(1000 + i, float(i % 7), "y") for i in range(21)]
    df = spark.createDataFrame(rows, "sample_id long, a double, b string").repartition(7)
    assert duplicate_rows(df).first()[0] == 499 + 14
    assert duplicate_rows(df, ignore=()).first()[0] == 0


def test_duplicates_with_many_repeated_rows(spark):
    rows = [(i, i % 40, "x") for i in range(100)]
    df = spark.createDataFrame(rows, "sample_id long, a int, b string")
    assert duplicate_rows(df).first()[0] == 60


def test_pin_keeps_rows_of_any_number(spark):
    df = spark.range(50).withColumns({"x": F.col("id") * 0.5, "y": F.array("id")})
    for rows in (df, df.limit(0)):
        pinned = pin(rows)
        assert pinned.dtypes == rows.dtypes
        assert sorted(pinned.collect()) == sorted(rows.collect())
        assert "FileScan parquet" in pinned._jdf.queryExecution().executedPlan().toString()
    assert fix(df).count() == 50


def test_pinned_table_is_joined_by_its_size(spark):
    pinned, rows = pin(spark.range(10)), spark.range(1000)
    assert "BroadcastHashJoin" in rows.join(pinned, "id")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in rows.join(pinned, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
