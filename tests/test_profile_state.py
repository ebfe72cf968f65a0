"""Profiles merged from the states of single files."""

import pytest
from pyspark.sql import functions as F

from fabgauge.operators import events
from fabgauge.operators import profile_state as ps
from tests.test_events import EVENTS


def made(spark):
    rows = [
        ("A", 1, 10.0, 1.0, None, 0, 0), ("A", 1, 10.0, 1.0, None, 0, 0), ("A", 2, None, None, 1.0, 1, 0),
        ("B", 1, 5.0, 1.0, None, 1, 1), ("B", 2, 5.0, None, 1.0, None, 1), (None, None, 7.5, 2.0, 2.0, 0, None),
        (None, 4, 7.5, 2.0, 2.0, 0, None), ("C", 4, -1.0, 0.0, 0.0, 0, 0), ("C", 4, -1.0, -0.0, 0.0, 0, 0),
    ]
    return spark.createDataFrame(rows, EVENTS).withColumn("file", F.expr("CASE WHEN StepID = 1 THEN '01' ELSE '2' END"))


def tables(state):
    return [
        sorted(map(str, t.collect())) for t in (ps.profile_summary(state), ps.profile_columns(state), ps.profile_values(state))
    ]


def test_merge_equals_the_whole_and_the_plain_profile(spark):
    df = made(spark)
    rows = df.drop("file")
    whole = ps.profile_state(rows, "all")
    halves = [ps.profile_state(rows.where(df.file == f), f) for f in ("01", "2")]
    assert tables(ps.merge_states(*halves)) == tables(whole)
    by_expression = ps.profile_state(rows, F.coalesce(F.col("StepID"), F.lit(0)))
    assert tables(by_expression) == tables(whole)
    found, plain = ps.profile_summary(whole).first(), events.event_profile(rows, "d", "f").first()
    for name in ("row_count", "unique_material_id_count", "mixed_target_material_id_count",
                 "mixed_is_test_material_id_count", "duplicate_full_row_count"):
        assert found[name] == plain[name], name
    for name, value in plain.material_id_row_count_distribution.asDict().items():
        assert found[f"rows_per_material_{name}"] == value
    for name, value in plain.duration_ms.asDict().items():
        assert found[f"duration_{name}"] == value
    assert {r.column_name: r.missing_count for r in ps.profile_columns(whole).collect()} == plain.missing_value_counts
    steps = ps.profile_values(whole).where("column_name = 'StepID'")
    assert {r.value: r["count"] for r in steps.collect()} == plain.step_id_distribution


def test_a_file_that_comes_again_replaces_its_counts(spark, tmp_path):
    df = made(spark)
    rows, folder = df.drop("file"), str(tmp_path / "state")
    first, second = rows.where(df.file == "01"), rows.where(df.file == "2")
    ps.write_state(ps.profile_state(first.limit(1), "01"), folder)
    ps.write_state(ps.profile_state(second, "2"), folder)
    ps.write_state(ps.profile_state(first, "01"), folder)
    stored = ps.read_state(spark, folder)
    assert {r[0] for r in stored.columns.select(ps.SOURCE).distinct().collect()} == {"01", "2"}
    assert tables(stored) == tables(ps.profile_state(rows, "all"))


def test_equal_rows_are_dealt_out_before_they_are_grouped_again(spark):
    rows = made(spark).drop("file")
    state = ps.profile_state(rows.unionByName(rows), "all")
    found = ps.profile_summary(state)
    plan = found._jdf.queryExecution().toString()
    assert "RepartitionByExpression [hash_1" in plan
    assert found.first().duplicate_full_row_count >= rows.count()


def test_nulls_are_told_apart_by_place(spark):
    rows = spark.createDataFrame(
        [("A", 1, 1.0, None, 2.0, 0, 0), ("A", 1, 1.0, 2.0, None, 0, 0)], EVENTS
    )
    assert ps.profile_summary(ps.profile_state(rows, "x")).first().duplicate_full_row_count == 0
    turned = rows.select(*reversed(rows.columns))
    both = ps.merge_states(ps.profile_state(rows, "x"), ps.profile_state(turned, "y"))
    assert ps.profile_summary(both).first().duplicate_full_row_count == 2


def test_empty_tables_and_unequal_columns(spark):
    rows = made(spark).drop("file")
    empty = ps.profile_state(rows.where("false"), "none")
    row = ps.profile_summary(empty).first()
    assert (row.row_count, row.unique_material_id_count, row.duplicate_full_row_count) == (0, 0, 0)
    assert row.duration_min is None and row.rows_per_material_mean == 0.0
    assert ps.profile_columns(empty).count() == ps.profile_values(empty).count() == 0
    fewer = ps.merge_states(ps.profile_state(rows, "a"), ps.profile_state(rows.drop("feature_2"), "b"))
    with pytest.raises(ValueError, match="feature_2"):
        ps.profile_columns(fewer)
    with pytest.raises(ValueError, match="profile_source"):
        ps.profile_state(rows.withColumn("profile_source", F.lit(1)), "a")
