"""Readers, writers and the catalog."""

import datetime
import json

import pytest

from fabgauge.operators import contracts, models
from fabgauge.sources import catalog, readers, sinks
from tests.test_events import EVENTS, fixture_master, raw


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_samples_are_lined_up(spark, tmp_path):
    sensors = write(tmp_path / "secom.data", "1.0  2.0 NaN\n\n4.0\t5.5 6.0\n")
    labels = write(tmp_path / "secom_labels.data", '-1 "19/07/2008 11:55:00"\n\n1 "19/07/2008 12:32:00"\n')
    rows = readers.assemble_samples(spark, sensors, labels).orderBy("sample_id").collect()
    assert rows[0].asDict() == {
        "sample_id": 0, "sensor_000": 1.0, "sensor_001": 2.0, "sensor_002": None,
        "label": -1, "timestamp": '"19/07/2008 11:55:00"',
    }
    assert [r.sample_id for r in rows] == [0, 1] and rows[1].sensor_001 == 5.5
    assert readers.read_samples(spark, str(tmp_path)).count() == 2
    parsed = readers.read_label_lines(spark, labels).orderBy("label").first()
    assert parsed.recorded_at == datetime.datetime(2008, 7, 19, 11, 55)


def test_line_numbers_over_many_blocks(spark, tmp_path):
    path = write(tmp_path / "long.txt", "".join(f"{i} {'x' * (i % 50)}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        lines = readers.numbered_lines(spark, path)
        assert lines.selectExpr("CAST(split(value, ' ')[0] AS LONG) AS own", "line_no").where("own <> line_no").count() == 0
        assert lines.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("block", ["4000", "1000000"])
def test_line_numbers_over_files_and_blocks(spark, tmp_path, block):
    """Two files of several blocks and a small one, blank lines between; small blocks share a partition."""
    for name, first, last in (("a", 0, 700), ("b", 700, 1500), ("c", 1500, 1503)):
        write(tmp_path / f"{name}.txt", "".join(f"{i} {'y' * (i % 31)}\n{' ' * (i % 3)}\n" for i in range(first, last)))
    names = {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "10"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        blocks = readers.line_blocks(spark, str(tmp_path))
        if block == "4000":
            by_file = [r["count"] for r in blocks.groupBy("file_path").count().orderBy("file_path").collect()]
            assert by_file[0] >= 2 and by_file[1] >= 2 and by_file[2] == 1
        lines = readers.numbered_lines(spark, str(tmp_path), blocks)
        assert lines.selectExpr("CAST(split(value, ' ')[0] AS LONG) AS own", "line_no").where("own <> line_no").count() == 0
        assert sorted(r.line_no for r in lines.collect()) == list(range(1503))
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Sort" not in plan and "ExistingRDD" not in plan
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
        if block == "4000":
            with pytest.raises(Exception, match="not cut as they were counted"):
                readers.numbered_lines(spark, str(tmp_path), blocks).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_row_counts_must_match(spark, tmp_path):
    sensors = write(tmp_path / "a", "1.0 2.0\n3.0 4.0\n")
    labels = write(tmp_path / "b", "1 19/07/2008 11:55:00\n")
    with pytest.raises(ValueError, match="row counts do not match"):
        readers.assemble_samples(spark, sensors, labels)


def test_bad_label_row(spark, tmp_path):
    with pytest.raises(ValueError, match="Invalid label rows"):
        readers.read_label_lines(spark, write(tmp_path / "b", "1\n"))


def test_missing_tokens_and_bad_numbers(spark, tmp_path):
    df = readers.read_sensor_matrix(spark, write(tmp_path / "a", "? nan 1e3\n"))
    assert tuple(df.first()) == (None, None, 1000.0)
    ragged = readers.read_sensor_matrix(spark, write(tmp_path / "r", "\t1.0\t2.0 \r\n \t\n3.0\n"))
    assert sorted(tuple(r) for r in ragged.collect()) == [(1.0, 2.0), (3.0, None)]
    with pytest.raises(Exception, match="more than 2 values"):
        readers.read_sensor_matrix(spark, write(tmp_path / "d", "1.0 2.0\n1.0 2.0 3.0\n")).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_sensor_matrix(spark, write(tmp_path / "c", "1.0 abc\n")).collect()


def test_event_csv(spark, tmp_path):
    text = "MaterialID,StepID,duration_ms,feature_1,feature_2,target,is_test\nA,1,10.0,NaN,2.0,0,0\nA,2,,3.0,x,0,0\nB,1.0,20.0,5.0,NA,1,1\n"
    df = readers.read_event_csv(spark, write(tmp_path / "raw.csv", text))
    assert df.columns == [c.split()[0] for c in EVENTS.split(", ")]
    rows = {(r.MaterialID, r.StepID): r for r in df.collect()}
    assert rows["A", 1].feature_1 is None and rows["A", 2].duration_ms is None
    assert rows["A", 2].feature_2 is None and rows["B", 1].target == 1
    bad = text.replace("A,2,,3.0,x,0,0", "A,2,,3.0,x,1,0")
    with pytest.raises(ValueError, match="varies within MaterialID"):
        readers.read_event_csv(spark, write(tmp_path / "bad.csv", bad))
    with pytest.raises(ValueError, match="is_test"):
        readers.read_event_csv(spark, write(tmp_path / "short.csv", "MaterialID,StepID,duration_ms,target\nA,1,1,0\n"))


def test_tables_and_documents(spark, tmp_path):
    sinks.write_table(raw(spark), str(tmp_path / "t"))
    assert readers.read_table(spark, str(tmp_path / "t"), required=["StepID"]).count() == 4
    sinks.write_table(raw(spark), str(tmp_path / "t.csv"), "csv")
    back = readers.read_table(spark, str(tmp_path / "t.csv"), EVENTS)
    assert back.exceptAll(raw(spark)).count() == 0 and back.count() == 4
    with pytest.raises(ValueError, match="zone"):
        readers.read_table(spark, str(tmp_path / "t"), required=["zone"])
    document = spark.range(1).selectExpr("named_struct('x', 1.5D, 'names', array('a', 'b')) AS nested", "CAST(NULL AS INT) AS none")
    sinks.write_document(document, str(tmp_path / "doc"))
    row = readers.read_metadata(spark, str(tmp_path / "doc")).first()
    assert row.nested.x == 1.5 and row.nested.names == ["a", "b"] and "none" in row


def test_split_folders_are_pruned(spark, tmp_path):
    df = fixture_master(spark)
    sinks.write_train_test(df, str(tmp_path / "m"), "official_split")
    test = spark.read.parquet(str(tmp_path / "m")).where("official_split = 'test'")
    assert test.count() == 2
    assert "PartitionFilters: [isnotnull(official_split" in test._jdf.queryExecution().executedPlan().toString()


def test_models_survive_saving(spark, tmp_path):
    df = fixture_master(spark)
    train = df.where("official_split = 'train'")
    medians = {"feature_a_mean": 3.0, "feature_b_std": 5.0}
    model = models.train_logistic(train, list(medians), medians=medians)
    sinks.save_model(model, str(tmp_path / "model"))
    loaded = sinks.load_model(str(tmp_path / "model"))
    scores = [sorted(r.defect_probability for r in models.positive_score(m, df).collect()) for m in (model, loaded)]
    assert scores[0] == scores[1]
    record = sinks.skipped_model_record(train, "random_forest")
    sinks.register_model(record, str(tmp_path / "registry"))
    sinks.register_model(record, str(tmp_path / "registry"))
    rows = spark.read.parquet(str(tmp_path / "registry")).collect()
    assert len(rows) == 2 and rows[0].train_label_distribution == {"0": 2, "1": 2}


def test_event_csv_is_stored_and_checked(spark, tmp_path):
    text = "MaterialID,StepID,duration_ms,feature_1,target,is_test\nA,1,10.0,NaN,0,0\nA,2,,3.0,0,0\nB,1.0,20.0,NA,1,1\n"
    path, table = write(tmp_path / "raw.csv", text), str(tmp_path / "table")
    stored = readers.store_event_csv(spark, path, table)
    plain = readers.read_event_csv(spark, path)
    assert stored.schema == plain.schema and stored.columns == plain.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
    for row, message in (
        ("B,2,1.0,1.0,2,1", "target must contain only binary values 0/1: .*2"),
        ("B,2,1.0,1.0,1,", "is_test must contain only binary"),
        ("A,2,1.0,1.0,1,0", "target varies within MaterialID"),
        ("A,2,1.0,1.0,0,1", "is_test varies within MaterialID"),
        ("A,2,1.0,1.0,0.5,0", "not whole"),
    ):
        with pytest.raises(Exception, match=message):
            readers.store_event_csv(spark, write(tmp_path / "bad.csv", text + row + "\n"), table)
    empty = readers.store_event_csv(spark, write(tmp_path / "none.csv", text.splitlines()[0] + "\n"), table)
    assert empty.count() == 0 and empty.columns == plain.columns


def entry(**changes):
    fields = dict.fromkeys(catalog.CATALOG_FIELDS, "text")
    fields.update(dataset_id="a", modality="tabular_sensor", use_in_project="current", split_column=None)
    return {**fields, **changes}


def frame(spark, *entries):
    schema = ", ".join(f"{f} string" for f in catalog.CATALOG_FIELDS)
    return spark.createDataFrame([tuple(e[f] for f in catalog.CATALOG_FIELDS) for e in entries], schema)


def test_catalog_rules(spark, tmp_path):
    good = frame(spark, entry(), entry(dataset_id="b", modality="wafer_map_image", use_in_project="phase_2"))
    assert catalog.catalog_violations(good).count() == 0
    bad = frame(spark, entry(), entry(source_url="  "), entry(dataset_id="c", modality="audio", use_in_project="x"))
    found = sorted((r.dataset_id, r.rule) for r in catalog.catalog_violations(bad).collect())
    assert found == [
        ("a", "duplicate_dataset_id"), ("a", "empty_source_url"),
        ("c", "unsupported_modality"), ("c", "unsupported_use_in_project"),
    ]
    with pytest.raises(ValueError, match="missing required"):
        catalog.catalog_violations(good.drop("notes"))
    path = str(tmp_path / "catalog")
    good.coalesce(1).write.option("ignoreNullFields", False).json(path)
    plan = catalog.catalog_plan(catalog.read_catalog(spark, path, lines=True))
    assert plan.columns == catalog.PLAN_FIELDS and plan.count() == 2
    array = write(tmp_path / "catalog.json", json.dumps([entry(), entry(dataset_id="b")]))
    assert catalog.read_catalog(spark, array).count() == 2


def test_inventory(spark, tmp_path):
    write(tmp_path / "a.data", "123")
    write(tmp_path / "b.data", "12345")
    found = {r.dataset_id: (r.file_count, r.size_bytes) for r in catalog.source_inventory(spark, str(tmp_path)).collect()}
    assert found == {"a": (1, 3), "b": (1, 5)}
    joined = catalog.inventory_of_catalog(
        frame(spark, entry(), entry(dataset_id="z")), catalog.source_inventory(spark, str(tmp_path))
    )
    assert {r.dataset_id: r.size_bytes for r in joined.collect()} == {"a": 3, "z": None}


def test_inventory_by_the_longest_path(spark, tmp_path):
    for name, size in (("raw/a/part-0", 3), ("raw/a/x/part-1", 5), ("raw/a/deep/p", 7), ("raw/ab.csv", 11), ("other/q", 13)):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        write(tmp_path / name, "z" * size)
    files = catalog.source_files(spark, str(tmp_path))
    entries = frame(
        spark, entry(dataset_id="a", local_raw_path="raw/a/"), entry(dataset_id="deep", local_raw_path="./raw/a/deep"),
        entry(dataset_id="twin", local_raw_path=f"file:{tmp_path}/raw/a/deep"), entry(dataset_id="one", local_raw_path="raw/ab.csv"),
        entry(dataset_id="none", local_raw_path="raw/b"), entry(dataset_id="null", local_raw_path=None),
        entry(dataset_id="blank", local_raw_path=" "),
    )
    found = catalog.dataset_inventory(entries, files.union(files), str(tmp_path))
    assert {r.dataset_id: (r.file_count, r.size_bytes) for r in found.collect()} == {
        "a": (2, 8), "deep": (1, 7), "twin": (1, 7), "one": (1, 11),
        "none": (None, None), "null": (None, None), "blank": (None, None),
    }
    assert catalog.dataset_inventory(entries, files.where("false")).where("file_count IS NOT NULL").count() == 0
    assert catalog.dataset_inventory(entries.where("false"), files).count() == 0


def test_width_of_files_with_unequal_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 2 3\n")
    (tmp_path / "b.txt").write_text("4 5\n" * 50)
    found = readers.read_sensor_matrix(spark, str(tmp_path))
    assert found.columns == ["sensor_000", "sensor_001", "sensor_002"]
    assert found.where("sensor_002 IS NULL").count() == 50


def test_flags_that_are_not_whole_are_refused(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("MaterialID,StepID,duration_ms,f,target,is_test\na,1,1,1,0.5,0\nb,1.0,1,1,1.0,0\n")
    with pytest.raises(Exception, match="target holds a number that is not whole"):
        readers.read_event_csv(spark, str(path))
    loose = readers.read_event_csv(spark, str(path), check=False)
    assert {r.MaterialID: r.target for r in loose.collect()} == {"a": None, "b": 1}


def test_a_missing_label_is_a_violation(spark):
    rows = spark.createDataFrame([(1,), (None,), (-1,)], "label int")
    assert [(r.label, r.row_count) for r in contracts.label_violations(rows).collect()] == [(None, 1)]
