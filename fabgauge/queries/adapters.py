"""The test tables in the shapes of the library, as Spark views and as SQL text.

Each text is valid in Spark and in DuckDB, or has one form for each where names differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SENSORS = [f"sensor_{i:03d}" for i in range(64)]
# Sensor expected to survive grading: all but the constant and the mostly missing ones.
SELECTED = [s for i, s in enumerate(SENSORS) if i % 16 not in (3, 7)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sensor_expressions(element: str) -> list[str]:
    texts = []
    for i, name in enumerate(SENSORS):
        share = {3: 85, 5: 40}.get(i % 16, 5)
        base = "1.0E0" if i % 16 == 7 else f"CAST({element.format(i + 1)} AS DOUBLE)"
        texts.append(
            f"CASE WHEN (vec_id*31 + {i * 17}) % 100 < {share} THEN NULL ELSE {base} END AS {name}"
        )
    return texts


_SAMPLE_KEYS = "vec_id AS sample_id, CASE WHEN label >= 8 THEN 1 ELSE -1 END AS label"
SENSOR_WIDE_SQL = (
    f"SELECT {_SAMPLE_KEYS}, {', '.join(_sensor_expressions('embedding[{}]'))} FROM embeddings"
)

EVENT_COLUMNS = [
    "l_orderkey AS MaterialID",
    "l_linenumber AS StepID",
    "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_quantity * 1000 END AS duration_ms",
    "l_extendedprice AS feature_1",
    "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_tax END AS feature_2",
    "l_discount AS feature_3",
    "CASE WHEN l_orderkey % 14 = 0 THEN 1 ELSE 0 END AS target",
    "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS is_test",
]
EVENTS_SQL = f"SELECT {', '.join(EVENT_COLUMNS)} FROM lineitem"
# Up to 1,500 steps, the same events.
MANY_STEP_EVENTS_SQL = EVENTS_SQL.replace(EVENT_COLUMNS[1], "l_partkey % 1500 AS StepID")
ONE_CLASS_EVENTS_SQL = (
    "SELECT * REPLACE (CASE WHEN is_test = 1 THEN target ELSE 0 END AS target) "
    f"FROM ({EVENTS_SQL})"
)
_MIXED_TARGET = "CASE WHEN l_partkey % 14 = 0 THEN 1 ELSE 0 END AS target"
MIXED_EVENTS_SQL = EVENTS_SQL.replace(EVENT_COLUMNS[6], _MIXED_TARGET)
# Some flags outside 0/1 and some missing ones, for the contract checks.
_BAD_TARGET = (
    "CASE WHEN l_partkey % 500 = 1 THEN 2 WHEN l_partkey % 500 = 2 THEN NULL "
    "WHEN l_orderkey % 14 = 0 THEN 1 ELSE 0 END AS target"
)
BAD_EVENTS_SQL = EVENTS_SQL.replace(EVENT_COLUMNS[6], _BAD_TARGET)


def _second_dataset(number: str) -> str:
    step = (
        "CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 "
        "WHEN 'purchase' THEN 4 WHEN 'error' THEN -1 END"
    )
    return f"""SELECT user_id AS MaterialID, {step} AS StepID,
  CASE WHEN event_id % 25 = 0 THEN NULL ELSE value END AS duration_ms,
  value AS feature_1, CAST({number} AS DOUBLE) AS feature_2,
  CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS target,
  CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS is_test FROM events"""


EVENTS_D2_SQL = _second_dataset("json_extract_string(props, '$.k')")
EVENTS_D2_SPARK = _second_dataset("get_json_object(props, '$.k')")

_LABEL = "CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END"
SCORED_SQL = f"""SELECT o_orderkey AS sample_id, {_LABEL} AS label_binary,
  'model_a' AS model_name,
  CAST((o_orderkey*7919 + CASE WHEN o_orderstatus='F' THEN 211 ELSE 0 END) % 1000 AS DOUBLE)/1000
    AS defect_probability FROM orders
UNION ALL
SELECT o_orderkey, {_LABEL}, 'model_b',
  CAST((o_orderkey*104729) % 700 + CASE WHEN o_orderstatus='F' THEN 250 ELSE 0 END AS DOUBLE)/1000
  FROM orders"""
LABELLED_ORDERS_SQL = f"""SELECT o_orderkey AS sample_id, CAST(o_orderdate AS DATE) AS day,
  CASE WHEN o_orderstatus='F' THEN 1 ELSE -1 END AS label, o_totalprice AS amount FROM orders"""

# Customers as catalog entries, some of them breaking a rule.
CATALOG_SQL = """SELECT
  CASE WHEN c_custkey % 97 = 0 THEN 'ds_0' ELSE 'ds_' || CAST(c_custkey AS VARCHAR(20)) END
    AS dataset_id,
  c_name AS display_name,
  CASE WHEN c_custkey % 41 = 0 THEN '  ' WHEN c_custkey % 43 = 0 THEN NULL
    ELSE 'https://example.org/' || CAST(c_custkey AS VARCHAR(20)) END AS source_url,
  'public_repository' AS source_type, 'manufacturing' AS domain,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'tabular_sensor' WHEN 'BUILDING'
    THEN 'wafer_timeseries' WHEN 'FURNITURE' THEN 'wafer_map_image'
    WHEN 'MACHINERY' THEN 'tabular_sensor' ELSE 'audio' END AS modality,
  'classification' AS task_type, 'target' AS label_column,
  CASE WHEN c_nationkey % 2 = 0 THEN 'is_test' END AS split_column,
  'raw/' || CAST(c_custkey AS VARCHAR(20)) AS local_raw_path,
  'processed/' || CAST(c_custkey AS VARCHAR(20)) AS local_processed_path,
  'tabular' AS expected_pipeline_branch, 'verify the licence' AS license_note,
  'planned' AS download_status,
  CASE c_nationkey % 5 WHEN 0 THEN 'current' WHEN 1 THEN 'next' WHEN 2 THEN 'phase_2'
    WHEN 3 THEN 'hold' ELSE 'someday' END AS use_in_project,
  'account ' || CAST(c_nationkey AS VARCHAR(20)) AS notes
FROM customer"""

# Orders as files in folders by customer and year; every tenth entry owns one year of another's folder.
INVENTORY_CATALOG_SQL = f"""SELECT dataset_id, source_url, license_note, CASE WHEN n % 10 = 0
    THEN 'raw/' || CAST(CAST(floor(n / 10) AS INT) AS VARCHAR(20)) || '/1996' ELSE local_raw_path END AS local_raw_path
  FROM (SELECT *, CAST(substr(local_raw_path, 5) AS INT) AS n FROM ({CATALOG_SQL}))"""
FILES_SQL = """SELECT 'file:/lake/raw/' || CAST(o_custkey AS VARCHAR(20)) || '/' ||
    CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR(20)) || '/part-' || CAST(o_orderkey AS VARCHAR(20)) || '.csv' AS path,
  o_orderkey AS length, CAST(o_orderdate AS DATE) AS modificationTime FROM orders"""


def _view(spark: SparkSession, folder: str, source: str, text: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {source}", "FROM {src}"), src=table(spark, folder, source))


def sensor_wide(spark: SparkSession, folder: str) -> DataFrame:
    elements = _sensor_expressions("element_at(embedding, {})")
    return table(spark, folder, "embeddings").selectExpr(*_SAMPLE_KEYS.split(", "), *elements)


def material_events(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "lineitem", EVENTS_SQL)


def many_step_events(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "lineitem", MANY_STEP_EVENTS_SQL)


def one_class_events(spark: SparkSession, folder: str) -> DataFrame:
    events = material_events(spark, folder)
    return events.withColumn("target", F.expr("CASE WHEN is_test = 1 THEN target ELSE 0 END"))


def mixed_events(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "lineitem", MIXED_EVENTS_SQL)


def bad_events(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "lineitem", BAD_EVENTS_SQL)


def material_events_d2(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "events", EVENTS_D2_SPARK)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "orders", SCORED_SQL)


def labelled_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "orders", LABELLED_ORDERS_SQL)


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "customer", CATALOG_SQL)


def inventory_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "customer", INVENTORY_CATALOG_SQL)


def files(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, "orders", FILES_SQL)
