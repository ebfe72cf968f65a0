"""Queries on the wide sensor table."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabgauge.operators import contracts, impute, profile, quality, split
from fabgauge.operators.models import class_weights
from fabgauge.plans import master
from fabgauge.functions.rules import missing_bucket, recommended_action
from fabgauge.queries import adapters as A
from fabgauge.queries.registry import query, rounded, rounded_sql, with_tables

SENSOR_LIST = ", ".join(A.SENSORS)
WIDE = {"w": A.SENSOR_WIDE_SQL}
LONG = {
    **WIDE,
    "long": f"SELECT * FROM w UNPIVOT INCLUDE NULLS (value FOR feature IN ({SENSOR_LIST}))",
}
QUALITY = {
    **LONG,
    "counted": """SELECT feature, count(*) AS n, count(value) AS present,
      count(DISTINCT value) AS kinds FROM long GROUP BY feature""",
    "quality": """SELECT feature, n - present AS missing_count,
      CAST(n - present AS DOUBLE) / n AS missing_ratio, present AS non_null_count,
      kinds AS unique_non_null_count, kinds <= 1 AS is_constant,
      CASE WHEN (n - present) / n >= 0.8 THEN 'high_missing_drop_candidate'
        WHEN (n - present) / n >= 0.3 THEN 'medium_missing_review'
        ELSE 'low_missing_keep' END AS missing_bucket,
      CASE WHEN kinds <= 1 OR (n - present) / n >= 0.8 THEN 'drop_candidate'
        WHEN (n - present) / n >= 0.3 THEN 'review' ELSE 'keep' END AS recommended_action
      FROM counted""",
}
MISSING_REPORT = """SELECT feature, count(*) - count(value) AS missing_count,
  CAST(count(*) - count(value) AS DOUBLE) / count(*) AS missing_ratio
  FROM long GROUP BY feature"""


def split_sql(source: str, label: str) -> str:
    """Stratified split of a table with ``sample_id`` by a plain window."""
    return f"""SELECT * EXCLUDE (rn_, n_), CASE WHEN n_ > 1 AND rn_ <= greatest(1,
      least(CAST(round_even(n_ * CAST(0.2 AS DOUBLE), 0) AS BIGINT), n_ - 1))
      THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, count(*) OVER (PARTITION BY {label}) AS n_, row_number() OVER (
      PARTITION BY {label} ORDER BY md5(CAST(sample_id AS VARCHAR) || '|42'), sample_id) AS rn_
      FROM {source})"""


BINARY = "CASE WHEN label = -1 THEN 0 WHEN label = 1 THEN 1 END"
WIDE_SPLIT = {**WIDE, "parted": split_sql("w", "label")}
ORDERS_SPLIT = {
    "o": f"SELECT sample_id, label AS label_original, {BINARY} AS label_binary, day, amount "
    f"FROM ({A.LABELLED_ORDERS_SQL})",
    "parted": split_sql("o", "label_binary"),
}
MEDIANS = {
    **WIDE_SPLIT,
    "long": f"SELECT sample_id, label, split, feature, value FROM parted "
    f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({SENSOR_LIST}))",
    "medians": "SELECT feature, median(value) AS median FROM long "
    "WHERE split = 'train' GROUP BY feature",
}


def wide_split(spark, folder):
    return split.stratified_split(A.sensor_wide(spark, folder), "label", "sample_id")


def orders_split(spark, folder):
    labelled = master.label_rows(A.labelled_orders(spark, folder))
    return split.stratified_split(labelled, "label_binary", "sample_id")


def graded(spark, folder):
    return quality.feature_quality(A.sensor_wide(spark, folder))


@query("missing_value_report", rounded_sql(with_tables(LONG, MISSING_REPORT), ["missing_ratio"]))
def missing_value_report(spark, folder):
    return rounded(profile.missing_values(A.sensor_wide(spark, folder)))


@query(
    "label_distribution",
    with_tables(WIDE, 'SELECT label, count(*) AS "count" FROM w GROUP BY label ORDER BY label'),
)
def label_distribution(spark, folder):
    return profile.label_distribution(A.sensor_wide(spark, folder))


@query(
    "dataset_profile",
    rounded_sql(
        with_tables(
            LONG,
            f"""SELECT (SELECT count(*) FROM w) AS row_count, CAST(64 AS BIGINT) AS feature_count,
            count(*) - count(value) AS total_missing_values,
            CAST(count(*) - count(value) AS DOUBLE) / count(*) AS overall_missing_value_ratio,
            (SELECT count(*) FROM w) - (SELECT count(*) FROM
              (SELECT DISTINCT label, {SENSOR_LIST} FROM w)) AS duplicate_row_count FROM long""",
        ),
        ["overall_missing_value_ratio"],
    ),
)
def dataset_profile(spark, folder):
    return rounded(profile.dataset_profile(A.sensor_wide(spark, folder)))


_REPEATED = "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_custkey % 7 = 0"


@query(
    "duplicate_rows",
    f"""WITH r AS ({_REPEATED}) SELECT (SELECT count(*) FROM r) - count(*)
    AS duplicate_row_count FROM (SELECT DISTINCT * EXCLUDE (o_orderkey) FROM r)""",
)
def duplicate_rows(spark, folder):
    orders = A.table(spark, folder, "orders")
    rows = orders.unionAll(orders.where("o_custkey % 7 = 0"))
    return profile.duplicate_rows(rows, ignore=["o_orderkey"])


@query(
    "feature_quality_summary",
    rounded_sql(with_tables(QUALITY, "SELECT * FROM quality"), ["missing_ratio"]),
)
def feature_quality_summary(spark, folder):
    return rounded(graded(spark, folder))


def _domain_counts(column: str, domain: list[str]) -> str:
    values = ", ".join(f"('{v}')" for v in domain)
    return with_tables(
        QUALITY,
        f"""SELECT d.{column}, count(q.feature) AS feature_count
        FROM (VALUES {values}) d({column}) LEFT JOIN quality q USING ({column}) GROUP BY 1""",
    )


@query("action_counts", _domain_counts("recommended_action", quality.RECOMMENDED_ACTIONS))
def action_counts(spark, folder):
    return quality.action_counts(graded(spark, folder))


@query("bucket_counts", _domain_counts("missing_bucket", quality.MISSING_BUCKETS))
def bucket_counts(spark, folder):
    return quality.bucket_counts(graded(spark, folder))


_QUALITY_COUNTS = """SELECT count(*) AS original_feature_count,
  count(*) FILTER (recommended_action = 'drop_candidate') AS drop_candidate_feature_count,
  count(*) FILTER (recommended_action = 'keep') AS kept_feature_count,
  count(*) FILTER (recommended_action = 'review') AS review_feature_count_included FROM quality"""


@query("quality_counts", with_tables(QUALITY, _QUALITY_COUNTS))
def quality_counts(spark, folder):
    return quality.quality_counts(graded(spark, folder))


@query(
    "constant_drop_count",
    with_tables(
        QUALITY,
        """SELECT count(*) AS constant_drop_candidates FROM quality
        WHERE is_constant AND recommended_action = 'drop_candidate'""",
    ),
)
def constant_drop_count(spark, folder):
    return quality.constant_drops(graded(spark, folder))


@query(
    "missing_bucket",
    with_tables(QUALITY, "SELECT feature, missing_bucket FROM quality"),
)
def missing_bucket_query(spark, folder):
    report = profile.missing_values(A.sensor_wide(spark, folder))
    return report.select("feature", missing_bucket(F.col("missing_ratio")).alias("missing_bucket"))


@query(
    "recommended_action",
    with_tables(QUALITY, "SELECT feature, recommended_action FROM quality"),
)
def recommended_action_query(spark, folder):
    return graded(spark, folder).select(
        "feature",
        recommended_action(F.col("is_constant"), F.col("missing_ratio")).alias(
            "recommended_action"
        ),
    )


@query(
    "select_features",
    rounded_sql(
        with_tables(
            QUALITY,
            """SELECT sample_id, feature, value FROM long WHERE feature IN (SELECT feature
            FROM quality WHERE recommended_action IN ('keep', 'review'))""",
        ),
        ["value"],
    ),
)
def select_features(spark, folder):
    wide = A.sensor_wide(spark, folder)
    long = profile.melt(wide, A.SENSORS, ["sample_id"])
    kept = quality.selected_values(long, quality.feature_grades(wide))
    return rounded(kept.select("sample_id", "feature", "value"))


@query(
    "melt_features",
    rounded_sql(with_tables(LONG, "SELECT sample_id, feature, value FROM long"), ["value"]),
)
def melt_features(spark, folder):
    return rounded(profile.melt(A.sensor_wide(spark, folder), A.SENSORS, ["sample_id"]))


_TOP_MISSING = "ORDER BY missing_ratio DESC, missing_count DESC, feature LIMIT 20"


@query(
    "top_missing_features",
    rounded_sql(with_tables(LONG, f"{MISSING_REPORT} {_TOP_MISSING}"), ["missing_ratio"]),
)
def top_missing_features(spark, folder):
    return rounded(profile.top_missing(profile.missing_values(A.sensor_wide(spark, folder))))


@query(
    "drop_candidates",
    rounded_sql(
        with_tables(
            QUALITY,
            """SELECT * FROM quality WHERE recommended_action = 'drop_candidate'
            ORDER BY is_constant DESC, missing_ratio DESC, feature LIMIT 20""",
        ),
        ["missing_ratio"],
    ),
)
def drop_candidates(spark, folder):
    return rounded(quality.drop_candidates(graded(spark, folder)))


@query(
    "review_candidates",
    rounded_sql(
        with_tables(
            QUALITY,
            """SELECT * FROM quality WHERE recommended_action = 'review'
            ORDER BY missing_ratio DESC, feature LIMIT 20""",
        ),
        ["missing_ratio"],
    ),
)
def review_candidates(spark, folder):
    return rounded(quality.review_candidates(graded(spark, folder)))


@query(
    "normalize_labels",
    f"SELECT sample_id, label AS label_original, {BINARY} AS label_binary "
    f"FROM ({A.LABELLED_ORDERS_SQL})",
)
def normalize_labels(spark, folder):
    rows = master.label_rows(A.labelled_orders(spark, folder))
    return rows.select("sample_id", "label_original", "label_binary")


@query(
    "check_label_domain",
    "SELECT label, count(*) AS row_count FROM embeddings WHERE label NOT IN (-1, 0, 1) GROUP BY 1",
)
def check_label_domain(spark, folder):
    return contracts.label_violations(A.table(spark, folder, "embeddings"), "label", (-1, 0, 1))


@query(
    "check_imputable",
    with_tables(
        {
            **WIDE_SPLIT,
            "train": "SELECT *, CASE WHEN split = 'test' THEN sensor_000 END AS sensor_empty "
            "FROM parted WHERE split = 'train'",
        },
        f"""SELECT feature FROM (SELECT {", ".join(f"count({s}) AS {s}" for s in A.SENSORS)},
          count(sensor_empty) AS sensor_empty FROM train)
        UNPIVOT (n FOR feature IN ({SENSOR_LIST}, sensor_empty)) WHERE n = 0""",
    ),
)
def check_imputable(spark, folder):
    # One more sensor, which has values in the test rows only.
    rows = wide_split(spark, folder).withColumn(
        "sensor_empty", F.expr("CASE WHEN split = 'test' THEN sensor_000 END")
    )
    train, _ = split.train_test(rows, label="label")
    return contracts.unimputable_features(train, [*A.SENSORS, "sensor_empty"])


@query(
    "check_class_presence",
    with_tables(
        ORDERS_SPLIT,
        """SELECT split, count(DISTINCT label_binary) AS class_count, count(*) AS row_count,
        count(DISTINCT label_binary) >= 2 AS has_both_classes FROM parted GROUP BY split""",
    ),
)
def check_class_presence(spark, folder):
    return contracts.class_presence(orders_split(spark, folder))


@query(
    "stratified_split",
    with_tables(ORDERS_SPLIT, "SELECT sample_id, label_binary, split FROM parted"),
)
def stratified_split(spark, folder):
    return orders_split(spark, folder).select("sample_id", "label_binary", "split")


@query(
    "split_label_counts",
    with_tables(
        ORDERS_SPLIT,
        "SELECT split, label_binary AS label, count(*) AS row_count FROM parted GROUP BY ALL",
    ),
)
def split_label_counts(spark, folder):
    return split.split_label_counts(orders_split(spark, folder))


@query(
    "train_test_filter",
    with_tables(
        ORDERS_SPLIT,
        "SELECT sample_id, label_binary, amount FROM parted WHERE split = 'test'",
    ),
)
def train_test_filter(spark, folder):
    _, test = split.train_test(orders_split(spark, folder))
    return test.select("sample_id", "label_binary", "amount")


_LINEAGE_SQL = ", ".join(f"'{v}' AS {k}" for k, v in master.WIDE_LINEAGE.items())
_LINEAGE_KEYS = "sample_id, CAST(NULL AS VARCHAR) AS timestamp, label_original, label_binary, split"


@query(
    "stamp_lineage",
    with_tables(ORDERS_SPLIT, f"SELECT {_LINEAGE_KEYS}, {_LINEAGE_SQL}, amount FROM parted"),
)
def stamp_lineage(spark, folder):
    rows = orders_split(spark, folder).withColumn("timestamp", F.lit(None).cast("string"))
    return master.stamp_lineage(rows.drop("day"))


_FILLED = A.SENSORS


@query(
    "fill_from_map",
    rounded_sql(
        with_tables(
            WIDE,
            "SELECT sample_id, "
            + ", ".join(f"coalesce({s}, {i}.5E0) AS {s}" for i, s in enumerate(_FILLED))
            + " FROM w",
        ),
        _FILLED,
    ),
)
def fill_from_map(spark, folder):
    rows = A.sensor_wide(spark, folder).select("sample_id", *_FILLED)
    return rounded(impute.fill(rows, {s: i + 0.5 for i, s in enumerate(_FILLED)}))


@query("train_medians", rounded_sql(with_tables(MEDIANS, "SELECT * FROM medians"), ["median"]))
def train_medians(spark, folder):
    return rounded(impute.train_medians(wide_split(spark, folder), A.SENSORS))


@query(
    "impute_join",
    rounded_sql(
        with_tables(
            MEDIANS,
            """SELECT sample_id, split, feature, coalesce(value, median) AS value
            FROM long JOIN medians USING (feature)""",
        ),
        ["value"],
    ),
)
def impute_join(spark, folder):
    rows = wide_split(spark, folder)
    medians = impute.train_medians(rows, A.SENSORS)
    long = profile.melt(rows, A.SENSORS, ["sample_id", "split"])
    return rounded(impute.fill_long(long, medians))


def _imputed_sql(columns: list[str]) -> str:
    return ", ".join(
        f"coalesce({c}, (SELECT median FROM medians WHERE feature = '{c}')) AS {c}"
        for c in columns
    )


@query(
    "median_impute",
    rounded_sql(
        with_tables(MEDIANS, f"SELECT sample_id, split, {_imputed_sql(A.SENSORS)} FROM parted"),
        A.SENSORS,
    ),
)
def median_impute(spark, folder):
    rows = wide_split(spark, folder).select("sample_id", "split", *A.SENSORS)
    return rounded(impute.fill(rows, impute.fit_medians(rows, A.SENSORS)))


def _scaler_sql(column: str) -> str:
    return f"""SELECT '{column}' AS feature, avg({column}) AS mean,
      CASE WHEN stddev_pop({column}) = 0 THEN 1 ELSE stddev_pop({column}) END AS scale
      FROM parted WHERE split = 'train'"""


@query(
    "scaler_params",
    rounded_sql(
        with_tables(WIDE_SPLIT, " UNION ALL ".join(_scaler_sql(s) for s in A.SENSORS)),
        ["mean", "scale"],
    ),
)
def scaler_params(spark, folder):
    train, _ = split.train_test(wide_split(spark, folder), label="label")
    return rounded(impute.scaler_params(train, A.SENSORS))


_SCALED = A.SENSORS


@query(
    "standardize",
    rounded_sql(
        with_tables(
            {**WIDE_SPLIT, "scaler": " UNION ALL ".join(_scaler_sql(s) for s in _SCALED)},
            "SELECT sample_id, "
            + ", ".join(
                f"({s} - (SELECT mean FROM scaler WHERE feature = '{s}')) / "
                f"(SELECT scale FROM scaler WHERE feature = '{s}') AS {s}"
                for s in _SCALED
            )
            + " FROM parted",
        ),
        _SCALED,
    ),
)
def standardize(spark, folder):
    rows = wide_split(spark, folder)
    train, _ = split.train_test(rows, label="label")
    scaler = impute.fit_scaler(train, _SCALED)
    return rounded(impute.standardize(rows.select("sample_id", *_SCALED), scaler))


@query(
    "class_weights",
    rounded_sql(
        with_tables(
            {
                **ORDERS_SPLIT,
                "counts": "SELECT label_binary AS label, count(*) AS row_count FROM parted "
                "WHERE split = 'train' GROUP BY 1",
            },
            """SELECT label, row_count, CAST((SELECT sum(row_count) FROM counts) AS DOUBLE)
            / ((SELECT count(*) FROM counts) * row_count) AS weight FROM counts""",
        ),
        ["weight"],
    ),
)
def class_weights_query(spark, folder):
    train, _ = split.train_test(orders_split(spark, folder))
    return rounded(class_weights(train))


MASTER_TABLES = {
    "w": f"SELECT *, {BINARY} AS label_binary FROM ({A.SENSOR_WIDE_SQL})",
    "parted": split_sql("w", "label_binary"),
    "long": f"SELECT split, feature, value FROM parted "
    f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({SENSOR_LIST}))",
    "medians": MEDIANS["medians"],
}
MASTER_SQL = f"""SELECT sample_id, CAST(NULL AS VARCHAR) AS timestamp, label AS label_original,
  label_binary, split, {_LINEAGE_SQL}, {_imputed_sql(A.SELECTED)} FROM parted"""


def wide_master(spark, folder):
    wide = A.sensor_wide(spark, folder)
    return master.build_master(wide, quality.feature_grades(wide))


@query("modeling_master", rounded_sql(with_tables(MASTER_TABLES, MASTER_SQL), A.SELECTED))
def modeling_master(spark, folder):
    return rounded(wide_master(spark, folder).table)


@query(
    "feature_set",
    rounded_sql(
        with_tables(
            MEDIANS, f"SELECT sample_id, label, split, {_imputed_sql(A.SELECTED)} FROM parted"
        ),
        A.SELECTED,
    ),
)
def feature_set(spark, folder):
    wide = A.sensor_wide(spark, folder)
    return rounded(master.build_feature_set(wide, quality.feature_grades(wide)).table)
