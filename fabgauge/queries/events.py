"""Queries on the event tables and the material masters built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabgauge.functions.columns import event_features, material_features, statistic_columns
from fabgauge.functions.rules import coerce_numeric, missing_as_label, official_split
from fabgauge.operators import contracts, events, materials, models, profile_state, step_vectors
from fabgauge.plans import summary
from fabgauge.queries import adapters as A
from fabgauge.queries.registry import query, rounded, rounded_sql, with_tables

EVENTS = {"e": A.EVENTS_SQL}
MIXED = {"e": A.MIXED_EVENTS_SQL}
COLUMNS = ["MaterialID", "StepID", "duration_ms", "feature_1", "feature_2", "feature_3", "target", "is_test"]
FEATURES = ["feature_1", "feature_2", "feature_3"]
STEPS = range(1, 8)


@query(
    "event_profile_missing",
    with_tables(
        EVENTS,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM e"
            for c in COLUMNS
        ),
    ),
)
def event_profile_missing(spark, folder):
    return events.missing_counts(A.material_events(spark, folder))


def _value_counts_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, coalesce(CAST({column} AS VARCHAR), '<MISSING>')
      AS value, count(*) AS "count" FROM e GROUP BY ALL"""


@query(
    "event_value_counts",
    with_tables(
        {"e": A.BAD_EVENTS_SQL},
        _value_counts_sql("target") + " UNION ALL " + _value_counts_sql("StepID"),
    ),
)
def event_value_counts(spark, folder):
    rows = A.bad_events(spark, folder)
    parts = [
        events.value_counts(rows, c).withColumn("column_name", F.lit(c))
        for c in ("target", "StepID")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "rows_per_material_stats",
    rounded_sql(
        with_tables(
            EVENTS,
            """SELECT CAST(min(n) AS DOUBLE) AS min, CAST(max(n) AS DOUBLE) AS max, avg(n) AS mean,
            median(n) AS median, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.75) AS p75
            FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM e GROUP BY MaterialID)""",
        ),
        ["mean", "median", "p25", "p75"],
    ),
)
def rows_per_material_stats(spark, folder):
    return rounded(events.rows_per_material(A.material_events(spark, folder)))


@query(
    "material_count",
    with_tables(
        EVENTS,
        """SELECT count(*) AS row_count, CAST(8 AS BIGINT) AS column_count,
        count(DISTINCT MaterialID) AS unique_material_id_count FROM e""",
    ),
)
def material_count(spark, folder):
    return events.material_count(A.material_events(spark, folder))


_MIXED_COUNTS = """SELECT count(*) FILTER (t > 1) AS mixed_target_material_id_count,
  count(*) FILTER (s > 1) AS mixed_is_test_material_id_count,
  count(*) FILTER (t > 1) = 0 AS target_consistent_by_material_id,
  count(*) FILTER (s > 1) = 0 AS is_test_consistent_by_material_id
  FROM (SELECT MaterialID, count(DISTINCT coalesce(target, -9)) AS t,
    count(DISTINCT coalesce(is_test, -9)) AS s FROM e GROUP BY MaterialID)"""


@query("mixed_material_counts", with_tables(MIXED, _MIXED_COUNTS))
def mixed_material_counts(spark, folder):
    return events.mixed_material_counts(A.mixed_events(spark, folder))


@query(
    "duration_range",
    rounded_sql(
        with_tables(
            EVENTS,
            """SELECT min(duration_ms) AS min, max(duration_ms) AS max,
            count(*) - count(duration_ms) AS missing_count FROM e""",
        ),
        ["min", "max"],
    ),
)
def duration_range(spark, folder):
    return rounded(events.duration_range(A.material_events(spark, folder)))


def _two_states(spark, folder):
    """Two halves of the events with mixed targets, profiled apart; some rows are in both."""
    rows = A.mixed_events(spark, folder)
    halves = [rows.where("MaterialID % 2 = 0"), rows.where("MaterialID % 2 = 1 OR StepID = 3")]
    states = [profile_state.profile_state(h, f"part-{i}") for i, h in enumerate(halves)]
    return profile_state.merge_states(*states)


_TWO_STATES = {
    "m": A.MIXED_EVENTS_SQL,
    "e": """SELECT * FROM m WHERE MaterialID % 2 = 0
      UNION ALL SELECT * FROM m WHERE MaterialID % 2 = 1 OR StepID = 3""",
}


@query(
    "profile_state_values",
    with_tables(
        _TWO_STATES,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS "count"
            FROM e GROUP BY ALL"""
            for c in profile_state.DISTRIBUTIONS
        ),
    ),
)
def profile_state_values(spark, folder):
    return profile_state.profile_values(_two_states(spark, folder))


@query(
    "profile_state_columns",
    with_tables(
        _TWO_STATES,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM e" for c in COLUMNS
        ),
    ),
)
def profile_state_columns(spark, folder):
    return profile_state.profile_columns(_two_states(spark, folder))


@query(
    "profile_state_summary",
    rounded_sql(
        with_tables(
            {
                **_TWO_STATES,
                "g": """SELECT count(*) AS n, count(DISTINCT target) > 1 AS t,
                  count(DISTINCT is_test) > 1 AS s FROM e GROUP BY MaterialID""",
                "d": "SELECT CAST(sum(n - 1) AS BIGINT) AS d FROM (SELECT COLUMNS(*), count(*) AS n FROM e GROUP BY ALL)",
            },
            """SELECT (SELECT count(*) FROM e) AS row_count, count(*) AS unique_material_id_count,
              count(*) FILTER (t) AS mixed_target_material_id_count,
              count(*) FILTER (s) AS mixed_is_test_material_id_count,
              (SELECT d FROM d) AS duplicate_full_row_count,
              CAST(min(n) AS DOUBLE) AS rows_per_material_min, CAST(max(n) AS DOUBLE) AS rows_per_material_max,
              avg(n) AS rows_per_material_mean, median(n) AS rows_per_material_median,
              quantile_cont(CAST(n AS DOUBLE), 0.25) AS rows_per_material_p25,
              quantile_cont(CAST(n AS DOUBLE), 0.75) AS rows_per_material_p75,
              (SELECT min(duration_ms) FROM e) AS duration_min, (SELECT max(duration_ms) FROM e) AS duration_max,
              (SELECT count(*) - count(duration_ms) FROM e) AS duration_missing_count FROM g""",
        ),
        [
            *[f"rows_per_material_{s}" for s in ("min", "max", "mean", "median", "p25", "p75")],
            "duration_min",
            "duration_max",
        ],
    ),
)
def profile_state_summary(spark, folder):
    return rounded(profile_state.profile_summary(_two_states(spark, folder)))


_EVENT_TAX = "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax"


@query(
    "event_duplicate_rows",
    f"""WITH l AS (SELECT * REPLACE ({_EVENT_TAX}) FROM lineitem),
    r AS (SELECT * FROM l UNION ALL SELECT * FROM l WHERE l_partkey % 50 = 0)
    SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_row_count
    FROM (SELECT *, count(*) AS n FROM r GROUP BY ALL)""",
)
def event_duplicate_rows(spark, folder):
    lines = A.table(spark, folder, "lineitem").withColumn(
        "l_tax", F.expr(_EVENT_TAX.removesuffix(" AS l_tax"))
    )
    return events.event_duplicates(lines.unionAll(lines.where("l_partkey % 50 = 0")))


_PROFILE_SIZES = ["min", "max", "mean", "median", "p25", "p75"]


def _counts_text(column: str) -> str:
    return f"""(SELECT string_agg(v || '=' || n, ',' ORDER BY v COLLATE "C") FROM (
      SELECT coalesce(CAST({column} AS VARCHAR), '<MISSING>') AS v, CAST(count(*) AS VARCHAR) AS n FROM e GROUP BY 1))"""


_MISSING_TEXT = " || ',' || ".join(
    f"'{c}=' || CAST((SELECT count(*) - count({c}) FROM e) AS VARCHAR)" for c in sorted(COLUMNS)
)


@query(
    "event_profile",
    rounded_sql(
        with_tables(
            {
                **MIXED,
                "g": """SELECT CAST(count(*) AS DOUBLE) AS n, count(DISTINCT coalesce(target, -9)) > 1 AS t,
                  count(DISTINCT coalesce(is_test, -9)) > 1 AS s FROM e GROUP BY MaterialID""",
                "r": "SELECT COLUMNS(*), count(*) AS n FROM e GROUP BY ALL",
            },
            f"""SELECT 'd1' AS dataset_id, 'events' AS file_path, (SELECT count(*) FROM e) AS row_count,
              CAST({len(COLUMNS)} AS BIGINT) AS column_count, '{",".join(COLUMNS)}' AS column_names,
              'MaterialID,StepID,duration_ms,target,is_test' AS required_reference_columns,
              '{",".join(FEATURES)}' AS feature_columns, count(*) AS unique_material_id_count,
              {_counts_text("target")} AS target_distribution,
              count(*) FILTER (t) = 0 AS target_consistent_by_material_id,
              count(*) FILTER (s) = 0 AS is_test_consistent_by_material_id,
              {_counts_text("StepID")} AS step_id_distribution,
              min(n) AS rows_min, max(n) AS rows_max, avg(n) AS rows_mean, median(n) AS rows_median,
              quantile_cont(n, 0.25) AS rows_p25, quantile_cont(n, 0.75) AS rows_p75,
              (SELECT min(duration_ms) FROM e) AS duration_min, (SELECT max(duration_ms) FROM e) AS duration_max,
              (SELECT count(*) - count(duration_ms) FROM e) AS duration_missing_count,
              {_MISSING_TEXT} AS missing_value_counts,
              (SELECT CAST(sum(n - 1) AS BIGINT) FROM r) AS duplicate_full_row_count,
              count(*) FILTER (t) AS mixed_target_material_id_count,
              count(*) FILTER (s) AS mixed_is_test_material_id_count FROM g""",
        ),
        [*[f"rows_{s}" for s in _PROFILE_SIZES], "duration_min", "duration_max"],
    ),
)
def event_profile(spark, folder):
    """The profile with its maps and lists as text, but for the types, which differ between engines."""
    profile = events.event_profile(A.mixed_events(spark, folder), "d1", "events").drop("dtypes")

    def text(name):
        kind = profile.schema[name].dataType.typeName()
        if kind == "array":
            return F.array_join(name, ",").alias(name)
        if kind == "map":
            parts = F.transform(F.map_entries(name), lambda e: F.concat_ws("=", e.key, e.value))
            return F.array_join(F.array_sort(parts), ",").alias(name)
        return F.col(name)

    structs = {"material_id_row_count_distribution": ("rows", _PROFILE_SIZES)}
    structs["duration_ms"] = ("duration", ["min", "max", "missing_count"])
    plain = [text(c) for c in profile.columns if c not in structs]
    inner = [F.col(f"{c}.{f}").alias(f"{p}_{f}") for c, (p, names) in structs.items() for f in names]
    return rounded(profile.select(*plain, *inner))


@query(
    "missing_as_label",
    with_tables(
        {"e": A.BAD_EVENTS_SQL},
        """SELECT MaterialID, StepID, coalesce(CAST(target AS VARCHAR), '<MISSING>') AS target,
        count(*) AS row_count FROM e GROUP BY ALL""",
    ),
)
def missing_as_label_query(spark, folder):
    label = missing_as_label(F.col("target")).alias("target")
    rows = A.bad_events(spark, folder).groupBy("MaterialID", "StepID", label)
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


# Order priorities start with a digit; the rest of the text is no number.
_TEXT_NUMBER = "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR(20)) END"


@query(
    "coerce_numeric",
    f"""SELECT o_orderkey AS sample_id, TRY_CAST({_TEXT_NUMBER} AS DOUBLE) AS value FROM orders""",
)
def coerce_numeric_query(spark, folder):
    rows = A.table(spark, folder, "orders").withColumn("text", F.expr(_TEXT_NUMBER))
    return rows.select(
        F.col("o_orderkey").alias("sample_id"), coerce_numeric(F.col("text")).alias("value")
    )


@query(
    "official_split",
    with_tables(
        EVENTS,
        """SELECT DISTINCT MaterialID,
        CASE WHEN is_test = 1 THEN 'test' ELSE 'train' END AS official_split FROM e""",
    ),
)
def official_split_query(spark, folder):
    split = official_split(F.col("is_test")).alias("official_split")
    return A.material_events(spark, folder).select("MaterialID", split).distinct()


@query(
    "check_binary",
    with_tables(
        {"e": A.BAD_EVENTS_SQL},
        """SELECT CAST(target AS VARCHAR) AS value, count(*) AS row_count FROM e
        WHERE target IS NULL OR target NOT IN (0, 1) GROUP BY 1""",
    ),
)
def check_binary(spark, folder):
    return contracts.binary_violations(A.bad_events(spark, folder), "target")


@query(
    "check_constant_in_group",
    with_tables(
        {"e": A.BAD_EVENTS_SQL},
        """SELECT MaterialID, count(*) AS row_count FROM e GROUP BY MaterialID
        HAVING count(DISTINCT coalesce(target, -9)) > 1""",
    ),
)
def check_constant_in_group(spark, folder):
    return contracts.mixed_groups(A.bad_events(spark, folder), "MaterialID", "target")


# One row per order and split flag of its lines, so some ids repeat and occur in both splits.
_LOOSE_MASTER = """SELECT 'd1' AS dataset_id, l_orderkey AS material_id,
  max(CASE WHEN l_partkey % 700 = 0 THEN 2 ELSE 1 END) AS label_original,
  max(CASE WHEN l_partkey % 700 = 0 THEN 2 ELSE 1 END) AS label_binary,
  CASE WHEN l_suppkey % 11 = 0 THEN 'test' WHEN l_suppkey % 97 = 1 THEN 'other' ELSE 'train' END
    AS official_split
  FROM lineitem GROUP BY l_orderkey, CASE WHEN l_suppkey % 11 = 0 THEN 'test'
    WHEN l_suppkey % 97 = 1 THEN 'other' ELSE 'train' END"""


def _loose_master(spark, folder):
    text = _LOOSE_MASTER.replace("FROM lineitem", "FROM {src}")
    return spark.sql(text, src=A.table(spark, folder, "lineitem"))


@query(
    "check_material_master",
    with_tables(
        {"m": _LOOSE_MASTER},
        """SELECT * FROM (
        SELECT 'duplicate_material_id' AS rule, (SELECT count(*) FROM (SELECT material_id FROM m
          GROUP BY 1 HAVING count(*) > 1)) AS violation_count
        UNION ALL SELECT 'label_outside_domain', (SELECT count(*) FROM m
          WHERE label_binary IS NULL OR label_binary NOT IN (0, 1))
        UNION ALL SELECT 'split_outside_domain', (SELECT count(*) FROM m
          WHERE official_split IS NULL OR official_split NOT IN ('train', 'test'))
        UNION ALL SELECT 'no_train_rows',
          (SELECT CAST(count(*) = 0 AS BIGINT) FROM m WHERE official_split = 'train')
        UNION ALL SELECT 'no_test_rows',
          (SELECT CAST(count(*) = 0 AS BIGINT) FROM m WHERE official_split = 'test')
        UNION ALL SELECT 'material_in_both_splits', (SELECT count(*) FROM (
          SELECT material_id FROM m WHERE official_split = 'train'
          INTERSECT SELECT material_id FROM m WHERE official_split = 'test')))
        WHERE violation_count > 0""",
    ),
)
def check_material_master(spark, folder):
    return contracts.material_master_violations(_loose_master(spark, folder))


@query(
    "split_overlap",
    with_tables(
        {"m": _LOOSE_MASTER},
        """SELECT material_id FROM m WHERE official_split = 'train'
        INTERSECT SELECT material_id FROM m WHERE official_split = 'test'""",
    ),
)
def split_overlap(spark, folder):
    return contracts.split_overlap(_loose_master(spark, folder))


def _parts(features=FEATURES, steps=STEPS) -> dict[str, list[str]]:
    """SQL of the aggregate columns of a material master, part by part."""
    sql_of = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}

    def share(c: str) -> str:
        return f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS {c}_missing_ratio"

    return {
        "base": [
            "max(target) AS label_original",
            "max(target) AS label_binary",
            "CASE WHEN max(is_test) = 1 THEN 'test' ELSE 'train' END AS official_split",
            "count(*) AS source_record_count",
            "count(DISTINCT StepID) AS step_count",
        ],
        "duration": [
            *[f"{sql_of[s]}(duration_ms) AS duration_ms_{s}" for s in ("min", "max", "mean", "std")],
            share("duration_ms"),
        ],
        "features": [
            *[f"{sql_of[s]}({f}) AS {f}_{s}" for f in features for s in materials.STATISTICS],
            *[share(f) for f in features],
        ],
        "steps": [
            f"avg({f}) FILTER (StepID = {s}) AS {_quoted(f, s)}" for f in features for s in steps
        ],
    }


def _quoted(feature: str, step: int) -> str:
    return f'"{materials.step_column(feature, step)}"'


def _by_material(source: dict[str, str], *parts: str, **kwargs) -> str:
    columns = [c for p in parts for c in _parts(**kwargs)[p]]
    return with_tables(
        source, f"SELECT MaterialID AS material_id, {', '.join(columns)} FROM e GROUP BY MaterialID"
    )


DURATION_DOUBLES = statistic_columns(["duration_ms"], ["min", "max", "mean", "std", "missing_ratio"])


def _feature_doubles(features=FEATURES) -> list[str]:
    return statistic_columns(features, [*materials.STATISTICS, "missing_ratio"])


def _step_doubles(features=FEATURES, steps=STEPS) -> list[str]:
    return [_quoted(f, s) for f in features for s in steps]


@query("material_base", _by_material(EVENTS, "base"))
def material_base(spark, folder):
    return materials.material_base(A.material_events(spark, folder))


@query(
    "material_duration_stats",
    rounded_sql(_by_material(EVENTS, "duration"), DURATION_DOUBLES),
)
def material_duration_stats(spark, folder):
    return rounded(materials.material_duration_stats(A.material_events(spark, folder)))


@query(
    "material_feature_stats",
    rounded_sql(_by_material(EVENTS, "features"), _feature_doubles()),
)
def material_feature_stats(spark, folder):
    return rounded(materials.material_feature_stats(A.material_events(spark, folder)))


@query("step_mean_pivot", rounded_sql(_by_material(EVENTS, "steps"), _step_doubles()))
def step_mean_pivot(spark, folder):
    rows = A.material_events(spark, folder)
    return rounded(
        materials.step_means(rows, event_features(rows), materials.observed_steps(rows))
    )


_STEP_ENTRIES = """SELECT MaterialID AS material_id, StepID, max(is_test) AS is_test,
  '{0}' AS feature, avg({0}) AS value FROM e GROUP BY MaterialID, StepID
  HAVING count({0}) > 0"""
_STEP_VECTORS = {
    "e": A.MANY_STEP_EVENTS_SQL,
    "entries": " UNION ALL ".join(_STEP_ENTRIES.format(f) for f in FEATURES),
    "n": "SELECT count(DISTINCT MaterialID) AS n FROM e WHERE is_test = 0",
    "medians": """SELECT feature, StepID, median(value) AS median FROM entries
      WHERE is_test = 0 GROUP BY feature, StepID""",
    "spread": """SELECT feature, StepID, median, sum((value - median) * (value - median)) / max(n)
        - (sum(value - median) / max(n)) * (sum(value - median) / max(n)) AS variance
      FROM entries JOIN medians USING (feature, StepID) CROSS JOIN n
      WHERE is_test = 0 GROUP BY feature, StepID, median""",
    "positions": """SELECT feature, StepID, median,
        CAST(row_number() OVER (ORDER BY feature, StepID) - 1 AS INTEGER) AS position,
        CASE WHEN variance > 0 THEN sqrt(variance) ELSE 1.0E0 END AS scale FROM spread""",
}


@query(
    "step_positions_many_steps",
    rounded_sql(
        with_tables(
            _STEP_VECTORS, "SELECT feature, StepID, position, median, scale FROM positions"
        ),
        ["median", "scale"],
    ),
)
def step_positions_many_steps(spark, folder):
    rows = A.many_step_events(spark, folder)
    return rounded(step_vectors.fitted_steps(rows, event_features(rows))[1])


@query(
    "step_vectors_many_steps",
    rounded_sql(
        with_tables(
            _STEP_VECTORS,
            """SELECT material_id, position, (value - median) / scale AS value
            FROM entries JOIN positions USING (feature, StepID)""",
        ),
        ["value"],
    ),
)
def step_vectors_many_steps(spark, folder):
    rows = A.many_step_events(spark, folder)
    cells = step_vectors.step_cells(*step_vectors.fitted_steps(rows, event_features(rows)))
    pairs = F.inline(F.arrays_zip(F.col("positions").alias("position"), F.col("values").alias("value")))
    return rounded(cells.select("material_id", pairs))


def _master_sql(name: str, source: dict[str, str], features, steps) -> str:
    columns = _by_material(
        source, "base", "duration", "features", "steps", features=features, steps=steps
    )
    lineage = ", ".join(f"'{v}' AS {k}" for k, v in materials.MATERIAL_LINEAGE.items())
    doubles = [
        *DURATION_DOUBLES,
        *_feature_doubles(features),
        *_step_doubles(features, steps),
    ]
    return rounded_sql(
        f"SELECT '{name}' AS dataset_id, *, {lineage}, 'manifest/{name}' "
        f"AS sequence_manifest_path FROM ({columns})",
        doubles,
    )


D2_EVENTS = {"e": A.EVENTS_D2_SQL}
D2_FEATURES, D2_STEPS = ["feature_1", "feature_2"], [-1, 1, 2, 3, 4]


def d1_master(spark, folder):
    return materials.material_master(A.material_events(spark, folder), "d1", "manifest/d1")


def d2_master(spark, folder):
    return materials.material_master(A.material_events_d2(spark, folder), "d2", "manifest/d2")


@query("material_master", _master_sql("d1", EVENTS, FEATURES, STEPS))
def material_master(spark, folder):
    return rounded(d1_master(spark, folder))


@query("material_master_d2", _master_sql("d2", D2_EVENTS, D2_FEATURES, D2_STEPS))
def material_master_d2(spark, folder):
    return rounded(d2_master(spark, folder))


def _manifest_sql(source: dict[str, str]) -> str:
    sql = f"""SELECT 'd1' AS dataset_id, MaterialID AS material_id,
      {', '.join(_parts()['base'])}, min(duration_ms) AS duration_ms_min,
      max(duration_ms) AS duration_ms_max,
      CAST(to_json(list_sort(list(DISTINCT StepID))) AS VARCHAR) AS observed_step_ids_json,
      'lineitem.parquet' AS raw_event_file_path, TRUE AS sequence_available
      FROM e GROUP BY MaterialID"""
    return rounded_sql(with_tables(source, sql), ["duration_ms_min", "duration_ms_max"])


def _manifest(rows):
    manifest = materials.sequence_manifest(rows, "d1", "lineitem.parquet")
    return rounded(manifest.drop("observed_step_ids"))


@query("sequence_manifest", _manifest_sql(EVENTS))
def sequence_manifest(spark, folder):
    return _manifest(A.material_events(spark, folder))


@query("sequence_manifest_many_steps", _manifest_sql({"e": A.MANY_STEP_EVENTS_SQL}))
def sequence_manifest_many_steps(spark, folder):
    return _manifest(A.many_step_events(spark, folder))


@query("observed_steps", with_tables(EVENTS, "SELECT DISTINCT StepID FROM e ORDER BY StepID"))
def observed_steps(spark, folder):
    return materials.distinct_steps(A.material_events(spark, folder))


def _metadata_sql(name: str, events_sql: str, feature_count: int, step_count: int) -> str:
    return f"""SELECT '{name}' AS dataset_id, count(*) AS material_master_row_count,
      CAST(sum(n) AS BIGINT) AS source_record_count,
      CAST({feature_count} AS BIGINT) AS numeric_feature_count,
      CAST({step_count} AS BIGINT) AS observed_step_count,
      count(*) FILTER (s = 0) AS train_material_count,
      count(*) FILTER (s = 1) AS test_material_count,
      count(*) FILTER (t = 0) AS label_0_count, count(*) FILTER (t = 1) AS label_1_count
    FROM (SELECT MaterialID, count(*) AS n, max(target) AS t, max(is_test) AS s
      FROM ({events_sql}) GROUP BY MaterialID)"""


def _metadata(rows, name):
    steps = materials.observed_steps(rows)
    master = materials.material_master(rows, name, f"manifest/{name}", steps=steps)
    return materials.material_metadata(master, event_features(rows), steps)


@query("material_metadata", _metadata_sql("d1", A.EVENTS_SQL, 3, 7))
def material_metadata(spark, folder):
    return _metadata(A.material_events(spark, folder), "d1")


@query(
    "dataset_comparison",
    _metadata_sql("d1", A.EVENTS_SQL, 3, 7)
    + " UNION ALL "
    + _metadata_sql("d2", A.EVENTS_D2_SQL, 2, 5),
)
def dataset_comparison(spark, folder):
    return summary.material_comparison(
        [
            _metadata(A.material_events(spark, folder), "d1"),
            _metadata(A.material_events_d2(spark, folder), "d2"),
        ]
    )


@query(
    "design_decision",
    with_tables(
        {
            "d1": _MIXED_COUNTS.replace("FROM e ", f"FROM ({A.MIXED_EVENTS_SQL}) "),
            "d2": _MIXED_COUNTS.replace("FROM e ", f"FROM ({A.EVENTS_D2_SQL}) "),
            "u": "SELECT * FROM d1 UNION ALL SELECT * FROM d2",
        },
        """SELECT bool_and(target_consistent_by_material_id) AS target_safe,
        bool_and(is_test_consistent_by_material_id) AS is_test_safe,
        CAST(sum(mixed_target_material_id_count) AS BIGINT) AS mixed_target_materials,
        CAST(sum(mixed_is_test_material_id_count) AS BIGINT) AS mixed_is_test_materials,
        'feature_1,feature_2,feature_3' AS feature_columns FROM u""",
    ),
)
def design_decision(spark, folder):
    profiles = [
        events.mixed_material_counts(rows).select(
            F.lit(name).alias("dataset_id"),
            "*",
            F.lit(events.feature_union(rows)).alias("feature_columns"),
        )
        for name, rows in (
            ("d1", A.mixed_events(spark, folder)),
            ("d2", A.material_events_d2(spark, folder)),
        )
    ]
    decision = events.design_decision(profiles[0].unionByName(profiles[1]))
    return decision.drop("per_dataset").withColumn(
        "feature_columns", F.array_join("feature_columns", ",")
    )


@query(
    "top_event_columns",
    with_tables(
        EVENTS,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM e"
            for c in COLUMNS
        )
        + ") ORDER BY missing_count DESC, column_name LIMIT 20",
    ),
)
def top_event_columns(spark, folder):
    return events.top_missing_columns(events.missing_counts(A.material_events(spark, folder)))


@query(
    "top_event_steps",
    with_tables(
        EVENTS,
        """SELECT CAST(StepID AS VARCHAR) AS value, count(*) AS "count" FROM e GROUP BY 1
        ORDER BY "count" DESC, value LIMIT 20""",
    ),
)
def top_event_steps(spark, folder):
    return events.top_steps(events.value_counts(A.material_events(spark, folder), "StepID"))


@query(
    "feature_union",
    with_tables(
        {"d1": A.EVENTS_SQL, "d2": A.EVENTS_D2_SQL},
        " UNION ".join(
            f"SELECT '{f}' AS feature, (SELECT count({f}) FROM d1) + (SELECT "
            f"{'count(' + f + ')' if f in D2_FEATURES else '0'} FROM d2 LIMIT 1) AS value_count"
            for f in FEATURES
        ),
    ),
)
def feature_union(spark, folder):
    tables = [A.material_events(spark, folder), A.material_events_d2(spark, folder)]
    counts = [
        t.agg(*[F.count(f).alias(f) for f in event_features(t)]).unpivot(
            [], event_features(t), "feature", "n"
        )
        for t in tables
    ]
    both = counts[0].unionByName(counts[1]).where(F.col("feature").isin(events.feature_union(*tables)))
    return both.groupBy("feature").agg(F.sum("n").alias("value_count"))


_MASTER_FEATURES = [
    *DURATION_DOUBLES,
    *statistic_columns(FEATURES, materials.STATISTICS),
    *[f"{f}_missing_ratio" for f in FEATURES],
    *[materials.step_column(f, s) for f in FEATURES for s in STEPS],
]


@query(
    "baseline_feature_metadata",
    f"""SELECT dataset_id, CAST({len(_MASTER_FEATURES)} AS BIGINT) AS selected_feature_count,
      '{",".join(_MASTER_FEATURES)}' AS selected_feature_columns, count(*) AS row_count,
      count(*) FILTER (s = 0) AS train_row_count, count(*) FILTER (s = 1) AS test_row_count,
      count(*) FILTER (s = 0 AND t = 0) AS train_label_0_count,
      count(*) FILTER (s = 0 AND t = 1) AS train_label_1_count,
      count(*) FILTER (s = 1 AND t = 0) AS test_label_0_count,
      count(*) FILTER (s = 1 AND t = 1) AS test_label_1_count,
      count(DISTINCT CASE WHEN s = 0 THEN t END) AS train_class_count,
      'median_fit_on_official_train_only' AS imputation_strategy,
      'standard_scaler_fit_on_official_train_only_for_logistic_regression' AS scaling_strategy,
      'not_applied' AS random_forest_scaling, 0.5E0 AS default_threshold
    FROM (SELECT CASE WHEN MaterialID % 5 = 0 THEN 'd0' ELSE 'd1' END AS dataset_id, MaterialID,
        max(target) AS t, max(is_test) AS s FROM ({A.EVENTS_SQL}) GROUP BY ALL)
    GROUP BY dataset_id""",
)
def baseline_feature_metadata(spark, folder):
    name = F.expr("CASE WHEN material_id % 5 = 0 THEN 'd0' ELSE 'd1' END")
    master = d1_master(spark, folder).withColumn("dataset_id", name)
    document = summary.baseline_feature_metadata(master, material_features(master))
    listed = F.array_join("selected_feature_columns", ",")
    return document.withColumn("selected_feature_columns", listed)


_SKIPPED = f"""SELECT 'd1' AS dataset_id, material_id, label_original, label_binary,
  official_split, model_name, CAST(NULL AS DOUBLE) AS defect_probability,
  CAST(NULL AS INTEGER) AS predicted_label, 0.5E0 AS threshold,
  '{models.ONE_CLASS_TRAIN_WARNING}' AS warning
  FROM (SELECT MaterialID AS material_id, max(target) AS label_original,
    max(target) AS label_binary,
    CASE WHEN max(is_test) = 1 THEN 'test' ELSE 'train' END AS official_split
    FROM ({A.ONE_CLASS_EVENTS_SQL}) GROUP BY MaterialID) m
  CROSS JOIN (VALUES ('logistic_regression'), ('random_forest')) n(model_name)
  WHERE official_split = 'test'"""


@query("skipped_training", _SKIPPED)
def skipped_training(spark, folder):
    master = materials.material_master(A.one_class_events(spark, folder), "d1", "manifest/d1")
    return models.train_and_evaluate(master).predictions


@query(
    "skipped_metrics",
    f"""SELECT 'd1' AS dataset_id, model_name, 0.5E0 AS threshold,
    {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in ('accuracy', 'precision', 'recall', 'f1', 'f2', 'average_precision', 'roc_auc'))},
    {', '.join(f'CAST(NULL AS BIGINT) AS {c}' for c in ('true_positive', 'false_positive', 'true_negative', 'false_negative'))},
    '{models.ONE_CLASS_TRAIN_WARNING}' AS warnings
    FROM (VALUES ('logistic_regression'), ('random_forest')) n(model_name)
    WHERE (SELECT count(DISTINCT target) FROM ({A.ONE_CLASS_EVENTS_SQL}) WHERE is_test = 0) < 2""",
)
def skipped_metrics(spark, folder):
    master = materials.material_master(A.one_class_events(spark, folder), "d1", "manifest/d1")
    return models.train_and_evaluate(master).metrics
