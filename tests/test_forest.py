"""Forests grown from bins: the same trees however the rows are dealt, as good as Spark's own."""

import threading

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fabgauge.operators import explain, forest, models, rescoring
from fabgauge.plans import wide_run
from fabgauge.queries import events, modeling
from fabgauge.queries.wide import wide_master
from fabgauge.sources import sinks

WEIGHT = np.array([1.0, 1.0])


@pytest.fixture(scope="module")
def rows(spark):
    """Class 1 where x > 0.6 and y < 0.5, and everywhere else for one row of a hundred."""
    return (
        spark.range(3000, numPartitions=3)
        .select(*[(F.abs(F.xxhash64("id", F.lit(k))) % 1000 / 1000).alias(c) for k, c in enumerate("xyz")], "id")
        .withColumn("label_binary", F.expr("cast((x > 0.6 AND y < 0.5) OR id % 100 = 0 AS int)"))
        .localCheckpoint()
    )


def stored(rows, parts):
    ready = VectorAssembler(inputCols=list("xyz"), outputCol="v").transform(rows.repartition(parts, "id"))
    limits = forest.bin_limits(ready, list("xyz"))
    return forest.binned_rows(ready, "v", "label_binary", limits), limits


def test_a_large_node_is_cut_as_in_one_task(rows):
    table, limits = stored(rows, 3)
    # All features are tried at each node, so where a node is cut does not change the cut but for ties.
    data = forest.Setting(limits, WEIGHT, 3, 4, 7)
    trees = []
    for most in (10_000, 500):
        tops, _ = forest.top_parts(table, data, 3, 3000, most)
        assert (max(len(t.left) for t in tops) > 1) == (most == 500)
        found = forest.forest_nodes(table, data, 3, most).select("treeID", "nodeData.*").orderBy("treeID", "id")
        trees.append([(r.treeID, r.id, r.impurityStats, r.leftChild, round(r.gain, 9)) for r in found.collect()])
    assert trees[0] == trees[1] and len(trees[0]) > 9


def test_forest_learns_the_corner_and_has_all_trees(rows):
    model = models.train_forest(rows, list("xyz"), trees=25, depth=6)
    fitted = model.stages[-1]
    assert fitted.getNumTrees == 25 and fitted.numFeatures == 3 and fitted.getOrDefault("maxDepth") == 6
    assert max(t.depth for t in fitted.trees) <= 6
    scored = models.positive_score(model, rows)
    inside = scored.groupBy((F.expr("x > 0.6 AND y < 0.5")).alias("i")).agg(F.avg("defect_probability").alias("p"))
    share = {r.i: r.p for r in inside.collect()}
    assert share[True] > 0.8 and share[False] < 0.3
    assert set(np.argsort(fitted.featureImportances.toArray())[-2:]) == {0, 1}
    again = models.train_forest(rows, list("xyz"), trees=25, depth=6).stages[-1]
    # The first line names the model.
    assert again.toDebugString.split("\n")[1:] == fitted.toDebugString.split("\n")[1:]


def test_every_row_has_a_bin(rows):
    table, limits = stored(rows, 2)
    assert table.count() == 3000 and [len(x) for x in limits] == [31, 31, 31]
    bins = np.array([list(r.bins) for r in table.collect()])
    assert bins.shape == (3000, 3) and set(bins.ravel()) == set(range(32))


def plain_cut(bins, label, count, chosen, weight):
    """The best cut of one node by trying each limit of each chosen feature."""

    def size_and_squares(rows):
        held = np.array([count[rows & (label == c)].sum() for c in (0, 1)]) * weight
        return held.sum(), (held**2).sum()

    whole, squares = size_and_squares(np.ones(len(label), bool))
    best = (-np.inf, None, None)
    for place, feature in enumerate(chosen):
        for last in range(forest.BINS - 1):
            parts = [size_and_squares(side) for side in (bins[:, feature] <= last, bins[:, feature] > last)]
            if all(size for size, _ in parts):
                gain = sum(s / n for n, s in parts) / whole - squares / whole**2
                best = max(best, (gain, -place, -last)) if best[1] is not None else (gain, -place, -last)
    return best[0], -best[1], -best[2]


def test_cuts_equal_plain_ones():
    random = np.random.default_rng(3)
    bins, label = random.integers(0, 8, (90, 5)).astype(np.uint8), random.integers(0, 2, 90)
    count, node, weight = random.integers(1, 4, 90).astype(float), np.arange(90) % 3, np.array([0.5, 3.0])
    chosen = np.array([[0, 3], [4, 1], [2, 0]])
    hist = forest.histograms(bins, label, count, node, chosen, 2)
    assert hist.shape == (3, 2, 2, forest.BINS)
    gain, place, last, left = forest.best_cuts(hist, weight)
    for n in range(3):
        rows = node == n
        expected = plain_cut(bins[rows], label[rows], count[rows], chosen[n], weight)
        assert (place[n], last[n]) == expected[1:] and abs(gain[n] - expected[0]) < 1e-12
        lower = rows & (bins[:, chosen[n, place[n]]] <= last[n])
        assert left[n].tolist() == [count[lower & (label == c)].sum() for c in (0, 1)]


def test_preorder_joins_leaves_that_predict_the_same():
    # 0 -> 1, 2; 1 -> 3, 4 (both class 0, so 1 becomes a leaf); 2 -> 5, 6.
    nodes = forest.Nodes(
        [1, 3, 5, -1, -1, -1, -1], [2, 4, 6, -1, -1, -1, -1], [1, 0, 0, -1, -1, -1, -1], [0, 1, 2, -1, -1, -1, -1],
        [0.3, 0.2, 0.1, -1.0, -1.0, -1.0, -1.0], [[9, 5], [6, 1], [3, 4], [4, 0], [2, 1], [3, 0], [0, 4]],
    )
    rows = forest.in_preorder(nodes, WEIGHT, [[1.0, 2.0, 3.0], [7.0]]).to_pylist()
    assert [(r["id"], r["leftChild"], r["rightChild"], r["rawCount"]) for r in rows] == [
        (0, 1, 2, 14), (1, -1, -1, 7), (2, 3, 4, 7), (3, -1, -1, 3), (4, -1, -1, 4)
    ]
    assert [(r["split"]["featureIndex"], r["split"]["leftCategoriesOrThreshold"]) for r in rows] == [
        (1, [7.0]), (-1, []), (0, [3.0]), (-1, []), (-1, [])
    ]
    assert [r["gain"] for r in rows] == [0.3, -1.0, 0.1, -1.0, -1.0]


def test_first_fit_reads_one_row_per_class(rows, monkeypatch):
    fit, seen = RandomForestClassifier.fit, []
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: (seen.append(df.count()), fit(self, df))[1])
    model = models.train_forest(rows, list("xyz"), trees=3, depth=2)
    assert seen == [2] and model.stages[-1].getNumTrees == 3


def test_rows_are_scored_as_by_sparks_model_without_reading_it(rows, monkeypatch, tmp_path):
    model = models.train_forest(rows, list("xyz"), trees=25, depth=6)
    probability = vector_to_array("_probability")[1].alias("p")
    expected = {r.id: r.p for r in model.transform(rows).select("id", probability).collect()}
    sinks.save_model(model, str(tmp_path / "model"))
    loaded = sinks.load_model(str(tmp_path / "model"))

    def load(folder):
        raise AssertionError("Spark's model was read")

    monkeypatch.setattr(RandomForestClassificationModel, "load", load)
    again = models.train_forest(rows, list("xyz"), trees=25, depth=6)
    for scorer in (again, loaded):
        scored = models.positive_score(scorer, rows)
        assert scored.columns == [*rows.columns, models.SCORE]
        found = {r.id: r[models.SCORE] for r in scored.collect()}
        assert found == pytest.approx(expected, rel=1e-12, abs=1e-12) and len(found) == 3000


def test_a_root_without_a_cut_scores_every_row(spark):
    rows = spark.range(40).selectExpr("id", "1.0D AS x", "cast(id % 4 = 0 AS int) AS label_binary")
    scored = models.positive_score(models.train_forest(rows, ["x"], trees=3, depth=2), rows.where("id < 10"))
    found = {r[models.SCORE] for r in scored.collect()}
    assert scored.count() == 10 and len(found) == 1 and 0 < found.pop() < 1


def test_both_models_are_fitted_side_by_side(spark, monkeypatch):
    # Each fit waits for the other one to begin.
    meet, fits = threading.Barrier(2, timeout=60), (models.train_logistic, models.train_forest)

    def waiting(fit):
        def begun(*args, **kwargs):
            meet.wait()
            return fit(*args, **kwargs)

        return begun

    for fit in fits:
        monkeypatch.setattr(models, fit.__name__, waiting(fit))
    folder = "/root/testdata/sf0.001"
    trained = models.train_and_evaluate(events.d2_master(spark, folder), trees=2, depth=2)
    assert list(trained.models) == [models.LOGISTIC, models.FOREST] and trained.metrics.count() == 2
    run = wide_run.run_wide_branch(wide_master(spark, folder), trees=2, depth=2)
    assert run.metrics().count() == 2


def test_limits_of_bins_are_not_fetched_one_by_one(spark, monkeypatch):
    names = [f"x{i}" for i in range(24)]
    rows = spark.range(700).select(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)).alias(n) for i, n in enumerate(names)])
    rows = rows.withColumn("none", F.lit(None).cast("double")).withColumn("gap", F.when(F.col("x0") < 3, F.lit(float("nan"))).otherwise(2.0))
    names += ["none", "gap"]
    plain = rows.select(*[F.col(n).cast("double") for n in names]).approxQuantile(names, [i / 256 for i in range(257)], 0.25 / 256)
    client = spark.sparkContext._gateway._gateway_client
    calls, send = [], client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(1) or send(*a, **k))
    limits = forest.bin_limits(rows, names)
    assert len(calls) < 4000
    assert limits[-2:] == [[], []]
    for found, values in zip(limits[:-2], plain, strict=False):
        assert found == np.unique([values[256 * i // 32] for i in range(1, 32)]).tolist()


def test_importance_and_rescoring_hold_few_nodes_at_a_time(rows, monkeypatch):
    model, names = models.train_forest(rows, list("xyz"), trees=25, depth=6), list("xyz")
    expected = models.train_forest(rows, names, trees=25, depth=6).stages[-1].featureImportances.toArray()

    def load(folder):
        raise AssertionError("Spark's model was read")

    monkeypatch.setattr(RandomForestClassificationModel, "load", load)
    monkeypatch.setattr(forest, "GROUP_NODES", 100)
    found = {r.feature: r.importance for r in explain.impurity_importance(model, names).collect()}
    assert [found[n] for n in names] == pytest.approx(expected.tolist(), rel=1e-9)
    scorer = rescoring.ForestRescorer.of(model)
    nodes = [len(g.value.feature) for g in scorer.groups]
    assert len(nodes) > 3 and sum(nodes) == model.nodes().count() and max(nodes) < 100 + 2**7
    values = np.array(rows.where("id < 200").select(names).collect())
    other = values[::-1].copy()
    changed = forest.changed_scores(scorer.groups, values, other)
    for i in range(3):
        moved = values.copy()
        moved[:, i] = other[:, i]
        # The votes are added up in the same order, so equal leaves give equal scores.
        assert changed[:, i].tolist() == forest.scores(scorer.groups, moved).tolist()
    assert (changed != forest.scores(scorer.groups, values)[:, None]).any()


def test_rows_of_few_trees_are_dealt_out_at_once(rows, monkeypatch):
    names, rounds, lower_parts = list("xyz"), [], forest.lower_parts
    monkeypatch.setattr(forest, "lower_parts", lambda *a: (rounds.append(a[-1]), lower_parts(*a))[1])
    monkeypatch.setattr(type(rows), "checkpoint", lambda *a, **k: pytest.fail("rows were written with all their columns"))
    one = models.train_forest(rows, names, trees=10, depth=6).stages[-1]
    # Some 0.64 of 3000 rows of 5 bytes a tree.
    monkeypatch.setattr(forest, "ROUND_BYTES", 40_000)
    several = models.train_forest(rows, names, trees=10, depth=6).stages[-1]
    assert rounds == [range(10), range(4), range(4, 8), range(8, 10)]
    assert several.getNumTrees == 10 and several.toDebugString.split("\n")[1:] == one.toDebugString.split("\n")[1:]


def test_master_is_stored_by_columns(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "train_and_evaluate", seen.append)
    modeling.trained_on(spark.range(50).selectExpr("id", "id % 3 AS a", "'x' AS b"))
    assert seen[0].inputFiles()[0].endswith(".parquet") and seen[0].count() == 50


def test_draws_and_large_nodes_as_before():
    ids = np.random.default_rng(2).integers(0, 2**62, 20_000)
    start = (2 * 0x9E3779B97F4A7C15 + 42 * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    x = ids.view(np.uint64) ^ np.uint64(start)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    plain = np.searchsorted(forest.DRAWN, (x >> np.uint64(11)) / 2.0**53, side="right")
    count = forest.draws(ids, 1, 42)
    assert count.tolist() == plain.tolist() and count.max() > 4
    random = np.random.default_rng(4)
    node = np.repeat([0, 1, 2, 4], [2500, 30, 4000, 500])  # node 3 has no rows
    bins, label = random.integers(0, 32, (len(node), 6)).astype(np.uint8), random.integers(0, 2, len(node))
    times, chosen = random.integers(1, 4, len(node)).astype(float), np.array([random.permutation(6)[:3] for _ in range(5)])
    found = forest.sorted_histograms(bins, label, times, node, chosen, 2)
    assert (found == forest.histograms(bins, label, times, node, chosen, 2)).all()
