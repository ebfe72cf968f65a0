"""Wide branch: from the master table to models, scores, thresholds, missed defects and reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from fabgauge.functions.columns import WIDE_LINEAGE_COLUMNS, reject_metadata_features
from fabgauge.operators import contracts, evaluate, explain, models, split
from fabgauge.plans.master import Master
from fabgauge.session import fix, together

# Columns of a master table that say something about a sample instead of measuring it.
METADATA_COLUMNS = [*WIDE_LINEAGE_COLUMNS, "label", "label_original", "label_binary", "split", "sample_id", "timestamp"]


@dataclass
class WideRun:
    """Both models with the scored test rows; the tables below are made from the scores when asked for."""

    features: list[str]
    test: DataFrame
    models: dict[str, PipelineModel]
    scored: DataFrame

    def metrics(self) -> DataFrame:
        return evaluate.metric_table(evaluate.classification_metrics(self.scored))

    def thresholds(self) -> DataFrame:
        return evaluate.threshold_metrics(self.scored)

    def missed_defects(self) -> DataFrame:
        """Defects missed at the default threshold and at the one with the best F2."""
        return evaluate.false_negative_analysis(self.scored, self.thresholds())

    def top_risk(self) -> DataFrame:
        return evaluate.top_risk_samples(self.scored)

    def importance(self, repeats: int = explain.REPEATS) -> DataFrame:
        logistic, forest = (self.models[n] for n in (models.LOGISTIC, models.FOREST))
        return explain.feature_importance(logistic, forest, self.test, self.features, repeats=repeats)

    def error_profile(self) -> DataFrame:
        """Sensors of the riskiest, the missed and all test samples."""
        risky = evaluate.top_risk_head(self.scored)
        missed = self.missed_defects().select("sample_id")
        return explain.error_feature_profile(self.test, risky, missed, self.features)


def checked_parts(master: Master) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a master table, which is written once as everything reads it several times.

    A feature that is a metadata column, and train or test rows without both classes, are errors: the
    curves of this branch mean nothing then.
    """
    reject_metadata_features(master.features, METADATA_COLUMNS)
    train, test = split.train_test(fix(master.table))
    for rows in (train, test):
        contracts.assert_both_classes(rows)
    return train, test


def scored_run(features: list[str], test: DataFrame, fitted: dict[str, PipelineModel]) -> WideRun:
    """The test rows scored by each model; the scores are written once."""
    tables = {name: models.positive_score(model, test) for name, model in fitted.items()}
    return WideRun(features, test, fitted, fix(evaluate.stack(tables, "model_name")))


def run_wide_branch(
    master: Master, trees: int = models.TREES, depth: int = models.TREE_DEPTH
) -> WideRun:
    """Check a master table, train both models on its train rows and score its test rows."""
    train, test = checked_parts(master)
    logistic, forest = together(
        lambda: models.train_logistic(train, master.features),
        lambda: models.train_forest(train, master.features, trees=trees, depth=depth),
    )
    return scored_run(master.features, test, {models.LOGISTIC: logistic, models.FOREST: forest})
