"""Scores: rules, a fitted Spark ML model, or a blend of both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.functions.columns import flag, with_sql
from amberline.functions.rules import (
    DECISION_THRESHOLD,
    DEFAULT_RULES,
    Rule,
    fired_names,
    rule_probability,
)
from amberline.operators.evaluation import best_threshold, in_holdout, precision_recall
from amberline.schemas import FEATURES, names

_GAPPY = ("hour", "day_of_week", "amount_log", "merchant_length")


def _verdict(df: DataFrame, probability: str, method: str, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    scored = with_sql(df, {"fraud_probability": probability})
    return with_sql(
        scored,
        {
            "is_fraud_predicted": flag(f"fraud_probability > {threshold!r}D"),
            "prediction_method": f"'{method}'",
        },
    )


def score_rules(
    df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, explain: bool = False
) -> DataFrame:
    """Score feature rows by the rules; ``explain`` adds ``rules_fired array<string>``."""
    scored = _verdict(df, rule_probability(rules), "rule_based")
    return with_sql(scored, {"rules_fired": fired_names(rules)}) if explain else scored


def _with_model_probability(df: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    applied = model.transform(df)
    return applied.select(*df.columns, vector_to_array("probability")[1].alias(name))


def decision_threshold(model: PipelineModel) -> float:
    """The probability above which the model flags a row: that of its last stage, if it has one, else the rules'."""
    last = model.stages[-1] if model.stages else None
    has_one = last is not None and last.hasParam("threshold") and last.isDefined("threshold")
    return float(last.getOrDefault("threshold")) if has_one else DECISION_THRESHOLD


def with_threshold(model: PipelineModel, threshold: float) -> PipelineModel:
    """The model with its last stage's threshold set, which is saved with it; a floor below 0 becomes 0."""
    last = model.stages[-1]
    return PipelineModel([*model.stages[:-1], last.copy({last.getParam("threshold"): max(float(threshold), 0.0)})])


def score_model(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Score feature rows by a fitted pipeline that yields a ``probability`` vector, and flag them by its threshold."""
    applied = _with_model_probability(df, model, "_p")
    return _verdict(applied, "_p", "model", decision_threshold(model)).drop("_p")


def score_ensemble(
    df: DataFrame,
    model: PipelineModel,
    weight: float = 0.5,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> DataFrame:
    """weight * rule probability + (1 - weight) * model probability."""
    applied = _with_model_probability(df, model, "_p")
    blend = f"{weight}D * {rule_probability(rules)} + {1 - weight}D * _p"
    return _verdict(applied, blend, "ensemble").drop("_p")


def score(
    df: DataFrame,
    model: PipelineModel | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> DataFrame:
    """By the model when there is one, else by the rules."""
    return score_rules(df, rules) if model is None else score_model(df, model)


def train_model(df: DataFrame, label: str = "is_fraud") -> PipelineModel:
    """Fit a logistic regression on the nine features; rows without a label are left out.

    Missing features take the column mean, so every row can be scored later.
    """
    inputs = [f"{name}_filled" if name in _GAPPY else name for name in names(FEATURES)]
    stages = [
        Imputer(inputCols=list(_GAPPY), outputCols=[f"{name}_filled" for name in _GAPPY]),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=20),
    ]
    labelled = df.where(F.col(label).isNotNull()).select(*names(FEATURES), label)
    return Pipeline(stages=stages).fit(labelled)


def train_and_evaluate(
    df: DataFrame, label: str = "is_fraud", holdout: int = 20, least_precision: float | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the ids outside the holdout, choose the threshold on those inside it.

    Returns the model, its threshold set, and one row with the figures of the holdout there. Without a threshold
    that serves (no fraud in the holdout, or none reaches ``least_precision``) there is no row, and the
    model keeps 0.5.
    """
    held = in_holdout(holdout)
    model = train_model(df.where(f"NOT {held}"), label)
    scored = _with_model_probability(df.where(held), model, "_p").select("_p", label)
    best = best_threshold(precision_recall(scored, "_p", label), least_precision)
    row = best.first()
    return (model if row is None else with_threshold(model, row.threshold)), best
