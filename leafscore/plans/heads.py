"""A linear head on document vectors: fit per fold, predict out of fold, measure, fill the template."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from leafscore.operators.clean import drop_incomplete, fill_submission
from leafscore.operators.folds import kfold
from leafscore.operators.linear import fit_vector_folds, ridge_fit, score_vector_oof, score_vector_unseen
from leafscore.operators.metrics import cv_summary
from leafscore.sources.models import Models

# Folds and seed of a single model's run.
FOLDS, SEED = 5, 1000


@dataclass(frozen=True)
class HeadRun:
    models: Models
    oof: DataFrame
    scores: DataFrame
    submission: DataFrame


def fit_head(
    train: DataFrame, template: DataFrame, unseen: DataFrame, vec: str, width: int, folds: int = FOLDS, seed: int = SEED
) -> HeadRun:
    """train (id, target, standard_error, vec); template (id, target); unseen (id, vec).

    Incomplete rows are dropped first; every other row is predicted by the model that has not seen it.
    """
    rows = kfold(drop_incomplete(train), "id", folds, seed)
    models = fit_vector_folds(rows, vec, width, "target", ridge_fit(), family="head")
    scored = score_vector_oof(rows, vec, models, name="pred_target")
    filled = score_vector_unseen(unseen.drop("target"), vec, models, name="target")
    return HeadRun(
        models,
        scored.select("id", "fold", "pred_target"),
        cv_summary(scored, "target", "pred_target"),
        fill_submission(template, filled),
    )
