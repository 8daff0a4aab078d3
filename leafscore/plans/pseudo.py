"""Pseudo-labels: score unlabelled rows with the fold models, train again on both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from leafscore.operators.clean import drop_incomplete, union_fill
from leafscore.operators.folds import kfold
from leafscore.operators.linear import fit_folds, ridge_fit, score_oof, score_unseen
from leafscore.session import materialise
from leafscore.sources.models import Models


def pseudo_label(train: DataFrame, test: DataFrame, models: Models, xs: Sequence[str]) -> DataFrame:
    """Labelled rows and unlabelled rows under each other; the latter get the models' mean as target.

    Unlabelled rows have no standard error, so the filter for incomplete rows keeps them.
    """
    labelled = score_unseen(test, xs, models, name="target")
    return drop_incomplete(union_fill(train, labelled))


def pseudo_oof(
    train: DataFrame, test: DataFrame, xs: Sequence[str], folds: int, seed: int, key: str = "id"
) -> DataFrame:
    """Fit on the labelled rows, label the others, and predict both out of fold with new models."""
    first = fit_folds(kfold(train, key, folds, seed), xs, "target", ridge_fit())
    both = materialise(pseudo_label(train, test, first, xs), "pseudo")
    both = kfold(both, key, folds, seed)
    again = fit_folds(both, xs, "target", ridge_fit())
    return score_oof(both, xs, again, name="pred_target")
