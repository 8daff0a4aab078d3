"""Scores of many linear models at once."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.functions.vectors import linear_scores
from leafscore.sources.models import Models


def score_all(df: DataFrame, vec: str, models: Models, key: str = "id") -> DataFrame:
    """Rows (id, family, fold, pred): every row scored by every model.

    The vector is read once and multiplied by all models' coefficients; rows are not joined with
    models.
    """
    scored = df.select(key, linear_scores(models.coef, models.bias)(vec).alias("__s"))
    named = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"), F.lit(int(fold)).alias("fold"), F.col("__s")[i].alias("pred")
            )
            for i, (family, fold) in enumerate(models.names)
        ]
    )
    return scored.select(key, F.inline(named))


def score_families(df: DataFrame, vec: str, models: Models, key: str = "id") -> DataFrame:
    """Rows (id, one column per family): the mean score of the family's fold models.

    The mean of linear scores is the score of the mean coefficients, so nothing is spread out into
    rows and gathered again: no shuffle.
    """
    families = sorted({family for family, _ in models.names})
    rows = [[i for i, (family, _) in enumerate(models.names) if family == f] for f in families]
    coef = np.array([models.coef[r].mean(axis=0) for r in rows])
    bias = np.array([models.bias[r].mean() for r in rows])
    scored = df.select(key, linear_scores(coef, bias)(vec).alias("__s"))
    return scored.select(key, *[F.col("__s")[i].alias(f) for i, f in enumerate(families)])
