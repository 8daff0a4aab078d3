"""Score unseen texts with several families of fold models and fill the output template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.operators.clean import fill_submission
from leafscore.operators.scoring import score_families
from leafscore.sources.models import Models


def infer(template: DataFrame, vecs: DataFrame, vec: str, models: Models, weights: dict[str, float]) -> DataFrame:
    """Fold means per family, blended by weight, in the template's rows.

    All of it is per row; the only shuffle is the join with the template.
    """
    families = score_families(vecs, vec, models)
    terms = [F.col(family) * weight for family, weight in weights.items()]
    return fill_submission(template, families.select("id", sum(terms[1:], terms[0]).alias("target")))
