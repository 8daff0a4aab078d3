"""Every operator as a query on the given tables, and the SQL that must give the same rows."""

from leafscore.plans.checks import learners, metrics, ranks, tables, texts, vectors

_PARTS = (tables, ranks, metrics, texts, vectors, learners)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
