"""Rows that operators stumble over, beside ordinary ones."""

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside; a table may have them.
CLASHING = ["score", "lang_pred", "mark", "key", "row", "class", "at", "c0", "guess", "place", "spans_at", "a.b"]


def prose(rng, n, words="the and of ing tion re on er an ed st nd a be"):
    return " ".join("".join(rng.choices(words.split(), k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """[(doc_id, text)] with nulls, empty and long texts, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(5)
    passage = prose(rng, 70)
    base = prose(rng, 150)
    words = base.split()
    near = words.copy()
    near[75] = "changed"
    rows = [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, prose(rng, 40) + " " + passage + " " + prose(rng, 30)),
        (5, passage + " " + prose(rng, 20)),
        (6, prose(rng, 10) + "\n" + passage),
        (7, None),
        (8, ""),
        (9, ""),
        (10, " \n\t "),
        (11, "!!! ... 123 456"),
        (12, "short"),
        (13, "short"),
        (14, "é" * 120 + " " + "ü" * 60),
        (15, "é" * 120),
        (16, " ".join(prose(rng, 500) for _ in range(12)) + " " + passage),
        (17, "same same " * 400),
        (18, "same same " * 390 + "end"),
        (19, prose(rng, 60)),
        (19, prose(rng, 60)),
        (20, prose(rng, 55)),
        (20, None),
        (None, base),
        (None, None),
        (21, "x" * 3000),
        (22, "y" + "x" * 2999),
        (23, "<|endoftext|> don't we'll 're  ​ \x85 日本語 🎉🎉 ̈a"),
    ]
    rows.append(rows[4])  # a repeated row
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(d, t, None if i % 3 else "en", None, None) for i, (d, t) in enumerate(odd_rows)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    return docs.withColumns({c: docs["doc_id"] for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
