"""Text expressions that stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_newlines(text: Column) -> Column:
    """Remove newlines; nothing takes their place, so the words around them join up."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def wrap_markers(text: Column, begin: str, end: str) -> Column:
    """`begin text end`; a missing text stays missing."""
    return F.concat(F.lit(f"{begin} "), text, F.lit(f" {end}"))


def tokens(text: Column) -> Column:
    """All tokens of a text, cut at white space."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def first_tokens(text: Column, n: int) -> Column:
    """`slice(tokens(text), 1, n)`, without cutting up the text behind the n-th token."""
    pieces = F.split(F.regexp_replace(text, r"^\s+", ""), r"\s+", n + 1)
    return F.filter(F.slice(pieces, 1, n), lambda t: t != "")


def seeded_hash(seed, *keys) -> Column:
    """32 hex digits: the same for a seed and key on every machine, partitioning and retry."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k) if isinstance(k, str) else k for k in keys]))


def hash_number(digest: Column, start: int = 1) -> Column:
    """Eight hex digits of a hash, from 1-based `start`, as a number below 2**32."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
