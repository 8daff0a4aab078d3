"""Repeatable K-fold assignment by cut points: the labelled rows are never shuffled.

Folds of a shuffled table are runs of equal length in hash order. Only the K - 1 hashes that begin
a new run are needed to tell the fold of any row. They are found from counts per hash prefix and a
look into the few prefixes that hold a cut; after that the fold is an ordinary column expression.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafscore.functions.text import seeded_hash


# A prefix that holds a cut is refined until it has no more rows than this.
NEAR_ROWS = 1 << 20
_DIGITS = 32  # of the whole hash


def _hashed(df: DataFrame, key: str, seed, stratum: Column) -> DataFrame:
    """Rows (hash, stratum); a row without a key has no hash."""
    return df.select(F.when(F.col(key).isNotNull(), seeded_hash(seed, key)).alias("hash"), stratum.alias("stratum"))


def _prefix_counts(hashed: DataFrame, digits: int) -> pd.DataFrame:
    """Rows per stratum and hash prefix: at most strata * 16**digits numbers, whatever the table's size."""
    prefix = F.substring("hash", 1, digits).alias("prefix")
    counts = hashed.groupBy("stratum", prefix).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    if counts["prefix"].isna().any():
        raise ValueError("a row without a key cannot be given a fold")
    return counts.sort_values(["stratum", "prefix"], ignore_index=True)


def _places(counts: pd.DataFrame, ranks: dict[int, list[int]]) -> list[tuple[int, str, int, int, int]]:
    """(stratum, prefix, place in the prefix from 1, rank, rows of the prefix) of the wanted ranks."""
    wanted = []
    for stratum, part in counts.groupby("stratum"):
        ends = part["n"].cumsum().to_numpy()
        for rank in sorted({r for r in ranks[stratum] if r < ends[-1]}):
            i = int(np.searchsorted(ends, rank, side="right"))
            n = int(part["n"].iloc[i])
            wanted.append((int(stratum), part["prefix"].iloc[i], rank - int(ends[i] - n) + 1, rank, n))
    return wanted


def _near(hashed: DataFrame, wanted: list[tuple], digits: int) -> DataFrame:
    """The rows of the wanted prefixes; at most K - 1 per stratum."""
    held = hashed.sparkSession.createDataFrame(sorted({w[:2] for w in wanted}), "stratum int, prefix string")
    rows = hashed.withColumn("prefix", F.substring("hash", 1, digits))
    rows = rows.filter(F.col("prefix").isin(sorted({w[1] for w in wanted})))
    return rows.join(F.broadcast(held), ["stratum", "prefix"], "left_semi")


def _hashes_at(hashed: DataFrame, counts: pd.DataFrame, ranks: dict[int, list[int]], digits: int) -> dict[tuple, str]:
    """(stratum, rank) -> the hash at that 0-based place in the stratum's hash order.

    A hash that the row in front of the cut has as well would move the cut: a repeated key is an error there.
    """
    both = {s: sorted({r for cut in cuts for r in (cut - 1, cut) if r >= 0}) for s, cuts in ranks.items()}
    wanted = _places(counts, both)
    if not wanted:
        return {}
    while max(w[4] for w in wanted) > NEAR_ROWS and digits < _DIGITS:
        # Two digits more for the prefixes that hold a cut; ranks are counted anew inside them.
        near = _near(hashed, wanted, digits)
        finer = near.groupBy("stratum", "prefix", F.substring("hash", 1, digits + 2).alias("finer")).agg(F.count(F.lit(1)).alias("n"))
        finer = finer.toArrow().to_pandas().sort_values(["stratum", "prefix", "finer"], ignore_index=True)
        again = []
        for (stratum, prefix), part in finer.groupby(["stratum", "prefix"]):
            ends = part["n"].cumsum().to_numpy()
            for _, _, place, rank, _ in (w for w in wanted if w[:2] == (stratum, prefix)):
                i = int(np.searchsorted(ends, place - 1, side="right"))
                n = int(part["n"].iloc[i])
                again.append((int(stratum), part["finer"].iloc[i], place - int(ends[i] - n), rank, n))
        wanted, digits = again, digits + 2
    spark = hashed.sparkSession
    cuts = spark.createDataFrame([w[:4] for w in wanted], "stratum int, prefix string, place int, rank bigint")
    place = F.row_number().over(Window.partitionBy("stratum", "prefix").orderBy("hash"))
    found = _near(hashed, wanted, digits).withColumn("place", place).join(F.broadcast(cuts), ["stratum", "prefix", "place"])
    at = {(r.stratum, r.rank): r.hash for r in found.select("stratum", "rank", "hash").collect()}
    for stratum, cuts_of in ranks.items():
        for cut in cuts_of:
            if cut and (stratum, cut) in at and at[stratum, cut] == at[stratum, cut - 1]:
                raise ValueError("a key repeats: rows with the same key cannot be told apart")
    return {(s, r): at[s, r] for s, cuts_of in ranks.items() for r in cuts_of if (s, r) in at}


def _runs_passed(digest: Column, starts: Iterable[Column]) -> Column:
    """How many runs have begun at or before this hash; a run without a start never begins.

    The hash is an array's only element, so it is computed once and not per start, in a filter too.
    """
    starts = list(starts)

    def passed(value: Column) -> Column:
        return sum([F.coalesce(value >= start, F.lit(False)).cast("int") for start in starts], F.lit(0))

    return F.element_at(F.transform(F.array(digest), passed), 1)


def kfold(df: DataFrame, key: str, k: int, seed, name: str = "fold") -> DataFrame:
    """Add a fold 0..k-1: sizes n // k, the first n % k folds get one row more.

    The same for a seed whatever the partitioning. The key is unique: a row without key is an error, and
    so is a key whose repeats a cut would part.
    """
    hashed = _hashed(df, key, seed, F.lit(0))
    counts = _prefix_counts(hashed, 4)
    n = int(counts["n"].sum())
    if n < k:
        raise ValueError(f"cannot make {k} folds of {n} rows")
    first = [j * (n // k) + min(j, n % k) for j in range(1, k)]
    cuts = _hashes_at(hashed, counts, {0: first}, 4)
    fold = _runs_passed(seeded_hash(seed, key), [F.lit(cuts[0, r]) for r in first])
    return df.withColumn(name, fold)


def equal_width_bins(df: DataFrame, y: str, name: str = "bin") -> DataFrame:
    """Add the bin of y: floor(1 + log2 n) bins of equal width, closed on the right, the minimum in bin 0.

    A missing y has no bin; if all y are equal they share bin 0.
    """
    value = F.when(F.isnan(y), None).otherwise(F.col(y))
    n, low, high = df.agg(F.count(F.lit(1)), F.min(value), F.max(value)).first()
    edges = [] if low is None else np.linspace(low, high, n.bit_length() + 1)[1:-1]
    passed = sum([(value > F.lit(float(e))).cast("int") for e in edges], F.lit(0))
    return df.withColumn(name, F.when(value.isNotNull(), passed))


def kfold_stratified(df: DataFrame, key: str, y: str, k: int, seed, name: str = "fold") -> DataFrame:
    """Add a fold that spreads every bin of y over all folds.

    Places 0, 1, 2, ... of the table sorted by bin are dealt to folds 0, 1, .., k-1, 0, ..; that
    says how many rows of a bin each fold gets, so sizes differ by at most 1 over all and within
    each bin. Which rows of the bin they are is decided by hash order.
    """
    binned = equal_width_bins(df, y, "__bin")
    hashed = _hashed(binned, key, seed, F.coalesce("__bin", F.lit(-1)))
    counts = _prefix_counts(hashed, 3)
    before, first = 0, {}
    for stratum, n in counts.groupby("stratum")["n"].sum().items():
        n = int(n)
        dealt = [(before + n - j + k - 1) // k - (before - j + k - 1) // k for j in range(k)]
        first[int(stratum)] = [int(r) for r in np.cumsum(dealt)[:-1]]
        before += n
    if before < k:
        raise ValueError(f"cannot make {k} folds of {before} rows")
    cuts = _hashes_at(hashed, counts, first, 3)
    # One row per bin with the hashes where its folds begin. A run that would begin behind the last row
    # of the bin is empty and has none.
    rows = [(s, *[cuts.get((s, r)) for r in ranks]) for s, ranks in first.items()]
    names = [f"__start{j}" for j in range(1, k)]
    schema = ", ".join(["__stratum int", *[f"{c} string" for c in names]])
    starts = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    keyed = binned.withColumn("__stratum", F.coalesce("__bin", F.lit(-1)))
    fold = _runs_passed(seeded_hash(seed, key), [F.col(c) for c in names])
    dealt = keyed.join(starts, "__stratum", "left").withColumn(name, fold)
    return dealt.drop("__stratum", "__bin", *names)
