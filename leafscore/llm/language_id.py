"""Language of whole texts: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, everything else is a space between words. All n-grams of 1 to 3 characters are
hashed to `BUCKETS` features; a feature's value is its share of the text's n-grams times its inverse
document frequency, which is counted over all training documents. The weights are learned by
follow-the-regularised-leader with an elastic-net penalty (most stay exactly 0) from a sample of about
`FIT_ROWS` training documents, spread evenly over the languages, or of `LANGUAGE_ROWS` for each language where
that is more; a fifth of them is kept back to fit the temperature that turns scores into calibrated
probabilities. Every language of the training documents is learned.

A score is linear in the counts, so a text of any length is scored by sums over its n-grams, without a
table of its distinct ones. What tasks are sent is a table of `BUCKETS` times languages numbers, for more than
`DENSE` languages only those that are not 0. While it learns, the driver holds two numbers for every language
and n-gram feature of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafscore.llm.buffers import mix, pieces
from leafscore.llm.store import batch_from, column_of, unused

BUCKETS = 1 << 16
NGRAMS = (1, 2, 3)
# Documents that the weights are fitted on, about, and of each language at least (if it has as many).
FIT_ROWS = 4000
LANGUAGE_ROWS = 50
# Up to so many languages, weights are a full table and learned in double precision.
DENSE = 64
# Follow-the-regularised-leader: step size, its offset, both penalties, and passes over the sample.
ALPHA, BETA, L1, L2, PASSES, STEP_ROWS = 2.0, 1.0, 0.02, 0.05, 4, 32
# Feature values are shares of a text; this brings them near 1.
SCALE = 30.0
UNDETERMINED = "und"


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Is the row in the part that is kept for testing? A row without a key is not; it is not learned from either."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(False))


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all n-grams, row of each) of some texts, in row order for each length of n-gram."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(" ".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in lowered])[: len(codes)]
    letter = _letters()[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # one space behind each word
    codes = np.where(letter, codes, 32)[kept].astype(np.uint64)
    rows = rows[kept]
    features, owners = [], []
    for n in NGRAMS:
        value = np.full(max(0, len(codes) - n + 1), n, np.uint64)
        for i in range(n):
            value = value * np.uint64(0x1FFFFF) + codes[i : len(codes) - n + 1 + i]
        inside = rows[: len(value)] == rows[n - 1 :]
        features.append((mix(value[inside]) & np.uint64(BUCKETS - 1)).astype(np.int32))
        owners.append(rows[: len(value)][inside])
    return features, owners


def _row_counts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct features, counts) of each text."""
    features, owners = grams(texts)
    bounds = [np.searchsorted(o, np.arange(len(texts) + 1)) for o in owners]
    for i in range(len(texts)):
        mine = np.concatenate([f[b[i] : b[i + 1]] for f, b in zip(features, bounds)])
        counts = np.bincount(mine, minlength=1)
        found = np.flatnonzero(counts)
        yield found, counts[found]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents per feature), counted over all rows: `BUCKETS` numbers per task are added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            for piece in pieces(batch, "text"):
                n += piece.num_rows
                texts = piece.column("text").to_pylist()
                features, owners = grams(texts)
                bounds = [np.searchsorted(o, np.arange(len(texts) + 1)) for o in owners]
                for i in range(len(texts)):
                    for f, b in zip(features, bounds):
                        seen[f[b[i] : b[i + 1]]] = True
                    found = np.flatnonzero(seen)
                    total[found] += 1
                    seen[found] = False
        if n:
            found = np.flatnonzero(total)
            yield batch_from([np.append(found, -1), np.append(total[found], n)], "feature int, n long")

    rows = docs.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # at most BUCKETS + 1 rows
    feature, n = found["feature"].to_numpy(), found["n"].to_numpy()
    frequencies = np.zeros(BUCKETS, np.int64)
    frequencies[feature[feature >= 0]] = n[feature >= 0]
    return int(n[feature < 0].sum()), frequencies


@dataclass(frozen=True)
class SparseTable:
    """The entries of a table BUCKETS x languages that are not 0, row by row."""

    starts: np.ndarray  # BUCKETS + 1: where the entries of a row begin
    columns: np.ndarray
    values: np.ndarray
    languages: int

    def sums(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of some rows, each as often as it is counted."""
        sizes = self.starts[features + 1] - self.starts[features]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[features] - ends + sizes, sizes)
        return np.bincount(self.columns[at], self.values[at] * np.repeat(counts, sizes), self.languages)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray | SparseTable  # BUCKETS x languages: what one n-gram adds to the scores, over the text's number of n-grams
    temperature: float


def _probabilities(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _leader_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    step = (BETA + np.sqrt(n)) / ALPHA + L2
    return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / step, 0.0).astype(z.dtype)


def _leader_state(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of the rows, their z and n for every class) by follow-the-regularised-leader."""
    features = np.unique(np.concatenate([f for f, _ in rows])) if rows else np.zeros(0, int)
    z, n = (np.zeros((len(features), k), np.float64 if k <= DENSE else np.float32) for _ in range(2))
    draw = np.random.default_rng(seed)
    for _ in range(PASSES):
        order = draw.permutation(len(rows))
        for start in range(0, len(order), STEP_ROWS):
            chosen = order[start : start + STEP_ROWS]
            touched, back = np.unique(np.concatenate([rows[i][0] for i in chosen]), return_inverse=True)
            x = np.zeros((len(chosen), len(touched)), z.dtype)
            x[np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen]), back] = np.concatenate([rows[i][1] for i in chosen])
            touched = np.searchsorted(features, touched)
            before, w = n[touched], _leader_weights(z[touched], n[touched])
            error = _probabilities(x @ w)
            error[np.arange(len(chosen)), y[chosen]] -= 1
            g = x.T @ error
            after = before + g * g
            z[touched] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
            n[touched] = after
    return features, z, n


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """BUCKETS x k weights from rows of (distinct features, values), by follow-the-regularised-leader."""
    features, z, n = _leader_state(rows, y, k, seed)
    w = np.zeros((BUCKETS, k))
    w[features] = _leader_weights(z, n)
    return w


def follow_leader_sparse(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, scale: np.ndarray, seed: int = 0) -> SparseTable:
    """The weights, each feature's times its scale, without those that are 0."""
    features, z, n = _leader_state(rows, y, k, seed)
    sizes, columns, values = np.zeros(BUCKETS, np.int64), [], []
    for start in range(0, len(features), 1024):
        part = slice(start, start + 1024)
        w = _leader_weights(z[part], n[part])
        row, column = np.nonzero(w)
        sizes[features[part]] = np.bincount(row, minlength=len(w))
        columns.append(column.astype(np.int32))
        values.append((w[row, column] * scale[features[part]][row]).astype(np.float32))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return SparseTable(starts, np.concatenate([*columns, np.zeros(0, np.int32)]), np.concatenate([*values, np.zeros(0, np.float32)]), k)


def fit_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores with the lowest loss on rows that the weights have not seen."""
    if not len(y):
        return 1.0
    choices = np.exp(np.linspace(-3, 3, 121))
    loss = [-np.log(np.maximum(_probabilities(scores / t)[np.arange(len(y)), y], 1e-12)).mean() for t in choices]
    return float(choices[int(np.argmin(loss))])


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Learn from the rows of `docs` with a text and a language. Without any, the model has no languages."""
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    sizes = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}  # a number per language
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), 1.0)
    total, frequencies = document_frequencies(named)
    inverse = np.log((1 + total) / (1 + frequencies)) + 1

    each = max(FIT_ROWS / len(languages), LANGUAGE_ROWS)
    shares = docs.sparkSession.createDataFrame([(v, min(1.0, each / n)) for v, n in sizes.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = named.join(F.broadcast(shares), "lang").filter(draw < F.col("share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = list(_row_counts(piece.column("text").to_pylist()))
                at = pa.array([f.tolist() for f, _ in found], pa.list_(pa.int32()))
                counts = pa.array([c.tolist() for _, c in found], pa.list_(pa.int32()))
                yield batch_from([piece.column("key").cast(pa.string()), piece.column("lang"), at, counts], _COUNTS)

    # Copies of one text are drawn together, so the sample is cut where they outnumber it.
    rows = sample.select(F.col("key").cast("string").alias("key"), "lang", "text").mapInArrow(count, _COUNTS)
    rows = rows.limit(int(2 * each * len(languages))).toArrow().sort_by("key")
    found = [_lists(rows[c]) for c in ("at", "counts")]
    x = [(f, c / max(1, c.sum()) * inverse[f] * SCALE) for f, c in zip(*found)]
    number = {v: i for i, v in enumerate(languages)}
    y = np.array([number[v] for v in rows["lang"].to_pylist()], int)
    kept_back = np.arange(len(y)) % 5 == 4
    kept_back &= np.isin(y, y[~kept_back])  # a language's only rows are learned from
    fitted, rest = [x[i] for i in np.flatnonzero(~kept_back)], np.flatnonzero(kept_back)
    if len(languages) <= DENSE:
        weights = follow_leader(fitted, y[~kept_back], len(languages))
        scores = [v @ weights[f] for f, v in (x[i] for i in rest)]
        model = (weights * inverse[:, None] * SCALE).astype(np.float32)
    else:
        model = follow_leader_sparse(fitted, y[~kept_back], len(languages), inverse * SCALE)
        scores = [model.sums(found[0][i], found[1][i]) / max(1, found[1][i].sum()) for i in rest]
    temperature = fit_temperature(np.array(scores).reshape(-1, len(languages)), y[kept_back])
    return LanguageModel(languages, model, temperature)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The values of each list."""
    return [v for c in column.chunks for v in np.split(c.flatten().to_numpy(), c.offsets.to_numpy()[1:-1] - c.offsets[0].as_py())] if len(column) else []


_COUNTS = "key string, lang string, at array<int>, counts array<int>"


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """(languages, calibrated probabilities) of some texts."""
    k = len(model.languages)
    sums, totals = np.zeros((len(texts), k)), np.zeros(len(texts), np.int64)
    if isinstance(model.table, np.ndarray):
        for features, rows in zip(*grams(texts)):
            if not len(features):
                continue
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            present = rows[first]
            totals[present] += np.diff(np.append(first, len(rows)))
            for c in range(k):
                sums[present, c] += np.add.reduceat(model.table[:, c][features], first, dtype=np.float64)
    else:
        for i, (features, counts) in enumerate(_row_counts(texts)):
            totals[i] = counts.sum()
            sums[i] = model.table.sums(features, counts)
    known = (totals > 0) & (k > 0)
    if not k:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    p = _probabilities(sums / np.maximum(totals, 1)[:, None] / model.temperature)
    best = p.argmax(axis=1)
    score = np.where(known, p[np.arange(len(p)), best], 0.0)
    return [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, known)], np.clip(score, 0.0, 1.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score` (0 to 1) added; `und` with score 0 for a null text or one without
    letters. Columns of these names are replaced."""
    name = unused(docs.columns, "guess")
    kept = [column_of(docs, c) for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(*kept, guesser(docs, model)(F.col(text)).alias(name)).select("*", f"{name}.*").drop(name)


def guesser(docs: DataFrame, model: LanguageModel):
    """A function of a text column that gives (lang_pred, score)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def guess(values: pa.Array) -> pa.Array:
        names, scores = [], []
        for piece in pieces(pa.RecordBatch.from_arrays([values], ["text"]), "text"):
            found, score = predict(sent.value, piece.column("text").to_pylist())
            names += found
            scores.append(score)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang_pred", "score"])

    return guess


def language_report(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per row of `docs`.

    Learned from rows whose crc32(doc_id) modulo 4 is not 2 and whose doc_id, text and lang are not null.
    Further columns are ignored; in an empty table, or one without languages, every text is `und`.
    """
    rows = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = fit_languages(rows.filter(~F.col("held_out")))
    return identify(rows.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.35, times: float = 1.4) -> DataFrame:
    """The documents whose language can be told: without null texts, texts without letters, and those whose
    best language is less likely than `least` and than `times` a blind guess among the languages.

    Where no language could be learned, only null texts and texts without letters go.
    """
    model = fit_languages(docs.filter(~held_out()))
    if not model.languages:  # one language, certain for every text with letters
        model = LanguageModel(["any"], np.zeros((BUCKETS, 1), np.float32), 1.0)
    least = min(least, times / len(model.languages))
    name = unused(docs.columns, "guess")
    named = docs.withColumn(name, guesser(docs, model)(F.col("text")))
    # The guess has the name `und` and score 0 for a text without letters alone.
    return named.filter((F.col(name)["score"] > 0) & (F.col(name)["score"] >= least)).drop(name)
