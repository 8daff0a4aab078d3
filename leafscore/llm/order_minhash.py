"""Near-duplicate documents by Order MinHash.

Words are lower-cased runs of letters and digits. A document's elements are its shingles of `SHINGLE`
words, each labelled with how often it has come before. A sketch takes the `ELEMENTS` elements with the
lowest hashes, keeps them in text order and hashes the sequence; `SKETCHES` sketches are taken, each a
bucket of its own. Elements in another order give another sketch, so sketches follow edit similarity.

Two documents are near-duplicates if an alignment of their labelled shingles matches m of them with
m / (n_a + n_b - m) >= `SIMILARITY`: the Jaccard similarity of shingles that keep their order. A pair
at the threshold shares no sketch with probability (1 - 0.8**3)**18 = 3e-6.

Work on groups of any size:

* Equal texts are one node (an aggregate that combines before the shuffle).
* Each bucket pairs its members with one of them only, its centre, which is linear. Verified pairs are links;
  components of links are the classes.
* A member that is not in the class of its bucket's centre is known by its difference:
  the elements that it or the centre has, but not both. The alignment distance n_a + n_b - 2m is at least
  the number of elements that one text alone has, so two similar texts differ in at most `_limit` elements,
  and so do their differences. A member further than that from the centre therefore shares at least half of
  what both differences hold beyond the limit with every text similar to it, and one of them is among the
  first of both, rarest first (prefix filter). These rare elements are buckets in turn: each pairs its members
  with the one nearest to the centre, and what that has not brought into one class is joined. Texts that
  merely share a template differ from it in places of their own and seldom meet.
* Members with the centre's elements in an order of their own have no such difference. They are compared with
  the bucket's members of other classes.
* Both joins leave out pairs that bounds from distances and from parity bitmaps of the elements show to be apart:
  each bit in which two bitmaps differ stands for an element that one text alone has.

No pair that could join two classes is left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafscore.llm.buffers import mix, pieces, running, runs, spaced, span_hash, text_bytes, window_hash
from leafscore.llm.components import components
from leafscore.llm.repeats import changes
from leafscore.llm.store import batch_from, batch_of, column_of, tidied, unused, written

SHINGLE = 5
SIMILARITY = 0.8
ELEMENTS = 3
SKETCHES = 18

_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

# Lower case for ASCII letters; 0 for a byte that is no part of a word.
_FOLDED = np.zeros(256, np.uint8)
for _low, _high, _shift in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
    _FOLDED[_low : _high + 1] = np.arange(_low, _high + 1) + _shift

# Numbers of 64 bits in the parity bitmap of a text's elements.
BITMAP = 32

_SKETCH = "doc_id long, s1 long, s2 long, n int, keys array<long>, bits array<long>"


def folded_words(batch: pa.RecordBatch, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the folded words, offsets of each row's words)."""
    data, starts = spaced(*text_bytes(batch.column(text)))
    data = _FOLDED[data]
    begin, end = runs(data > 0)
    return span_hash(running(_SYMBOLS[data]), begin, end), np.append(np.searchsorted(begin, starts), len(begin))


def labelled(words: np.ndarray) -> np.ndarray:
    """The document's shingles, each with the number of times it has come before. Fewer words than a
    shingle are one shingle."""
    if not len(words):
        return words
    hashes = window_hash(running(words), min(SHINGLE, len(words)))
    order = np.argsort(hashes, kind="stable")
    first = changes(hashes[order])
    start = np.flatnonzero(first)
    times = np.empty(len(hashes), np.uint64)
    times[order] = np.arange(len(hashes)) - start[np.cumsum(first) - 1]
    return mix(hashes + times * np.uint64(0x9E3779B97F4A7C15))


def sketch_keys(elements: np.ndarray) -> np.ndarray:
    """One bucket key per sketch."""
    if not len(elements):
        return np.zeros(0, np.int64)
    ranks = mix(elements[None, :] ^ _SEEDS[:, None])
    kept = min(ELEMENTS, len(elements))
    lowest = np.sort(np.argpartition(ranks, kept - 1, axis=1)[:, :kept], axis=1)  # in text order
    key = _SEEDS.copy()
    for chosen in elements[lowest].T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + chosen)
    return key.view(np.int64)


def parity_bitmap(elements: np.ndarray) -> np.ndarray:
    """For each of its bits, whether an odd number of elements falls on it."""
    odd = np.bincount((elements & np.uint64(64 * BITMAP - 1)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, s1, s2, n, keys, bits): 128 bits of the word sequence, its number of shingles, bucket
    keys and parity bitmap.

    A text without words has the hash of its bytes and no keys.
    """

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, offsets = folded_words(piece)
                data, ends = text_bytes(piece.column("text"))
                raw = span_hash(running(_SYMBOLS[data]), ends[:-1], ends[1:])
                s1 = span_hash(running(words), offsets[:-1], offsets[1:])
                s2 = span_hash(running(mix(words)), offsets[:-1], offsets[1:])
                empty = np.diff(offsets) == 0
                s1[empty], s2[empty] = raw[empty], 0
                elements = [labelled(words[a:b]) for a, b in zip(offsets, offsets[1:])]
                keys = [sketch_keys(e) for e in elements]
                at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(keys)))
                n = np.array([len(e) for e in elements], np.int32)
                ends = pa.array(np.arange(len(n) + 1, dtype=np.int32) * BITMAP)
                bits = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([parity_bitmap(e) for e in elements])))
                yield batch_from([piece.column("doc_id"), s1.view(np.int64), s2.view(np.int64), n, lists, bits], _SKETCH)

    rows = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    return written(rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(of_texts), _SKETCH), "sketches")


def matched(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Elements that an alignment within the band matches: the longest rising run of common places."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    tails: list[int] = []
    for place in j[np.argsort(i)].tolist():
        at = bisect_left(tails, place)
        if at == len(tails):
            tails.append(place)
        else:
            tails[at] = place
    return len(tails)


_PAIRS = "a long, b long, d long, similar boolean"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        kept: dict = {}
        for i in range(batch.num_rows):
            sides = []
            for c in ("text_a", "text_b"):
                text = batch.column(c)[i].as_py()
                if text not in kept:
                    if len(kept) > 64:  # a bucket's centre comes again and again
                        kept.clear()
                    kept[text] = labelled(folded_words(batch.slice(i, 1), c)[0])
                sides.append(kept[text])
            a, b = sides
            n = len(a) + len(b)
            band = n // 2  # beyond it only this bound of the distance is known
            m = matched(a, b, band)
            similar = m >= SIMILARITY * (n - m) - 1e-9
            distance = n - 2 * m if similar else min(n - 2 * m, band + 1)
            rows.append((batch.column("a")[i].as_py(), batch.column("b")[i].as_py(), distance, similar))
        if rows:
            yield batch_of(rows, _PAIRS)


def _with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs of ids (a, b) with the texts of both. Texts are joined by sorted shuffles whatever their number:
    what is moved then grows with them."""
    pairs = written(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().hint("merge")
    texts = written(docs.select(F.col("doc_id").cast("long"), "text").filter("text IS NOT NULL").join(ids, "doc_id", "left_semi"), "texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (a, b, d, similar) for distinct pairs of ids, by alignment of their texts."""
    return written(_with_texts(pairs, docs).mapInArrow(tidied(_verify), _PAIRS), "verified")


_DIFFERENCES = "a long, b long, n_a int, n_b int, apart array<long>"


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, held = [], 0
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            a, b = (labelled(folded_words(one, c)[0]) for c in ("text_a", "text_b"))
            apart = np.setxor1d(a, b, assume_unique=True).view(np.int64)
            rows.append((one.column("a")[0].as_py(), one.column("b")[0].as_py(), len(a), len(b), apart))
            held += len(apart)
            if held > 1 << 20:
                yield batch_of(rows, _DIFFERENCES)
                rows, held = [], 0
        if rows:
            yield batch_of(rows, _DIFFERENCES)


def differences(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (a, b, n_a, n_b, apart): the elements that one text of a pair alone has, and how many each has."""
    return written(_with_texts(pairs, docs).mapInArrow(tidied(_differ), _DIFFERENCES), "differences")


def _limit(n: Column) -> Column:
    """The largest distance of similar documents with n shingles together: m >= s / (1 + s) * n."""
    return n * (1 - 2 * SIMILARITY / (1 + SIMILARITY)) + 1e-6


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, class_id), one per row of `docs`: the lowest doc_id among the document's copies,
    near copies, their near copies, and so on.

    A null text is alone in its class; texts without words are copies if they are equal, the empty text
    included. Rows that share a doc_id are one document. A row without doc_id has no class (null). Further
    columns are ignored; an empty table gives an empty result.
    """
    sketched = sketches(docs)
    lowest = F.min(F.struct("doc_id", "n", "keys", "bits")).alias("low")
    nodes = sketched.groupBy("s1", "s2").agg(lowest).select("s1", "s2", "low.*")
    nodes = written(nodes.select("s1", "s2", F.col("doc_id").alias("rep"), "n", "keys", "bits"), "nodes")
    members = nodes.select(F.explode("keys").alias("key"), "rep", "n")

    # A bucket's centre is the member whose buckets hold most: it has the sketches that most of them have.
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    shared = written(members.join(counts, "key"), "shared")
    scored = shared.join(shared.groupBy("rep").agg(F.sum("times").alias("score")), "rep")
    best = scored.groupBy("key").agg(F.max(F.struct("score", F.bitwise_not("rep").alias("turned"), "n")).alias("best"))
    centres = best.select("key", F.struct(F.bitwise_not("best.turned").alias("rep"), F.col("best.n").alias("n")).alias("low"))
    starred = written(shared.select("key", "rep", "n").join(centres, "key"), "buckets")
    pairs = starred.select(F.least("rep", "low.rep").alias("a"), F.greatest("rep", "low.rep").alias("b"), "n", F.col("low.n").alias("other"))
    alike = F.abs(F.col("n") - F.col("other")) <= _limit(F.col("n") + F.col("other"))
    pairs = pairs.filter((F.col("a") < F.col("b")) & alike).select("a", "b").distinct()
    compared = verified(pairs, docs)
    links = compared.filter("similar").select("a", "b")
    roots = components(links)

    # Further links tie whole classes together.
    across = _across_classes(starred, nodes, roots, compared, docs)
    merged = components(across).select(F.col("id").alias("root"), F.col("root").alias("final"))
    classes = nodes.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    classes = classes.select("s1", "s2", F.coalesce("root", "rep").alias("root")).join(merged, "root", "left")
    classes = classes.select("s1", "s2", F.coalesce("final", "root").alias("class"))
    found = sketched.join(classes, ["s1", "s2"]).groupBy("doc_id").agg(F.min("class").alias("class"))
    rows = docs.select(F.col("doc_id").cast("long"))
    return rows.join(found, "doc_id", "left").select("doc_id", F.coalesce("class", "doc_id").alias("class_id"))


def _bitmaps(nodes: DataFrame) -> DataFrame:
    return nodes.select("rep", *[F.col("bits")[i].alias(f"b{i}") for i in range(BITMAP)])


def _bits_apart() -> Column:
    """Bits in which the parity bitmaps of rows x and y differ: at most the elements that one text alone has."""
    return sum((F.bit_count(F.col(f"x.b{i}").bitwiseXOR(F.col(f"y.b{i}"))) for i in range(BITMAP)), F.lit(0))


def _across_classes(starred: DataFrame, nodes: DataFrame, roots: DataFrame, compared: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of members of a bucket that its centre has not brought into one class."""
    of_rep = roots.select(F.col("id").alias("rep"), "root")
    of_low = roots.select(F.col("id").alias("centre"), F.col("root").alias("centre_root"))
    seen = compared.groupBy("a", "b").agg(F.min("d").alias("d"))
    seen = seen.selectExpr("a AS centre", "b AS rep", "d").unionAll(seen.selectExpr("b AS centre", "a AS rep", "d"))
    rows = starred.select("key", "rep", "n", F.col("low.rep").alias("centre"), F.col("low.n").alias("centre_n"))
    rows = rows.join(of_rep, "rep", "left").join(of_low, "centre", "left").join(seen, ["centre", "rep"], "left")
    # What is known of the distance to the bucket's centre: it, or the difference in length.
    least = F.when(F.col("rep") == F.col("centre"), 0).otherwise(F.coalesce("d", F.abs(F.col("n") - F.col("centre_n"))))
    most = F.when(F.col("rep") == F.col("centre"), 0).when(F.col("d").isNotNull() & (F.col("d") <= (F.col("n") + F.col("centre_n")) / 2), F.col("d"))
    rows = rows.select(
        "key",
        "rep",
        "centre",
        "n",
        F.coalesce("root", "rep").alias("class"),
        F.coalesce("centre_root", "centre").alias("low_class"),
        least.cast("long").alias("least"),
        F.coalesce(most.cast("long"), F.col("n") + F.col("centre_n")).alias("most"),
    )
    rows = written(rows, "members")
    apart = rows.filter(F.col("class") != F.col("low_class"))
    near = rows.join(apart.select("key").distinct(), "key", "left_semi")
    stars = near.filter("rep <> centre").groupBy(F.col("centre").alias("a"), F.col("rep").alias("b")).agg(F.min("class").alias("class"), F.max(F.col("class") != F.col("low_class")).alias("outside"))
    stars = written(stars, "stars")
    apart_by = differences(stars.select("a", "b"), docs)
    found = _by_difference(apart_by.join(stars, ["a", "b"]), nodes, compared, docs)

    settled = F.size("apart") > _limit(F.col("n_a") + F.col("n_b"))
    alike = apart_by.filter(~settled).select(F.col("a").alias("centre"), F.col("b").alias("rep")).distinct()
    turned = written(apart.join(alike, ["centre", "rep"], "left_semi"), "turned")
    near = near.join(turned.select("key").distinct(), "key", "left_semi")
    bits = _bitmaps(nodes)
    x, y = turned.join(bits, "rep").alias("x"), written(near.join(bits, "rep"), "near").alias("y")
    far = F.greatest(F.col("x.least") - F.col("y.most"), F.col("y.least") - F.col("x.most"), F.abs(F.col("x.n") - F.col("y.n")))
    possible = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") != F.col("y.class"))
    possible &= (far <= _limit(F.col("x.n") + F.col("y.n"))) & (_bits_apart() <= _limit(F.col("x.n") + F.col("y.n")))
    pairs = x.join(y, possible).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    more = verified(pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti"), docs).filter("similar")
    found = found.unionAll(more.select("a", "b"))
    for side in ("a", "b"):
        of = roots.select(F.col("id").alias(side), F.col("root").alias(f"root_{side}"))
        found = found.join(of, side, "left")
    return found.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))


def _by_difference(rows: DataFrame, nodes: DataFrame, compared: DataFrame, docs: DataFrame) -> DataFrame:
    """Similar pairs (a, b) of different classes among the members around each centre, one of which is outside
    the centre's class and further from it than similar texts are.

    `rows` (a: centre, b: member, n_a, n_b, apart, class, outside). Let x be such a member, y any: with d_x and
    d_y elements in their differences and L the limit for both, they share t >= (d_x + d_y - L) / 2 of them, and
    |d_x - d_y| <= L. So t >= (d_x - limit(n_x + n_centre)) / 2, t >= d_x - n_x / 4 (a similar text has at most
    n_x / 0.8 elements); and for y, whose partner is beyond the limit, t >= (d_y - growth) / 2 where growth is
    what y's length beyond the centre's adds to L, and t >= d_y - n_y / 4.
    """
    share = 1 - 2 * SIMILARITY / (1 + SIMILARITY)
    widest = (1 + 1 / SIMILARITY) * share
    size = F.size("apart")

    def first(*bounds: Column) -> Column:
        """How many elements, rarest first, hold one of any t shared ones."""
        return size - F.greatest(F.lit(1), *[F.ceil(b - 1e-4) for b in bounds]) + 1

    as_x = first((size - _limit(F.col("n_a") + F.col("n_b"))) / 2, size - widest * F.col("n_b"))
    as_y = first((size - share * F.greatest(F.lit(0), F.col("n_b") - F.col("n_a"))) / 2, size - widest * F.col("n_b"))
    beyond = F.col("outside") & (size > _limit(F.col("n_a") + F.col("n_b")))
    rows = rows.select("a", "b", "class", F.col("n_b").alias("n"), size.alias("d"), F.xxhash64("apart").alias("row"), "apart", beyond.alias("is_x"), F.when(beyond, as_x).otherwise(0).alias("as_x"), as_y.alias("as_y"))
    single = written(rows.withColumn("element", F.explode("apart")).drop("apart"), "elements")
    # An element of one difference alone meets none, but it counts among the first.
    counts = single.groupBy("a", "element").agg(F.count(F.lit(1)).alias("times"))
    place = F.row_number().over(Window.partitionBy("a", "b", "row").orderBy("times", "element"))
    ranked = single.join(counts, ["a", "element"]).withColumn("place", place)
    kept = ranked.filter((F.col("times") > 1) & (F.col("place") <= F.greatest("as_x", "as_y")))
    kept = kept.select("a", "element", "b", "class", "n", "d", (F.col("place") <= F.col("as_x")).alias("is_x"), (F.col("place") <= F.col("as_y")).alias("is_y"))
    kept = written(kept, "rare")

    lows = kept.groupBy("a", "element").agg(F.min(F.struct("d", "b", "class", "n")).alias("low"), F.max("is_x").alias("any"))
    starred = kept.join(lows.filter("any AND low.b IS NOT NULL").drop("any"), ["a", "element"])

    def close(n: Column, d: Column) -> Column:
        return F.greatest(F.abs(F.col("n") - n), F.abs(F.col("d") - d)) <= _limit(F.col("n") + n)

    to_low = starred.filter((F.col("class") != F.col("low.class")) & close(F.col("low.n"), F.col("low.d")))
    pairs = to_low.select(F.least("b", "low.b").alias("a"), F.greatest("b", "low.b").alias("b")).distinct()
    checked = verified(pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti"), docs)
    links = checked.filter("similar").select("a", "b")

    # What is outside that one's class still meets the other members.
    ends = [kept.select(F.col("b").alias(side), F.col("class").alias(f"class_{side}")).distinct() for side in ("a", "b")]
    tied = links.join(ends[0], "a").join(ends[1], "b")
    merged = components(tied.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    of = merged.select(F.col("id").alias("class"), F.col("root").alias("final"))
    now = kept.join(of, "class", "left").withColumn("class", F.coalesce("final", "class")).drop("final")
    low_of = merged.select(F.col("id").alias("low_class"), F.col("root").alias("low_final"))
    low = lows.filter("any").select("a", "element", F.col("low.class").alias("low_class")).join(low_of, "low_class", "left")
    low = low.select("a", "element", F.coalesce("low_final", "low_class").alias("low_class"))
    now = written(now.join(low, ["a", "element"]), "meeting")
    others = now.filter(F.col("class") != F.col("low_class"))
    now = now.join(others.select("a", "element").distinct(), ["a", "element"], "left_semi")
    bits = _bitmaps(nodes).withColumnRenamed("rep", "b")
    x, y = others.join(bits, "b").alias("x"), written(now.join(bits, "b"), "others").alias("y")
    met = (F.col("x.a") == F.col("y.a")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.class") != F.col("y.class"))
    met &= (F.col("x.is_x") & F.col("y.is_y")) | (F.col("x.is_y") & F.col("y.is_x"))
    met &= F.greatest(F.abs(F.col("x.n") - F.col("y.n")), F.abs(F.col("x.d") - F.col("y.d")), _bits_apart()) <= _limit(F.col("x.n") + F.col("y.n"))
    pairs = x.join(y, met).select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct()
    known = compared.select("a", "b").unionAll(checked.select("a", "b"))
    return links.unionAll(verified(pairs.join(known, ["a", "b"], "left_anti"), docs).filter("similar").select("a", "b"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the lowest doc_id. Rows without doc_id stay.

    A row is known by 64 bits of its id and text, so rows that share an id are judged each by its text; of rows
    with equal id and text one stays. A null text is nobody's copy. Columns of any name are kept as they are;
    an empty table gives an empty result.
    """
    key = unused(docs.columns, "key")
    keyed = docs.filter("doc_id IS NOT NULL").withColumn(key, F.xxhash64("doc_id", "text"))
    classes = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text")).distinct()
    ids = keyed.select(F.col(key).alias("row"), F.col("doc_id").alias("id"))
    lowest = classes.join(ids, classes["doc_id"] == ids["row"]).groupBy("class_id").agg(F.min(F.struct("id", "row")).alias("low"))
    kept = keyed.join(lowest.select(F.col("low.row").alias(key)), key, "left_semi").dropDuplicates([key])
    return kept.select(*(column_of(kept, c) for c in docs.columns)).unionAll(docs.filter("doc_id IS NULL"))
