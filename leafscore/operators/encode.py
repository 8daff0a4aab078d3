"""Vocabulary, padded token sequences, and masked-language-model examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafscore.functions.text import first_tokens, hash_number, seeded_hash, strip_newlines, tokens
from leafscore.operators.rank import global_rank
from leafscore.sources.tables import read_lines

# Reserved token ids, sequence lengths, and the label of a token that is not predicted.
BOS, PAD, EOS, UNK = 0, 1, 2, 3
FIRST_ID = 4
MAX_LEN = 248
TYPED_MAX_LEN = 250
IGNORED = -100


def build_vocab(df: DataFrame, text: str, size: int | None = None) -> DataFrame:
    """Rows (token, n, token_id), ids from 4 in order of falling count, then token; the first `size`."""
    pieces = df.select(F.explode(F.split(text, r"\s+")).alias("token")).filter(F.col("token") != "")
    counts = pieces.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    if size is not None:
        counts = counts.orderBy(F.desc("n"), "token").limit(size)  # a top-n: only these are numbered
    ranked = global_rank(counts, [F.desc("n"), "token"], name="token_id")
    return ranked.withColumn("token_id", F.col("token_id") + FIRST_ID)


def token_ids(df: DataFrame, key: str, words: Column, vocab: DataFrame) -> DataFrame:
    """Rows (key, ids): the tokens' ids in text order, `UNK` for a token outside the vocabulary.

    The single tokens are joined to the vocabulary (Spark sends it to the tasks where it is small) and
    put together again by a number given to the row, so rows may share a key or have none.
    """
    present = F.col("__words").isNotNull().alias("__present")
    rows = df.select(F.col(key).alias("__key"), words.alias("__words"), F.monotonically_increasing_id().alias("__row"))
    single = rows.select("__row", "__key", present, F.posexplode_outer("__words").alias("__pos", "token"))
    found = single.join(vocab.select("token", F.col("token_id").cast("int")), "token", "left")
    pair = F.when(F.col("__pos").isNotNull(), F.struct("__pos", F.coalesce("token_id", F.lit(UNK)).alias("id")))
    together = found.groupBy("__row", "__key", "__present").agg(F.array_sort(F.collect_list(pair)).alias("__pairs"))
    ids = F.when(F.col("__present"), F.transform("__pairs", lambda p: p["id"]))
    return together.select(F.col("__key").alias(key), ids.alias("ids"))


def encode(
    df: DataFrame,
    key: str,
    text: str,
    vocab: DataFrame,
    length: int | None = MAX_LEN,
    pad: int = PAD,
    type_ids: bool = False,
    pad_out: bool = True,
) -> DataFrame:
    """Rows (key, input_ids, attention_mask[, token_type_ids]).

    `bos`, up to length - 2 tokens, `eos`, then padding up to `length`. With `type_ids` newlines are
    removed first and a row of zeros is added. Without `length` the whole text is kept, unpadded.
    """
    source = strip_newlines(F.col(text)) if type_ids else F.col(text)
    words = tokens(source) if length is None else first_tokens(source, length - 2)
    ids = token_ids(df, key, words, vocab)
    sequence = F.concat(F.array(F.lit(BOS)), F.col("ids"), F.array(F.lit(EOS)))
    rows = ids.select(key, sequence.alias("__seq"))
    used = F.array_repeat(F.lit(1), F.size("__seq"))
    if length is None or not pad_out:
        return rows.select(key, F.col("__seq").alias("input_ids"), used.alias("attention_mask"))
    free = F.lit(length) - F.size("__seq")
    columns = [
        F.concat("__seq", F.array_repeat(F.lit(pad), free)).alias("input_ids"),
        F.concat(used, F.array_repeat(F.lit(0), free)).alias("attention_mask"),
    ]
    if type_ids:
        columns.append(F.array_repeat(F.lit(0), length).alias("token_type_ids"))
    return rows.select(key, *columns)


def read_blocks(spark: SparkSession, path: str, vocab: DataFrame, block: int = 256) -> DataFrame:
    """Rows (line_id, input_ids, attention_mask): a corpus file's lines, cut to `block` and not padded."""
    return encode(read_lines(spark, path), "line_id", "line", vocab, block, pad_out=False)


def mlm_mask(df: DataFrame, key: str, ids: str, mask_id: int, vocab_size: int, seed, p: float = 0.15) -> DataFrame:
    """Add `masked_ids` and `labels`: a share p of the non-special tokens is to be predicted.

    Of those, 8 in 10 become `mask_id`, 1 in 10 a random id below `vocab_size`, 1 in 10 stay. The
    draws hash seed, key and position, so they repeat on every run and retry.
    """

    def below(digest: Column, start: int, share: float) -> Column:
        """Are the eight hex digits from `start` below that share of all values? Compared as text."""
        return F.substring(digest, start, 8) < F.lit(f"{int(share * 2**32):08x}")

    def drawn(token: Column, pos: Column) -> Column:
        digest = seeded_hash(seed, F.col(key), pos)
        plain = (token >= FIRST_ID) & (token != mask_id)
        return F.struct(token.alias("id"), F.when(plain & below(digest, 1, p), digest).alias("digest"))

    def replaced(t: Column) -> Column:
        digest, token = t["digest"], t["id"]
        other = (hash_number(digest, 17) % vocab_size).cast("int")
        swapped = F.when(below(digest, 9, 0.8), F.lit(mask_id)).when(below(digest, 9, 0.9), other)
        return F.when(digest.isNotNull(), swapped.otherwise(token)).otherwise(token)

    def label(t: Column) -> Column:
        return F.when(t["digest"].isNotNull(), t["id"]).otherwise(IGNORED)

    rows = df.withColumn("__draws", F.transform(ids, drawn))
    rows = rows.withColumn("masked_ids", F.transform("__draws", replaced))
    return rows.withColumn("labels", F.transform("__draws", label)).drop("__draws")
