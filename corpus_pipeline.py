"""From raw documents to token ids: the stages of a training corpus.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of documents (the last adds the ids). Stages are written as Parquet
below the shared checkpoint folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import bpe, langid, mixing, near_texts, repeats
from stratum.llm.common import stored, table, with_file_order

#: Texts with less than this part of known n-grams are in none of the languages.
MIN_SCORE = 0.2
#: Shortest repeated string that goes: passages of some 50 words and more.
PASSAGE_BYTES = 250
#: Encoded words that a worker keeps, about 20 MB.
MEMO_WORDS = 80_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the labels of documents that are not held
    out; texts in no known language go."""
    held_out = F.coalesce(langid.held_out(), F.lit(False))
    model = langid.train(docs.where(~held_out))
    named = langid.predict(docs, model, out="__lang", score="__score")
    return named.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= MIN_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicate texts stays."""
    return near_texts.without_copies(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a string of PASSAGE_BYTES that starts anywhere else go
    from the texts; every document stays, n_chars follows its text."""
    left = repeats.without_repeats(docs, length=PASSAGE_BYTES)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's weight asks
    for: some sources repeat (three times at most), some are cut down. Written,
    the order is that of the part files and of the rows in them."""
    return mixing.mixed(docs, mixing.curriculum)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, their number, and whether decoding them
    gives the text's bytes. Sorted by train_part and train_row, the rows are in
    the training order that the mix was written in; a document's n-th row in it
    is its n-th pass."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    # a worker keeps its memo between tasks, also while it runs other stages: a small one here
    placed = with_file_order(docs, "train_part", "train_row")
    encoded = bpe.encode(placed, ranks, public_tokenizers.PATTERN, memo_words=MEMO_WORDS)
    encoded = bpe.decode(encoded, ranks, out="__bytes")
    same = F.col("__bytes") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    added = ("train_part", "train_row", "n_tokens", "round_trip", "token_ids")
    encoded = encoded.withColumn("n_tokens", F.size("token_ids").cast("bigint")).withColumn("round_trip", same)
    return encoded.select(*(c for c in docs.columns if c not in ("text", *added)), *added)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("repeated_strings", repeated_strings),
    ("mix", mix),
    ("byte_bpe", encode),
]

#: SQL can express neither the signatures nor the merges; tests/llm compares
#: the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
