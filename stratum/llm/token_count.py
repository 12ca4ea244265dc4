"""Exact token counts by a map-side two-tier lookup.

Tier 1 is a compact table from frequent pre-tokens to their number of tokens:
the most frequent matches of the tokenizer's own pattern in all documents,
punctuation and digits included, are found by mergeable sketches, encoded once
on the driver and broadcast (``frequent`` entries of at most ``LONGEST``
characters, so 6 MB at the very most and about 1 MB in practice). Tier 2 is a
cache in each worker: a pre-token missing in tier 1 is encoded there by the
tokenizer's own model and remembered; the cache is emptied at ``cache_words``
entries or ``cache_bytes`` bytes, and longer pre-tokens than ``LONGEST`` are
never kept, so a worker's memory has a bound that no text moves. No pre-token
is ever shuffled, and the table only steers speed: counts are the library's,
whatever it holds.

Defined results: null text counts as empty (0 bytes, 0 tokens); special
strings inside texts are one token each, as the library's default; whole texts
are counted; repeated rows give repeated rows; every input column is passed
through, but an input column named like the output is replaced.
"""

from __future__ import annotations

import hashlib
import json
import math
import sys
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import append_column, text_slices, with_field, worker_cache
from stratum.llm.words import WordSplitter, splitter_spec

#: Entries of the broadcast table.
FREQUENT = 20_000
#: Entries of a worker's cache before it is emptied.
CACHE_WORDS = 800_000
#: Bytes of a worker's cache before it is emptied.
CACHE_BYTES = 150 << 20
#: Characters of the longest pre-token that a table or cache keeps.
LONGEST = 64
#: Bytes of a cache entry beyond its string: a slot of the table and a number.
ENTRY_BYTES = 110


def frequent_words(docs: DataFrame, pattern: str, text: str = "text", n: int = FREQUENT) -> list[str]:
    """About the ``n`` most frequent matches of ``pattern`` in all lower-cased
    texts, from sketches of bounded size. Sketches are merged in two steps, so
    no task merges those of all others."""
    tasks = docs.rdd.getNumPartitions()
    matches = F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), F.lit(0))
    words = docs.select(
        F.expr(f"pmod(spark_partition_id(), {max(1, math.isqrt(tasks))})").alias("part"), F.explode(matches).alias("word")
    ).where(F.length("word").between(1, LONGEST))
    # with twice the entries a sketch gives back less than half of the n words
    tops = words.groupBy("part").agg(F.expr(f"approx_top_k(word, {n}, {4 * n})").alias("top"))
    rows = (
        tops.select(F.explode("top").alias("t"))
        .groupBy(F.col("t.item").alias("word"))
        .agg(F.sum("t.count").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(n)
        .collect()
    )
    return [r["word"] for r in rows]


class _Counter(dict):
    """Pre-token -> number of tokens; misses are encoded and remembered."""

    def __init__(self, tokenizer, frequent: dict[str, int], limit: int, limit_bytes: int):
        from tokenizers import pre_tokenizers

        super().__init__(frequent)
        self.frequent, self.limit, self.limit_bytes, self.bytes = frequent, limit, limit_bytes, 0
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.tokenize = tokenizer.model.tokenize

    def __missing__(self, word: str) -> int:
        n = sum(len(self.tokenize(piece)) for piece, _ in self.as_bytes(word))
        if len(word) <= LONGEST:
            self.bytes += sys.getsizeof(word) + ENTRY_BYTES
            if self.bytes > self.limit_bytes or len(self) >= len(self.frequent) + self.limit:
                self.clear()
                self.update(self.frequent)
                self.bytes = sys.getsizeof(word) + ENTRY_BYTES
            self[word] = n
        return n


class PieceCounter:
    """Counts a text's tokens from its pre-tokens' counts."""

    def __init__(
        self, spec: str, splitter, frequent: dict[str, int], limit: int = CACHE_WORDS, limit_bytes: int = CACHE_BYTES
    ):
        import regex
        from tokenizers import Tokenizer

        data = json.loads(spec)
        tokenizer = Tokenizer.from_str(spec)
        steps = data["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[1]["use_regex"] or not steps[0]["invert"]:
            raise ValueError("expected a tokenizer that keeps a pattern's matches and maps their bytes")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
            raise ValueError("added tokens must match plainly in the raw text")
        special = sorted((t["content"] for t in data["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = WordSplitter(splitter)
        self.normalize = tokenizer.normalizer.normalize_str
        self.known = _Counter(tokenizer, frequent, limit, limit_bytes)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self.special.split(text) if self.special else [text]
        known = self.known
        return len(pieces) - 1 + sum(
            sum(map(known.__getitem__, self.words(self.normalize(piece)))) for piece in pieces if piece
        )


def _count_batches(batches, *, shared, text: str, out: str, limits: tuple[int, int]):
    import pyarrow as pa

    spec, splitter, frequent = shared.value
    name = hashlib.sha256(repr((spec, sorted(frequent.items()), limits)).encode()).hexdigest()
    count = worker_cache(f"pieces-{name}", lambda: PieceCounter(spec, splitter, frequent, *limits))
    for batch in batches:
        column = batch.column(text)
        for start, stop in text_slices(column):
            counts = [count(x) for x in column.slice(start, stop - start).to_pylist()]
            yield append_column(batch.slice(start, stop - start), out, pa.array(counts, pa.int64()))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    out: str = "n_tokens",
    frequent: int = FREQUENT,
    cache_words: int = CACHE_WORDS,
    cache_bytes: int = CACHE_BYTES,
) -> DataFrame:
    """``docs`` with ``out``: the number of tokens of each whole text."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    pattern = json.loads(spec)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    splitter = splitter_spec(pattern)
    count = PieceCounter(spec, splitter, {})
    lengths = {w: count.known[w] for w in frequent_words(docs.select(text), pattern, text, frequent)}
    shared = docs.sparkSession.sparkContext.broadcast((spec, splitter, lengths))
    run = partial(_count_batches, shared=shared, text=text, out=out, limits=(cache_words, cache_bytes))
    return docs.mapInArrow(run, with_field(docs.schema, out, T.LongType()))
