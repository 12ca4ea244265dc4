"""Byte-level BPE and token counts against the tokenizer libraries."""

import json
import random
import sys

import public_tokenizers
import pytest
import tiktoken
from brute import sha
from conftest import SF_SMALL
from tokenizers import Tokenizer

from stratum.llm import bpe, queries, token_count

ODD = [
    (-1, None), (-2, ""), (-3, "a" * 5000), (-4, "   x\x1c\x1d y\u0085z  \n\n  tail  "),
    (-5, "日本語テキスト" * 300 + "🙂🙃 don't I'LL we've ٣٤ Ⅷ ²"),
    (-6, "\\### x <|endoftext|> y<|startoftext|><|endoftext|>I'M <|ENDOFTEXT|>"),
    (-7, "᠎ ﻿​ á ʰ H̱ İ'S ǅ ẞ"), (-7, "᠎ ﻿​ á ʰ H̱ İ'S ǅ ẞ"), (-8, "word " * 30000),
]


def fuzz(n):
    rng = random.Random(5)
    pick = [lambda: rng.randrange(32, 127), lambda: rng.randrange(128, 0x3000), lambda: rng.randrange(0x300, 0x370),
            lambda: rng.randrange(0x10000, 0x1F000), lambda: 39, lambda: 32, lambda: 10]
    return [(-100 - i, "".join(chr(rng.choice(pick)()) for _ in range(rng.randrange(1, 40)))) for i in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    return given.unionByName(spark.createDataFrame(ODD + fuzz(2000), "doc_id bigint, text string"))


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_ids_equal_the_library_and_decode_back(docs, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.token_ids == library.encode_ordinary(r.text or ""), r.doc_id
        assert bytes(r.decoded) == (r.text or "").encode(), r.doc_id


def test_long_words_merge_as_short_ones(ranks):
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    for n in (2, 47, 48, 49, 200, 3000):
        word = "".join(rng.choice("abcdeéあ ") for _ in range(n))
        assert bpe.merge_word(word.encode(), ranks) == library.encode_ordinary(word)


def test_memo_bound_and_clashing_names(spark, ranks):
    df = spark.createDataFrame([(1, "one two three one", "x", 5)], "doc_id int, text string, token_ids string, decoded int")
    out = bpe.encode(df, ranks, public_tokenizers.PATTERN, memo_words=1)
    assert out.columns == ["doc_id", "text", "decoded", "token_ids"]
    assert bpe.decode(out, ranks).columns == ["doc_id", "text", "decoded", "token_ids"]
    assert bytes(bpe.decode(out, ranks).first().decoded) == b"one two three one"


def test_query_op1(spark, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries.op1_byte_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())


def test_counts_equal_the_library(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for r in token_count.count_tokens(docs, path, frequent=500, cache_words=50).collect():
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids), r.doc_id


def test_caches_are_bounded_by_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    splitter = token_count.splitter_spec(json.loads(spec)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
    count = token_count.PieceCounter(spec, splitter, {"the": 1}, limit_bytes=20_000)
    library, rng = Tokenizer.from_file(path), random.Random(3)
    for n in (5, 30, token_count.LONGEST, token_count.LONGEST + 1, 1024):
        text = " ".join("".join(rng.choice("abcdeé") for _ in range(n)) for _ in range(400))
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids)
        held = {w for w in count.known if w != "the"}
        assert sum(sys.getsizeof(w) + token_count.ENTRY_BYTES for w in held) <= 20_000
        assert max(map(len, held)) <= token_count.LONGEST and count.known["the"] == 1


def test_frequent_words_are_the_patterns_matches(spark):
    rows = [(i, "The cat, the dog. " + f"rare{i} " + "x" * 500) for i in range(200)]
    df = spark.createDataFrame(rows + [(-1, None), (-2, "")], "doc_id int, text string")
    got = token_count.frequent_words(df, r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", n=6)
    assert set(got[:6]) >= {"the", "cat", "dog", ",", "."} and "x" * 500 not in got


def test_query_op3(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries.op3_token_count(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_empty_tables(spark, ranks):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(none, ranks, public_tokenizers.PATTERN), ranks).count() == 0
    assert token_count.count_tokens(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
