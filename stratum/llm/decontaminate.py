"""Benchmark decontamination: one Aho-Corasick automaton over test texts.

Test questions and answers are normalised (A-Z to lower case; words are runs of
ASCII letters, digits and non-ASCII characters) and cut into windows of
``window`` consecutive words; a shorter text is one window. All windows go into
one Aho-Corasick automaton whose alphabet is the test vocabulary, so it has at
most ``window`` nodes for each word of the test set. Each document is scanned
once, word by word; every occurrence of every window is found, and the hit
words are mapped back to places in the original text.

No document is shuffled: the normalised test words are broadcast and each
worker builds the automaton once. Its size is bounded by ``part_words`` words of
test text (about 500 bytes a word). A larger test set is dealt into parts of
that size, each with an automaton of its own and one scan of the documents, the
hits of the parts being merged; nothing is left out.

Defined results: null texts have no words; a document without words is clean; a
test text without words has no window; a null item id is named by the empty
string; items of equal id are one item; repeated documents give repeated rows;
whole texts are scanned, whatever their length; an input column named like an
output is replaced; an empty test table leaves every document clean.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import append_column, stored, text_slices, with_field, worker_cache

#: What separates words, after A-Z became a-z: all ASCII but digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a window.
WINDOW = 10
#: Words of test text in one automaton.
PART_WORDS = 200_000

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False)
ITEMS = T.ArrayType(T.StringType(), False)


def normal_words(text: Column) -> Column:
    """The normalised words of a text, as an array."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, GAP), "")


def item_pieces(benchmark: DataFrame, id: str, text: str, window: int, piece_words: int) -> DataFrame:
    """(item, words): each test text in pieces of at most ``piece_words`` words
    that overlap by ``window`` - 1, so every window lies in exactly one."""
    words = benchmark.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("item"), normal_words(F.col(text)).alias("words"))
    step = piece_words - window + 1
    last = F.greatest(F.size("words") - window, F.lit(0))  # where the last window starts
    starts = words.where(F.size("words") > 0).select("item", "words", F.explode(F.sequence(F.lit(0), last, F.lit(step))).alias("at"))
    return starts.select("item", F.slice("words", F.col("at") + 1, F.lit(piece_words)).alias("words"))


class WindowScanner:
    """Finds windows of ``pieces`` [(item, words)] in texts."""

    def __init__(self, pieces: list[tuple[str, list[str]]], window: int):
        import ahocorasick

        self.ids: dict[bytes, int] = {}
        self.items: list[set[str]] = []
        self.sizes: list[int] = []
        known: dict[tuple[int, ...], int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for item, words in pieces:
            ids = tuple(self.ids.setdefault(w.encode(), len(self.ids) + 1) for w in words)
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1):
                key = ids[at : at + size]
                number = known.setdefault(key, len(known))
                if number == len(self.items):
                    self.items.append(set())
                    self.sizes.append(size)
                    self.automaton.add_word(key, number)
                self.items[number].add(item)
        if known:
            self.automaton.make_automaton()
        self.words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def __call__(self, data: bytes):
        """(words, hits, items) of a text: the number of its words, the hit
        runs as (first word, last word + 1) and the items that occur."""
        from itertools import repeat

        words = self.words.findall(data.lower())  # of bytes: A-Z only
        runs: list[list[int]] = []
        items: set[str] = set()
        if not self.items:
            return len(words), runs, items
        ids = tuple(map(self.ids.get, words, repeat(0)))
        for end, number in self.automaton.iter(ids):
            items |= self.items[number]
            start = end + 1 - self.sizes[number]
            while runs and runs[-1][1] >= start:  # ends ascend, starts may not
                start = min(start, runs.pop()[0])
            runs.append([start, end + 1])
        return len(words), runs, items

    def places(self, data: bytes, runs) -> list[tuple[int, int]]:
        """The code points, from and to, of runs of words."""
        found = [(m.start(), m.end()) for m in self.words.finditer(data.lower())]
        out, at, chars = [], 0, 0
        for first, stop in runs:
            ends = []
            for byte in (found[first][0], found[stop - 1][1]):
                chars += len(data[at:byte].decode())
                at = byte
                ends.append(chars)
            out.append((ends[0], ends[1]))
        return out


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of two lists of runs; runs that touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan_batches(batches, *, shared, name: str, window: int, text: str):
    """Adds the hits of one part of the test set to those in ``__runs`` and
    ``__items``, if these columns are there."""
    import pyarrow as pa

    kept = worker_cache("decontaminate", dict)  # of the last part only
    if name not in kept:
        kept.clear()
        kept[name] = WindowScanner(shared.value, window)
    scan = kept[name]
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for start, stop in text_slices(batch.column(text)):
            part = batch.slice(start, stop - start)
            counts, runs, items, spans = [], [], [], []
            before = part.column("__runs").to_pylist() if "__runs" in part.schema.names else [None] * part.num_rows
            had = part.column("__items").to_pylist() if "__items" in part.schema.names else [None] * part.num_rows
            for value, old, names in zip(part.column(text).to_pylist(), before, had):
                data = (value or "").encode()
                n, hits, found = scan(data)
                hits = merged([(r["start"], r["end"]) for r in old or ()], [tuple(r) for r in hits])
                counts.append(n)
                runs.append([{"start": a, "end": b} for a, b in hits])
                items.append(sorted(found | set(names or ())))
                spans.append([{"start": a, "end": b} for a, b in scan.places(data, hits)] if hits else [])
            for column, values, kind in (("n_words", counts, pa.int64()), ("__runs", runs, runs_type), ("__items", items, pa.list_(pa.string())), ("spans", spans, runs_type)):
                part = append_column(part, column, pa.array(values, kind))
            yield part


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurrence of a window),
    items (the ids, as text in order, of the items with occurring windows) and
    spans (the hit runs of words as code points of the original text)."""
    if window < 1 or part_words < 2 * window:
        raise ValueError("window must be positive and part_words twice as large at least")
    # pieces of a tenth of a part fill parts evenly, whatever the length of an item
    pieces = stored(item_pieces(benchmark, item_id, item_text, window, max(2 * window, part_words // 10)), "decontaminate-items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(1, math.ceil(total / part_words))
    own = F.pmod(F.xxhash64("item", "words"), F.lit(parts))
    schema = docs.schema
    for name, kind in (("n_words", T.LongType()), ("__runs", SPANS), ("__items", ITEMS), ("spans", SPANS)):
        schema = with_field(schema, name, kind)
    found = docs.drop("__runs", "__items")
    for part in range(parts):
        rows = [(r["item"], list(r["words"])) for r in pieces.where(own == part).select("item", "words").collect()]
        rows.sort()
        name = hashlib.sha256(repr((rows, window)).encode()).hexdigest()
        shared = docs.sparkSession.sparkContext.broadcast(rows)
        if part:  # one automaton at a time in a worker
            found = stored(found, "decontaminate-part")
        found = found.mapInArrow(partial(_scan_batches, shared=shared, name=name, window=window, text=text), schema)
    hit = F.aggregate("__runs", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    outputs = ("n_words", "n_hit", "items", "spans")
    return found.select(*(F.col(c) for c in docs.columns if c not in (*outputs, "__runs", "__items")), "n_words", hit.alias("n_hit"), F.col("__items").alias("items"), "spans")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no window of the test set occurs."""
    marked = contamination(docs.withColumn("__row", F.struct(*docs.columns)), benchmark, **options)
    return marked.where("n_hit = 0").select("__row.*")
