"""Language identification with bit-sliced Bloom filters over n-grams.

Training counts the byte n-grams (3 and 4 bytes of the lower-cased text, with
every ASCII non-letter as a blank) of labelled texts by language. A language's
set holds the n-grams that make up at least ``min_rate`` of its text, at most
1 / ``min_rate`` for each length, and that are at least ``min_ratio`` times as
frequent as in the language that uses them most. All sets share one table of
language bit masks: bit l of slot j says whether the Bloom filter of language
l has bit j. ANDing the masks of an n-gram's slots gives all languages that
contain it at once.

Prediction adds up these bits by language over a whole text, takes off the
false positives expected from each filter's fill, and names the language with
most n-grams. ``score`` is the part of the text's n-grams that it contains.

Training may read a bounded sample: about ``max_docs`` labelled documents of
each language, chosen by a hash of the id. Prediction reads every text whole.

Defined results: ``und`` with score 0 if the text is null or has no letter (or
if nothing could be learned); texts without a known n-gram get the language
with most training documents; rows with a null label are not learned from;
every input column is passed through, those named like the outputs replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import append_column, text_slices, with_field

UNKNOWN = "und"
SIZES = (3, 4)
#: Multipliers of the hash functions, one a slot: odd 64-bit numbers.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _byte_map():
    import numpy as np

    table = np.arange(256, dtype=np.uint8)
    letters = np.zeros(256, bool)
    letters[ord("a") : ord("z") + 1] = True
    letters[128:] = True
    table[~letters] = 32
    return table


def _grams(texts: list[str | None], size: int, data=None):
    """For the n-grams of ``size`` bytes of many texts: key and text number.
    N-grams with two blanks in a row, or across texts, are left out."""
    import numpy as np

    joined, owner = data if data is not None else _joined(texts)
    n = len(joined) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.zeros(n, np.uint64)
    fine = owner[:n] == owner[size - 1 :]
    for i in range(size):
        key = key << np.uint64(8) | joined[i : n + i]
    blank = joined == 32
    twice = blank[:-1] & blank[1:]
    for i in range(size - 1):
        fine &= ~twice[i : n + i]
    key |= np.uint64(size << 56)
    return key[fine], owner[:n][fine]


def _joined(texts: list[str | None]):
    import numpy as np

    parts = [b" " + (t or "").lower().encode() + b" " for t in texts]
    joined = _byte_map()[np.frombuffer(b"".join(parts), np.uint8)]
    return joined, np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _count_batches(batches, *, text: str, lang: str):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for start, stop in text_slices(batch.column(text), 2 << 20):
            part = batch.slice(start, stop - start)
            labels, texts = part.column(lang).to_pylist(), part.column(text).to_pylist()
            for label in sorted(set(labels)):
                own = _joined([t for t, x in zip(texts, labels) if x == label])
                for size in SIZES:
                    keys, counts = np.unique(_grams([], size, own)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label] * len(keys), pa.string()), pa.array([size] * len(keys), pa.int32()),
                         pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))],
                        names=["lang", "size", "gram", "n"],
                    )


@dataclass
class Model:
    languages: list[str]  # the one with most documents first
    masks: object  # uint64[slots, words]
    false_rate: list[float]


def train(
    labelled: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_docs: int = 3000,
    min_rate: float = 1e-4,
    min_ratio: float = 0.5,
    slots_log2: int = 19,
) -> Model:
    """Learn from the rows of ``labelled`` with a text and a label."""
    import numpy as np

    rows = labelled.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    sizes = rows.groupBy("lang").count().collect()  # one row a language
    sizes.sort(key=lambda r: (-r["count"], r["lang"]))
    languages = [r["lang"] for r in sizes]
    words = max(1, -(-len(languages) // 64))
    masks = np.zeros((1 << slots_log2, words), np.uint64)
    if not languages:
        return Model([], masks, [])
    part = F.lit(None).cast("double")
    for r in sizes:
        part = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, max_docs / r["count"]))).otherwise(part)
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < part * float(1 << 32)).select("text", "lang")
    counts = (
        chosen.mapInArrow(partial(_count_batches, text="text", lang="lang"), "lang string, size int, gram bigint, n bigint")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    # rates add up to 1: at most 1 / min_rate n-grams of each language and length are kept
    kept = (
        counts.join(F.broadcast(totals), ["lang", "size"])
        .select("lang", "gram", (F.col("n") / F.col("total")).alias("rate"))
        .where(F.col("rate") >= min_rate)
        .collect()
    )
    most: dict[int, float] = {}
    for _, gram, rate in kept:
        most[gram] = max(rate, most.get(gram, 0.0))
    number = {name: i for i, name in enumerate(languages)}
    for name in languages:
        grams = np.array([g for n, g, rate in kept if n == name and rate >= min_ratio * most[g]], np.int64).astype(np.uint64)
        word, bit = divmod(number[name], 64)
        for slot in _slots(grams, slots_log2):
            masks[slot, word] |= np.uint64(1 << bit)
    fill = [float(((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(languages))]
    return Model(languages, masks, [f ** len(MULTIPLIERS) for f in fill])


def _slots(keys, slots_log2: int):
    import numpy as np

    with np.errstate(over="ignore"):
        return [((keys * np.uint64(m)) >> np.uint64(64 - slots_log2)).astype(np.int64) for m in MULTIPLIERS]


def predict_texts(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    import numpy as np
    import regex

    n, langs = len(texts), len(model.languages)
    hits, total = np.zeros((n, max(1, langs))), np.zeros(n)
    slots_log2 = model.masks.shape[0].bit_length() - 1
    small = model.masks[:, 0].astype(np.uint8) if langs <= 8 else None
    data = _joined(texts)
    for size in SIZES:
        keys, owner = _grams(texts, size, data)
        total += np.bincount(owner, minlength=n)
        slots = _slots(keys, slots_log2)
        for word in range(model.masks.shape[1]):
            table = small if small is not None else model.masks[:, word]
            found = table[slots[0]]
            for s in slots[1:]:
                found &= table[s]
            for bit in range(min(64, langs - 64 * word)):
                own = owner[(found >> found.dtype.type(bit)) & found.dtype.type(1) != 0]
                hits[:, 64 * word + bit] += np.bincount(own, minlength=n)
    false = np.array(model.false_rate or [0.0])
    net = np.maximum(0.0, (hits - total[:, None] * false) / (1 - np.minimum(false, 0.999)))
    best = net.argmax(axis=1)
    score = np.clip(net[np.arange(n), best] / np.maximum(total, 1), 0.0, 1.0)
    letter = regex.compile(r"\p{L}").search
    known = [bool(langs) and t is not None and letter(t) is not None for t in texts]
    return (
        [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
        [float(s) if k else 0.0 for s, k in zip(score, known)],
    )


def _predict_batches(batches, *, shared, text: str, out: str, score: str):
    import pyarrow as pa

    for batch in batches:
        for start, stop in text_slices(batch.column(text), 2 << 20):
            part = batch.slice(start, stop - start)
            langs, scores = predict_texts(part.column(text).to_pylist(), Model(*shared.value))
            part = append_column(part, out, pa.array(langs, pa.string()))
            yield append_column(part, score, pa.array(scores, pa.float64()))


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score of every text."""
    schema = with_field(with_field(docs.schema, out, T.StringType()), score, T.DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks, model.false_rate))
    return docs.mapInArrow(partial(_predict_batches, shared=shared, text=text, out=out, score=score), schema)


def held_out(id: str = "doc_id"):
    """True for the documents that training never reads."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1
