"""Near-duplicate texts: ProbMinHash, banding, exact verification.

A text is a weighted set: its shingles of five words (all words, if there are
fewer) with their counts. The probability Jaccard similarity J_P of two such
sets is the chance that their ProbMinHash components agree: every shingle sends
a Poisson process of arrivals at the rate of its weight, each to a random
component, and a component keeps the shingle that arrived first. A shingle
stops as soon as its next arrival is later than all components' best, so a text
costs a few arrivals a shingle (Ertl's ProbMinHash3, all shingles of many texts
at a time).

``bands`` bands of ``rows`` components make buckets: with 20 bands of 4 a pair
at 0.8 is missed with probability 3e-5. Texts connected by shared buckets are a
family. Within a family all texts are compared exactly, by blocks: matrix
products of their shingles inside a task, which returns only the links that
connect them. Pairs are never written out. A family of more than ``block``
texts or ``block_bytes`` bytes is first compared with one of its texts; what is near that is one class,
and parts of this class need no comparison with each other. The other pairs of
parts are blocks of their own, so no task holds more than two parts: about
``block_bytes`` of text each, or one longer text. Shingles are computed a slice
of texts at a time, and the matrix is there for some of its columns at a time.

Equal texts are one text from the start; they are known by 128 bits of their
SHA-256. Words are named by 64-bit hashes that don't depend on their bytes
linearly; names are only ever compared within a family, so that two different
words meet under one name by chance once in some 10^11 comparisons of texts of
10,000 words.

Defined results: a null text is a class of its own; texts without a word are
near only to equal ones; a class is named by its smallest id, and ``kept``
marks that document; rows with equal ids count as one document, linked by any
of their texts (``without_copies`` decides by row instead); a null id is no
name: such rows take part like all others, are kept only in a class without
any id (one row of it), and only such a class has a null class_id; words are
separated by blanks (space, tab to carriage return).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import first_of_each, forget, stored, text_slices
from stratum.llm.components import connected
from stratum.llm.rolling import fold, mix

WORDS, BANDS, ROWS, THRESHOLD = 5, 20, 4, 0.8
SLICE = 1 << 20
#: Bytes of text in a part of a family; a longer text is a part of its own.
BLOCK_BYTES = 4 << 20
#: Cells of the incidence matrix that are there at a time.
CELLS = 4 << 20


#: Longer words are hashed one by one.
LONG_WORD = 64


def word_names(data, start, end):
    """64-bit names of words (byte ranges of ``data``): a fold over 8 bytes at
    a time, scrambled after each, so no pattern of bytes cancels out."""
    import hashlib

    import numpy as np

    size = end - start
    names = np.full(len(start), 0x9AE16A3B2F90404F, np.uint64)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    left = np.flatnonzero(size <= LONG_WORD)
    for chunk in range(0, LONG_WORD, 8):
        left = left[size[left] > chunk]
        if not len(left):
            break
        at = start[left] + chunk
        inside = size[left] - chunk
        value = np.zeros(len(left), np.uint64)
        for i in range(8):
            byte = np.where(i < inside, padded[np.minimum(at + i, len(padded) - 1)], np.uint8(0))
            value |= byte.astype(np.uint64) << np.uint64(8 * i)
        names[left] = fold([names[left], value])
    for i in np.flatnonzero(size > LONG_WORD):
        names[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return fold([names, size.astype(np.uint64)])


def weighted_shingles(column, words: int = WORDS):
    """(owner, shingle, weight) of an Arrow string column, by owner: each
    text's different shingles as 64-bit names, with their counts."""
    import numpy as np

    parts = [(t or "").encode() + b" " for t in column.to_pylist()]
    data = np.frombuffer(b" " + b"".join(parts), np.uint8)
    ends = 1 + np.cumsum([len(p) for p in parts], dtype=np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    text = np.searchsorted(ends, start, side="right")
    names = word_names(data, start, end)
    n = np.bincount(text, minlength=len(parts))
    first = np.cumsum(n) - n
    heads = np.maximum(n - words + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(parts)), heads)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(heads) - heads, heads) + np.repeat(first, heads)
    inside = np.minimum(n, words)[owner]
    padded = np.r_[names, np.zeros(words, np.uint64)]
    shingle = fold([np.where(i < inside, padded[at + i], np.uint64(0)) for i in range(words)] + [inside.astype(np.uint64)])
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.flatnonzero(np.r_[True, (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])]) if len(owner) else np.zeros(0, int)
    return owner[new], shingle[new], np.diff(np.r_[new, len(owner)]).astype(float)


def sliced_shingles(column, words: int = WORDS):
    """``weighted_shingles``, computed for about SLICE bytes of text at a time
    (one text at least): its arrays take some 50 bytes a byte, the result a few."""
    import numpy as np

    parts = []
    for start, stop in text_slices(column, SLICE):
        owner, shingle, weight = weighted_shingles(column.slice(start, stop - start), words)
        parts.append((owner + start, shingle, weight))
    return tuple(np.concatenate(x) for x in zip(*parts))


def prob_minhash(owner, shingle, weight, texts: int, size: int):
    """uint64[texts, size]: the shingle that each component keeps."""
    import numpy as np

    first = np.full(texts * size, np.inf)
    kept = np.zeros(texts * size, np.uint64)
    time = np.zeros(len(owner))
    active = np.arange(len(owner))
    step = np.uint64(0)
    while len(active):
        with np.errstate(over="ignore"):
            step += np.uint64(0x9E3779B97F4A7C15)
            draw = mix(shingle[active] + step)
        uniform = ((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        now = time[active] - np.log(uniform) / weight[active]
        time[active] = now
        slot = ((mix(draw) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        spot = owner[active] * size + slot.astype(np.int64)
        early = np.flatnonzero(now < first[spot])
        early = early[np.argsort(-now[early], kind="stable")]  # of equal places the earliest arrival is written last
        first[spot[early]] = now[early]
        kept[spot[early]] = shingle[active[early]]
        last = first.reshape(texts, size).max(axis=1)
        active = active[now < last[owner[active]]]
    return kept.reshape(texts, size)


def _sign_batches(batches, *, words: int, bands: int, rows: int):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        for start, stop in text_slices(batch.column("text"), SLICE):
            part = batch.slice(start, stop - start)
            n = part.num_rows
            owner, shingle, weight = weighted_shingles(part.column("text"), words)
            kept = prob_minhash(owner, shingle, weight, n, bands * rows).reshape(n, bands, rows)
            keys = fold([kept[:, :, i] for i in range(rows)] + [np.arange(bands, dtype=np.uint64)[None, :]])
            some = np.bincount(owner, minlength=n) > 0
            offsets = np.r_[0, np.cumsum(np.where(some, bands, 0))]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[some].ravel().view(np.int64)))
            sizes = pc.binary_length(part.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("digest"), sizes, lists], names=["id", "digest", "bytes", "bands"])


def similarity(shingle_a, weight_a, shingle_b, weight_b) -> float:
    """Exact J_P: over common shingles i, the sum of one over the sum over all
    shingles j of max(a_j / a_i, b_j / b_i)."""
    import numpy as np

    both, at_a, at_b = np.intersect1d(shingle_a, shingle_b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    total = len(shingle_a) + len(shingle_b) - len(both)
    if len(weight_a) == weight_a.sum() and len(weight_b) == weight_b.sum():
        return len(both) / total
    a, b = weight_a[at_a], weight_b[at_b]
    only_a = weight_a.sum() - a.sum()
    only_b = weight_b.sum() - b.sum()
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    sorted_ratio = ratio[order]
    from_right = np.r_[np.cumsum(a[order][::-1])[::-1], 0.0]  # a of those with a ratio as high
    from_left = np.r_[0.0, np.cumsum(b[order])]  # b of those with a lower one
    cut = np.searchsorted(sorted_ratio, ratio, side="left")
    return float((1.0 / ((only_a + from_right[cut]) / a + (only_b + from_left[cut]) / b)).sum())


def _verify_batches(batches, *, words: int, threshold: float):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        for start, stop in text_slices(pc.binary_join_element_wise(batch.column("text_a"), batch.column("text_b"), ""), SLICE):
            part = batch.slice(start, stop - start)
            sides = []
            for name in ("text_a", "text_b"):
                owner, shingle, weight = weighted_shingles(part.column(name), words)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                sides.append((shingle, weight, ends))
            (sa, wa, ea), (sb, wb, eb) = sides
            near = [
                similarity(sa[ea[i] : ea[i + 1]], wa[ea[i] : ea[i + 1]], sb[eb[i] : eb[i + 1]], wb[eb[i] : eb[i + 1]])
                >= threshold - 1e-12
                for i in range(part.num_rows)
            ]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"]
            )


def _family_links(owner, shingle, weight, rows: slice, side, keys, threshold: float):
    """(a, b) pairs that connect what is connected by similarity in one group
    of texts: all its pairs are compared (those of side 0 with side 1 if the
    group has two sides), a spanning set of the near ones is given."""
    import numpy as np

    start, stop = np.searchsorted(owner, [rows.start, rows.stop])
    text, names, counts = owner[start:stop] - rows.start, shingle[start:stop], weight[start:stop]
    n = rows.stop - rows.start
    size = np.bincount(text, minlength=n)
    total = np.bincount(text, weights=counts, minlength=n)
    plain = total == size
    _, column, often = np.unique(names, return_inverse=True, return_counts=True)
    shared = often[column] > 1  # the others are in no intersection
    _, column = np.unique(column[shared], return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, holder, count = column[order], text[shared][order], counts[shared][order]
    left, right = (np.flatnonzero(side != 1), np.flatnonzero(side != 0)) if (side != 2).any() else (np.arange(n), np.arange(n))
    ends = np.searchsorted(text, np.arange(n + 1))
    root = np.arange(n)
    odd = not plain.all()
    shape = (len(left), len(right))
    commons = np.zeros(shape)
    # of either text, how much lies in common shingles; only of use where one repeats
    masses_x, masses_r = (np.zeros(shape), np.zeros(shape)) if odd else (None, None)
    chunk = max(1, CELLS // n)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, chunk):
        lo, hi = np.searchsorted(column, [low, low + chunk])
        width = min(chunk, int(column[-1]) + 1 - low)
        has = np.zeros((n, width), np.float32)
        has[holder[lo:hi], column[lo:hi] - low] = 1
        has_x, has_r = has[left], has[right]
        commons += has_x @ has_r.T
        if odd:
            has[holder[lo:hi], column[lo:hi] - low] = count[lo:hi]
            masses_x += has[left] @ has_r.T
            masses_r += has_x @ has[right].T

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for at in range(0, len(left), 256):
        x = left[at : at + 256]
        common = commons[at : at + 256]
        union = size[x][:, None] + size[right][None, :] - common
        both_plain = plain[x][:, None] & plain[right][None, :]
        # J_P is at most the part of either text that lies in common shingles
        near = both_plain & (common >= (threshold - 1e-12) * union)
        maybe = np.zeros_like(near)
        if odd:
            in_x = masses_x[at : at + 256] / np.maximum(total[x], 1)[:, None]
            in_r = masses_r[at : at + 256] / np.maximum(total[right], 1)[None, :]
            maybe = ~both_plain & (in_x >= threshold - 1e-5) & (in_r >= threshold - 1e-5)
        for i, j in zip(*np.nonzero((near | maybe) & (x[:, None] != right[None, :]))):
            a, b = x[i], right[j]
            u, v = find(a), find(b)
            if u == v:
                continue
            if maybe[i, j]:
                p, q = slice(ends[a], ends[a + 1]), slice(ends[b], ends[b + 1])
                if similarity(names[p], counts[p], names[q], counts[q]) < threshold - 1e-12:
                    continue
            root[max(u, v)] = min(u, v)
            yield keys[a], keys[b]


def _family_batches(batches, *, words: int, threshold: float):
    """Rows sorted by (family, i, j); a group that a batch leaves open waits."""
    import numpy as np
    import pyarrow as pa


    def found(table):
        values = [table.column(n).to_numpy() for n in ("family", "i", "j")]
        new = np.r_[True, np.any([v[1:] != v[:-1] for v in values], axis=0)]
        starts = np.flatnonzero(new)
        stops = np.r_[starts[1:], table.num_rows]
        keys, side = table.column("key").to_numpy(), table.column("side").to_numpy()
        at = 0
        while at < len(starts):  # some groups at a time, about SLICE bytes
            last = at
            size = 0
            while last < len(starts) and (last == at or size < SLICE):
                part = table.column("text").slice(starts[last], stops[last] - starts[last])
                size += sum(chunk.nbytes for chunk in part.chunks)
                last += 1
            lo, hi = starts[at], stops[last - 1]
            column = table.column("text").slice(lo, hi - lo).combine_chunks()
            owner, shingle, weight = sliced_shingles(column, words)
            links = []
            for g in range(at, last):
                own = slice(starts[g], stops[g])
                rows = slice(starts[g] - lo, stops[g] - lo)
                links += _family_links(owner, shingle, weight, rows, side[own], keys[own], threshold)
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            at = last

    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if waiting is None else pa.concat_tables([waiting, table])
        same = np.all([table.column(n).to_numpy() == table.column(n)[-1].as_py() for n in ("family", "i", "j")], axis=0)
        whole = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if whole:
            yield from found(table.slice(0, whole))
        waiting = table.slice(whole)
    if waiting is not None:
        yield from found(waiting)


def text_digest(text: str) -> Column:
    """128 bits that name a text; null for null."""
    return F.substring(F.unhex(F.sha2(F.col(text), 256)), 1, 16)


def _near_texts(docs: DataFrame, id: str, text: str, words: int, threshold: float, bands: int, rows: int, block: int, block_bytes: int):
    """(signed, first, links): ``signed`` has id, digest (names equal texts)
    and a row number of each row with a text, ``first`` for each digest its
    smallest id and row number, which is its key from here on, ``links`` (a, b)
    connect the keys of near texts."""
    base = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    texts = base.where("text IS NOT NULL").withColumn("digest", text_digest("text"))
    sign = partial(_sign_batches, words=words, bands=bands, rows=rows)
    signed = texts.mapInArrow(sign, "id bigint, digest binary, bytes bigint, bands array<bigint>").withColumn("row", F.monotonically_increasing_id())
    banded = stored(signed, "near-banded")
    signed = stored(banded.select("id", "digest", "row"), "near-signed")
    first = banded.groupBy("digest").agg(F.min("id").alias("id"), F.min("row").alias("key"), F.max("bytes").alias("bytes"))
    first = stored(first, "near-first")
    spots = banded.join(first.select(F.col("key").alias("row")).hint("merge"), "row", "left_semi").select(F.col("row").alias("key"), F.explode("bands").alias("bucket"))
    spots = stored(spots, "near-spots")
    forget(banded)
    shared = spots.groupBy("bucket").agg(F.min("key").alias("lead"), F.max("key").alias("last")).where("lead != last")
    shared = stored(shared.select("bucket", "lead"), "near-buckets")
    # a family: texts connected by shared buckets
    met = spots.join(shared.hint("merge"), "bucket").where("key != lead").select(F.col("lead").alias("a"), F.col("key").alias("b"))
    family = connected(met.distinct()).select(F.col("node").alias("key"), F.col("root").alias("family"))
    family = stored(family.join(first.hint("merge"), "key").select("family", "key", "id", "digest", "bytes"), "near-families")
    forget(spots, shared)
    sizes = family.groupBy("family").agg(F.count("*").alias("n"), F.sum("bytes").alias("sum"))
    parts = F.ceil(F.greatest(F.col("n") / block, F.col("sum") / block_bytes))
    sizes = stored(sizes.select("family", parts.alias("parts"), (F.col("sum") / F.col("n")).alias("mean")), "near-sizes")
    members = family.join(sizes.hint("merge"), "family")
    # what is compared with all others of a large family is no long text: it travels with each of them
    usual = F.when(F.col("bytes") <= 2 * F.col("mean"), F.col("key"))
    members = stored(members.withColumn("usual", usual), "near-members")
    forget(family, sizes)
    leads = stored(members.where("parts > 1").groupBy("family").agg(F.min("usual").alias("lead")), "near-family-leads")
    chosen = members.select(F.col("id").alias("first_id"), F.col("digest").alias("first_digest"), "key")
    # one text of each key; its id may be null
    whole = texts.join(chosen.hint("merge"), (F.col("digest") == F.col("first_digest")) & F.col("id").eqNullSafe(F.col("first_id")))
    whole = stored(whole.select("key", "text").mapInArrow(first_of_each, "key bigint, text string"), "near-texts")

    # of a family beyond one block, what is near its lead is one class at once
    large = members.where("parts > 1").join(leads.hint("merge"), "family").select(F.col("lead").alias("a"), F.col("key").alias("b")).where("a != b")
    pairs = large.join(whole.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(
        whole.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"
    )
    verify = partial(_verify_batches, words=words, threshold=threshold)
    led = stored(pairs.mapInArrow(verify, "a bigint, b bigint"), "near-led")
    near = led.select(F.col("b").alias("key")).unionByName(leads.select(F.col("lead").alias("key"))).distinct()
    # a text beyond block_bytes has a part of its own, numbered below zero
    part = F.when(F.col("bytes") > block_bytes, -1 - F.col("key").bitwiseAND(F.lit((1 << 62) - 1))).otherwise(F.pmod(F.xxhash64("key"), "parts"))
    parts = (
        members.join(near.withColumn("led", F.lit(True)), "key", "left")
        .withColumn("led", F.coalesce("led", F.lit(False)))
        .select("family", "key", "led", F.when(F.col("parts") > 1, part).otherwise(0).alias("part"))
    )
    parts = stored(parts, "near-parts")
    kinds = stored(parts.select("family", "led", "part").distinct(), "near-kinds")
    spot = F.struct("led", "part")
    left = kinds.select("family", spot.alias("x"))
    right = kinds.select("family", spot.alias("y"))
    # the pairs of parts of a family, but for two parts of the class just found
    tasks = left.join(right, "family").where("x <= y AND NOT (x.led AND y.led)")
    code = lambda c: F.col(c)["part"] * 2 + F.col(c)["led"].cast("int")
    tasks = tasks.select("family", "x", "y", code("x").cast("bigint").alias("i"), code("y").cast("bigint").alias("j"))
    both = F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("k"), F.lit(2).alias("side")))).otherwise(
        F.array(F.struct(F.col("x").alias("k"), F.lit(0).alias("side")), F.struct(F.col("y").alias("k"), F.lit(1).alias("side")))
    )
    tasks = tasks.withColumn("s", F.explode(both)).select("family", "i", "j", "s.k.led", "s.k.part", "s.side")
    order = ["family", "i", "j"]
    tasks = stored(tasks, "near-tasks")
    placed = parts.join(tasks, ["family", "led", "part"]).select(*order, "side", "key")
    groups = placed.join(whole, "key").select(*order, "side", "key", "text").repartition(*order).sortWithinPartitions(*order)
    compare = partial(_family_batches, words=words, threshold=threshold)
    links = stored(groups.mapInArrow(compare, "a bigint, b bigint"), "near-links")
    forget(members, leads, whole, parts, kinds, tasks)
    return signed, first.select("id", "digest", "key"), links.unionByName(led)


def near_classes(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = 1000,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each row of ``docs``: the id, class_id and kept."""
    signed, first, links = _near_texts(docs, id, text, words, threshold, bands, rows, block, block_bytes)
    # the texts of one id belong together
    several = signed.where("id IS NOT NULL").groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("last")).where("a != last")
    same = signed.join(stored(several.select("id", "a"), "near-same-id"), "id").select("a", F.col("digest").alias("b")).distinct()
    number = lambda c: first.select(F.col("digest").alias(c), F.col("key").alias(f"{c}_key")).hint("merge")
    same = stored(same, "near-same").join(number("a"), "a").join(number("b"), "b").select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))
    classes = stored(connected(links.unionByName(same)).withColumnRenamed("node", "key").join(first.hint("merge"), "key"), "near-classes")
    lowest = classes.groupBy("root").agg(F.min("id").alias("class_id"), F.min("key").alias("lead"))
    # written first: the joins then shuffle both sides, and Spark splits a class or a text with very many rows
    lowest = classes.select("key", "root").join(stored(lowest, "near-lowest").hint("merge"), "root").drop("root")
    named = first.join(lowest, "key", "left").select("digest", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("lead", "key").alias("lead"))
    found = signed.join(stored(named, "near-named"), "digest")
    kept = F.when(F.col("id").isNotNull(), F.col("id") == F.col("class_id")).otherwise(F.col("class_id").isNull() & (F.col("row") == F.col("lead")))
    found = found.select("id", "class_id", kept.alias("kept"))
    own = F.col(id).cast("bigint")
    alone = docs.where(F.col(text).isNull()).select(own.alias("id"), own.alias("class_id"), F.lit(True).alias("kept"))
    return found.unionByName(alone).select(F.col("id").alias(id), "class_id", "kept")


def without_copies(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = 1000,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with exactly one row of each class of near texts, that of the
    smallest id (nulls last; then of the smallest digest of its text). Here only
    texts make a class: rows of one id with unlike texts stay, of rows with
    equal id and text one stays. Null texts stay."""
    signed, first, links = _near_texts(docs, id, text, words, threshold, bands, rows, block, block_bytes)
    classes = stored(connected(links).withColumnRenamed("node", "key").join(first.hint("merge"), "key"), "near-classes")
    lead = classes.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest", "key")).alias("lead"))
    lead = stored(lead.select(F.col("lead")["key"].alias("key"), F.lit(True).alias("leads")), "near-leads")
    gone = classes.select("key").join(lead.hint("merge"), "key", "left_anti").withColumn("gone", F.lit(True))
    named = first.select("digest", "key", F.col("id").alias("first_id")).join(gone, "key", "left")
    pairs = stored(signed.groupBy("id", "digest").agg(F.count("*").alias("n")), "near-pairs")
    pairs = pairs.join(stored(named, "near-named"), "digest").withColumn("stays", F.col("gone").isNull() & F.col("id").eqNullSafe(F.col("first_id")))
    pairs = pairs.where("NOT stays OR n > 1").select(F.col("id").alias("__pair_id"), F.col("digest").alias("__pair_key"), "stays")
    pairs = stored(pairs, "near-pairs-named")
    mine = docs.withColumn("__id", F.col(id).cast("bigint")).withColumn("__key", text_digest(text))
    same = (F.col("__key") == F.col("__pair_key")) & F.col("__id").eqNullSafe(F.col("__pair_id"))
    left = mine.join(pairs.where("NOT stays"), same, "left_anti")
    again = pairs.where("stays")
    if again.isEmpty():
        return left.select(*docs.columns)
    # rows of equal id and text: the one whose columns have the smallest hash
    every = F.struct(*docs.columns)
    one = left.join(again, same, "left_semi").groupBy("__id", "__key").agg(F.min_by(every, F.xxhash64(F.to_json(every))).alias("__row"))
    return left.join(again, same, "left_anti").select(*docs.columns).unionByName(one.select("__row.*"))
