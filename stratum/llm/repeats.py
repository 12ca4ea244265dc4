"""Repeated byte strings across all texts: sparse distributed prefix doubling.

A byte goes if some string of ``length`` bytes covers it that also starts
anywhere else, in the same or another text. Sorting all positions would take
several times the corpus for each round, so names are kept for *anchors* only:
of the 32-byte strings that a string of ``length`` bytes starts with at its
successive places, all but those of its last third (``behind``: 128 bytes of
400), the one with the smallest hash (the leftmost of equals). Which position a string of ``length`` bytes
picks as its first anchor depends on its own bytes alone, so equal strings
have their anchors at equal places, with at least ``behind`` equal bytes after
them. Nothing is lost by looking at anchors only.

Each round looks at longer stretches around an anchor, and drops what has
become unique; equal stretches meet by a 64-bit name (in place of the rank that
sorting all positions would give), counted with
map-side aggregation and never gathered by key:

* ``behind`` bytes from the anchor: texts without a repeated anchor are done.
* all bytes of all strings that the anchor stands for (``length`` and more):
  where this repeats, the whole stretch goes at once.
* where it doesn't, the same for groups of 16 neighbouring strings, and then
  for single strings: only at the ends of repeated passages.

In a round, strings that can be equal share a *core* (what all strings of a
stretch have in common); only stretches whose core occurs in different
stretches go on, one text place for each different stretch.

Which texts move is not bounded by anything but the input, so these joins are
told to shuffle at every size instead of broadcasting where a table is small.

Equal texts take part once; a text of ``length`` bytes or more that occurs
twice goes as a whole. The scan of the texts runs once, then only texts with a
repeated anchor move. With ``shorter``, the rounds run for that length first;
a string of ``length`` bytes can only occur again inside a run of ``length``
bytes or more that strings of the shorter length cover, so the rounds for
``length`` look at such runs alone.

Texts are hashed about 256 KB at a time, a longer text on its own: its task
takes some 50 bytes of memory for each of its bytes. Tables written on the way
are deleted as soon as nothing needs them.

Defined results: a null text counts as empty; texts shorter than ``length``
stay as they are; texts are judged as UTF-8 bytes on the input; each row is a
text of its own, so a repeated row makes both go; a null id is an id like any
other (rows with null ids take part, as many as there are).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import first_of_each, forget, stored, text_slices
from stratum.llm.rolling import Roller, fold, mix

GROUP = 16
#: Bytes of text that are hashed at a time: a place takes some 20 arrays of 8
#: bytes, and where every string is looked at, 48 bytes of output.
SLICE = 1 << 18
#: Shortest length for which anchors make sense.
MIN_LENGTH = 50


def behind(length: int) -> int:
    """Bytes after an anchor that its strings surely share: even, 128 of 400.
    Fewer would make fewer anchors, but more of them would repeat by chance."""
    return 2 * (length * 4 // 25)


def _texts(column):
    """The bytes of an Arrow string column after each other, and each text's
    start and end."""
    import numpy as np

    parts = [(t or "").encode() for t in column.to_pylist()]
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends


def _anchors(roll, data, starts, ends, length: int):
    """For each anchor: its text's number, its place, and the first and last
    start of the strings that it stands for."""
    import numpy as np

    span = length - behind(length) + 1  # so many strings compete
    gram = min(32, behind(length))
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, None
    rolling = roll(data)
    grams = mix(rolling.windows(gram)) >> np.uint64(32) << np.uint64(32) | np.arange(len(data) - gram + 1, dtype=np.uint64)
    size = 1
    low = grams
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(starts)), np.maximum(0, ends - starts - length + 1))
    first = np.maximum(0, ends - starts - length + 1)
    p = np.arange(len(owner)) - np.repeat(np.cumsum(first) - first, first) + np.repeat(starts, first)
    if not len(p):
        return none, none, none, none, rolling
    a = at[np.minimum(p, len(at) - 1)]
    head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[head[1:], len(p)] - 1
    return owner[head], a[head], p[head], p[last], rolling


def _core(rolling, a, length: int):
    """The names of the ``behind`` bytes from anchors: of the pairs of their
    halves' names."""
    size = behind(length)
    return fold([rolling.ranges(a, a + size // 2), rolling.ranges(a + size // 2, a + size)])


def _first_batches(batches, *, length: int):
    """(key, name): the name of the ``behind`` bytes from each anchor."""
    import numpy as np
    import pyarrow as pa

    roll = Roller()
    for batch in batches:
        for start, stop in text_slices(batch.column("text"), SLICE):
            part = batch.slice(start, stop - start)
            data, starts, ends = _texts(part.column("text"))
            owner, a, _, _, rolling = _anchors(roll, data, starts, ends, length)
            if len(a):
                names = _core(rolling, a, length)
                keys = part.column("key").to_numpy(zero_copy_only=False)[owner]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(names.view(np.int64))], names=["key", "name"])


STRETCH = "key bigint, full bigint, core bigint, a bigint, lo bigint, hi bigint"


def _emit(part, starts, owner, a, lo, hi, rolling, length, core):
    import numpy as np
    import pyarrow as pa

    place = [(a - lo).astype(np.uint64), (hi - lo).astype(np.uint64)]
    full = fold([rolling.ranges(lo, hi + length), *place])
    begin = starts[owner]
    columns = [part.column("key").to_numpy(zero_copy_only=False)[owner], full.view(np.int64), core.view(np.int64), a - begin, lo - begin, hi - begin]
    names = ["key", "full", "core", "a", "lo", "hi"]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)


def _anchor_batches(batches, *, length: int):
    """One stretch for each anchor that may repeat; its core is what stands
    behind the anchor. Where the column ``names`` is given, only anchors whose
    core is among these go on, where ``runs`` (lo, end) is given, only those
    with a string inside one of these runs of bytes."""
    import numpy as np

    roll = Roller()
    for batch in batches:
        for start, stop in text_slices(batch.column("text"), SLICE):
            part = batch.slice(start, stop - start)
            data, starts, ends = _texts(part.column("text"))
            owner, a, lo, hi, rolling = _anchors(roll, data, starts, ends, length)
            if len(a):
                core = _core(rolling, a, length)
                if "names" in part.schema.names:
                    again = np.isin(core.view(np.int64), part.column("names").flatten().to_numpy(zero_copy_only=False))
                else:
                    again = _inside(part.column("runs"), starts, owner, lo, hi, length)
                owner, a, lo, hi, core = (v[again] for v in (owner, a, lo, hi, core))
                yield _emit(part, starts, owner, a, lo, hi, rolling, length, core)


def _inside(runs, starts, owner, lo, hi, length: int):
    """Which stretches hold a string (start lo to hi) inside a run of their
    text; runs are given in order and don't touch."""
    import numpy as np
    import pyarrow.compute as pc

    of = np.repeat(np.arange(len(runs)), pc.list_value_length(runs).to_numpy(zero_copy_only=False))
    values = runs.flatten()
    first = values.field("lo").to_numpy(zero_copy_only=False) + starts[of]
    last = values.field("end").to_numpy(zero_copy_only=False) - length + starts[of]  # where the last string starts
    at = np.searchsorted(last, lo)  # the first run that has a string from lo on
    some = at < len(last)
    at = np.minimum(at, len(last) - 1)
    return some & (of[at] == owner) & (first[at] <= hi)


def _split_batches(batches, *, length: int, group: int):
    """The stretches in ``open`` (a, lo, hi) cut into groups of ``group``
    strings; groups are aligned by their distance to the anchor, so equal
    strings fall into equal groups."""
    import numpy as np
    import pyarrow.compute as pc

    roll = Roller()
    for batch in batches:
        for start, stop in text_slices(batch.column("text"), SLICE):
            part = batch.slice(start, stop - start)
            data, starts, _ = _texts(part.column("text"))
            lists = part.column("open")
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            values = lists.flatten()
            owner = np.repeat(np.arange(part.num_rows), counts)
            a, lo, hi = (values.field(n).to_numpy(zero_copy_only=False) + starts[owner] for n in ("a", "lo", "hi"))
            far, near = (a - lo) // group, (a - hi) // group  # a >= hi >= lo
            n = far - near + 1
            row = np.repeat(np.arange(len(a)), n)
            block = np.repeat(near, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            owner, a = owner[row], a[row]
            left = np.maximum(lo[row], a - block * group - group + 1)
            right = np.minimum(hi[row], a - block * group)
            if not len(a):
                continue
            rolling = roll(data)
            # all strings of the whole group, there or not, share these bytes
            core_from, core_to = a - block * group, a - block * group - group + 1 + length
            core = fold([rolling.ranges(core_from, core_to), block.astype(np.uint64)])
            yield _emit(part, starts, owner, a, left, right, rolling, length, core)


def _covered(data_size: int, covered):
    """Which of a text's bytes lie in its covered strings."""
    import numpy as np

    inside = np.zeros(data_size + 1, np.int64)
    values = covered.values
    np.add.at(inside, values.field("lo").to_numpy(zero_copy_only=False), 1)
    np.add.at(inside, values.field("end").to_numpy(zero_copy_only=False), -1)
    return np.cumsum(inside[:-1]) > 0


def _cut_batches(batches):
    """Each text's bytes outside its covered strings, and the text they make
    (characters that lost some of their bytes go)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for start, stop in text_slices(batch.column("text"), SLICE):
            part = batch.slice(start, stop - start)
            removed, spans, kept, rest = [], [], [], []
            for text, covered in zip(part.column("text"), part.column("covered")):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                gone = _covered(len(data), covered)
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                kept.append(data[~gone].tobytes())
                rest.append(kept[-1].decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), pa.array(rest, pa.string())],
                names=["key", "n_removed", "n_spans", "kept", "rest"],
            )


def _run_batches(batches, *, length: int):
    """(key, n_passage, runs): of each text, the bytes in covered strings and
    the covered runs of ``length`` bytes and more."""
    import pyarrow as pa

    kind = pa.list_(pa.struct([("lo", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        sizes, runs = [], []
        for covered in batch.column("covered"):
            own: list[list[int]] = []
            for lo, end in sorted(zip(covered.values.field("lo").to_pylist(), covered.values.field("end").to_pylist())):
                if own and lo <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], end)
                else:
                    own.append([lo, end])
            sizes.append(sum(end - lo for lo, end in own))
            runs.append([{"lo": lo, "end": end} for lo, end in own if end - lo >= length])
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int64()), pa.array(runs, kind)], names=["key", "n_passage", "runs"])


def _round(rows: DataFrame, length: int, last: bool):
    """(covered, open) of one round: the stretches that repeat as a whole, and
    one place of each different stretch whose core occurs in another one. Both
    read the second frame, ``rows`` is deleted."""
    placed = rows.withColumn("place", F.xxhash64("key", "a"))
    names = stored(
        placed.groupBy("core", "full").agg(F.min("place").alias("one"), F.max("place").alias("other")), "repeats-names"
    )
    several = names.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core", F.lit(True).alias("several"))
    several = stored(several, "repeats-cores")
    marked = stored(names.join(several.hint("merge"), "core", "left").where("one != other OR several"), "repeats-marked")
    forget(names, several)
    found = placed.join(marked.hint("merge"), ["core", "full"])
    found = stored(found.select("key", "a", "lo", "hi", "place", "one", "other", "several"), "repeats-found")
    forget(marked, rows)
    covered = found.where("one != other").select("key", "lo", (F.col("hi") + length).alias("end"))
    return covered, None if last else found.where("several AND place = one").select("key", "a", "lo", "hi"), found


def _covered_strings(texts: DataFrame, length: int) -> DataFrame:
    """(key, covered): for each text with a repeated string the list of (lo,
    end) of all of them; ``texts`` has key, text and names or runs."""
    stretches = stored(texts.mapInArrow(partial(_anchor_batches, length=length), STRETCH), "repeats-anchors")
    covered, open_, found = _round(stretches, length, False)
    parts, done = [covered], [found]
    for group in (GROUP, 1):
        places = open_.groupBy("key").agg(F.collect_list(F.struct("a", "lo", "hi")).alias("open"))
        split = partial(_split_batches, length=length, group=group)
        stretches = stored(texts.select("key", "text").join(places.hint("merge"), "key").mapInArrow(split, STRETCH), f"repeats-groups-{group}")
        covered, open_, found = _round(stretches, length, group == 1)
        parts.append(covered)
        done.append(found)
    covered = parts[0].unionByName(parts[1]).unionByName(parts[2])
    ranges = stored(covered.groupBy("key").agg(F.collect_list(F.struct("lo", "end")).alias("covered")), "repeats-covered")
    forget(*done)
    return ranges


def repeated_texts(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 400, shorter: int | None = None):
    """(rows, cut): ``rows`` has for each row of ``docs`` its id, key (names
    equal texts), n_bytes and sha256; ``cut`` has for each key its copies and,
    if it holds a repeated string, n_removed, n_spans, kept (the remaining
    bytes) and rest (the text they make), and n_passage, the bytes covered by
    repeated strings of ``shorter`` bytes (of ``length``, if none is given)."""
    scan = length if shorter is None else shorter
    if not MIN_LENGTH <= scan <= length:
        raise ValueError(f"lengths must be {MIN_LENGTH} at least, and the shorter one not above the other")
    value = F.coalesce(F.col(text), F.lit(""))
    plain = docs.select(F.col(id).alias("id"), value.alias("text")).withColumn("key", F.xxhash64("text"))
    rows = stored(
        plain.select("id", "key", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha256")),
        "repeats-rows",
    )
    texts = stored(rows.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "repeats-keys")
    long = plain.where(F.octet_length("text") >= scan)
    first = stored(long.select("key", "text").mapInArrow(partial(_first_batches, length=scan), "key bigint, name bigint"), "repeats-first")
    # written first: a join of two shuffles is split by Spark where a name is very frequent
    twice = stored(first.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "repeats-twice")
    touched = first.join(twice.hint("merge"), "name", "left_semi").groupBy("key").agg(F.collect_set("name").alias("names"))
    chosen = texts.select(F.col("id").alias("first_id"), "key").join(touched.hint("merge"), "key").withColumnRenamed("key", "first_key")
    chosen = stored(chosen, "repeats-chosen")
    forget(first, twice)
    # one text of each key; its id may be null
    moved = long.join(chosen.hint("merge"), (F.col("key") == F.col("first_key")) & F.col("id").eqNullSafe(F.col("first_id")))
    moved = moved.select("key", "text", "names").mapInArrow(first_of_each, "key bigint, text string, names array<bigint>")
    moved = stored(moved, "repeats-texts")
    forget(chosen)
    ranges = _covered_strings(moved, scan)
    runs = ranges.mapInArrow(partial(_run_batches, length=length), "key bigint, n_passage bigint, runs array<struct<lo: bigint, end: bigint>>")
    runs = stored(runs, "repeats-runs")
    if scan < length:
        forget(ranges)
        inside = moved.select("key", "text").join(runs.where("size(runs) > 0").select("key", "runs").hint("merge"), "key")
        inside = stored(inside, "repeats-inside")
        ranges = _covered_strings(inside, length)
        forget(inside)
    cut = moved.select("key", "text").join(ranges.hint("merge"), "key").mapInArrow(_cut_batches, "key bigint, n_removed bigint, n_spans bigint, kept binary, rest string")
    known = texts.select("key", "copies").join(cut.dropDuplicates(["key"]), "key", "left").join(runs.select("key", "n_passage"), "key", "left")
    known = stored(known, "repeats-cut")
    forget(moved, ranges, runs, texts)
    return rows, known


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 400, shorter: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: the id, n_bytes, n_removed, n_spans,
    kept (the remaining bytes; null if nothing went), sha256 (of the remaining
    bytes) and n_passage (bytes covered by strings of ``shorter`` bytes that
    also start elsewhere; they stay)."""
    rows, cut = repeated_texts(docs, id, text, length, shorter)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    kept = F.when(whole, F.lit(b"")).otherwise(F.col("kept"))
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= (length if shorter is None else shorter))
    return rows.join(cut, "key", "left").select(
        F.col("id").alias(id),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        kept.alias("kept"),
        F.when(kept.isNull(), F.col("sha256")).otherwise(F.sha2(kept, 256)).alias("kept_sha256"),
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_passage", F.lit(0))).alias("n_passage"),
    )


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """``docs`` with each text replaced by what is left of it; a null text
    stays null. Characters that lost some of their bytes go."""
    rows, cut = repeated_texts(docs, id, text, length)
    forget(rows)
    cut = cut.select(F.col("key").alias("__key"), F.col("copies").alias("__copies"), F.col("rest").alias("__rest"))
    value = F.col(text)
    left = F.when((F.col("__copies") > 1) & (F.octet_length(text) >= length), F.lit("")).otherwise(F.coalesce("__rest", value))
    joined = docs.withColumn("__key", F.xxhash64(F.coalesce(value, F.lit("")))).join(cut, "__key", "left")
    return joined.withColumn(text, F.when(value.isNotNull(), left)).select(*docs.columns)
