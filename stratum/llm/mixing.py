"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over the training time t in [0, 1], given at
knots and linear between them. Its integral is the source's weight in the whole
mix; its running integral F(t), scaled to F(1) = 1, says which part of the
source's words has been asked for at time t. A source's documents stand in a
fixed pseudo-random order (MD5 of the id), repeated in passes; the word that
completes the part q of the source's target is asked for at t = F^-1(q), which
becomes the document's training position. Documents are range-sorted by it.

Targets share the wanted total by weight; a target above ``max_passes`` times
its source's size stops there and the excess is shared again by weight among
the others until none is above. The last document that a source's target
reaches is taken in part (``taken`` words of it), so a source's words equal its
target rounded down.

Running sums never gather a source in one task: documents fall into buckets by
the leading bits of their order key, bucket totals are summed first, and each
bucket (about ``bucket_rows`` documents) is summed on its own. Rows of equal
source, id and size are one row with a number of copies until the end, so an id
(or null) that a third of all rows have is not gathered either.

Defined results: a null source is a source of its own, last in order; a null
text has size 0 and is never taken; rows of one id stand next to each other, by
size; an empty table gives no rows. Of each source a summary row passes the
driver (100,000 sources are tested); documents do not.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import copies, let, stored

#: What separates words: space and the ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: A schedule: (time, weight) knots, times ascending from 0 to 1.
Schedule = Sequence[tuple[float, float]]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def integral(schedule: Schedule) -> float:
    """The schedule's weight over the whole training time."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def share_out(sizes: Sequence[int], weights: Sequence[float], total: float, max_passes: int) -> list[float]:
    """Targets by weight, none above ``max_passes`` times its size: whatever is
    above is shared again by weight among the sources still below."""
    targets, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        weight = math.fsum(weights[i] for i in sorted(open_))
        if weight <= 0:
            break
        over = [i for i in sorted(open_) if left * weights[i] / weight >= max_passes * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in over:
            targets[i] = float(max_passes * sizes[i])
            open_.discard(i)
        left = total - math.fsum(targets)
    return targets


PIECES = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("t0", "span", "w0", "slope", "below", "upto")]))


def pieces(schedule: Schedule) -> list[tuple[float, ...]]:
    """(t0, span, w0, slope, below, upto) of each piece between two knots:
    where it begins, how long it is, its weight there and how that grows, and
    the integral up to its begin and end."""
    out, below = [], integral(schedule)
    for (t0, w0), (t1, w1) in reversed(list(zip(schedule, schedule[1:]))):
        area = (t1 - t0) * (w0 + w1) / 2
        below -= area
        out.append((float(t0), float(t1 - t0), float(w0), float((w1 - w0) / (t1 - t0)), float(below), float(below + area)))
    return out[::-1]


def inverse_demand(schedule: Schedule, q: Column) -> Column:
    """t with F(t) = q for the schedule's scaled running integral F."""
    names = PIECES.elementType.names
    table = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, piece))) for piece in pieces(schedule)))
    return _inverse(q * integral(schedule), table)


def _inverse(asked: Column, table: Column) -> Column:
    """The time at which the integral of the pieces in ``table`` is ``asked``:
    on each piece it is a quadratic, solved in closed form."""

    def solved(p: Column) -> Column:
        need = F.greatest(asked - p["below"], F.lit(0.0))  # area asked for inside this piece
        # w0*x + slope*x^2/2 = need; this form of the root also holds for slope 0
        root = F.sqrt(F.greatest(p["w0"] * p["w0"] + 2 * p["slope"] * need, F.lit(0.0)))
        x = F.when(root + p["w0"] > 0, 2 * need / (root + p["w0"])).otherwise(F.lit(0.0))
        return p["t0"] + F.least(x, p["span"])

    first = F.get(F.filter(table, lambda p: asked <= p["upto"]), F.lit(0))
    return F.coalesce(let(first, solved), F.lit(1.0))


def allot(
    docs: DataFrame,
    schedule_of: Callable[[int], Schedule],
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    max_passes: int = 3,
    bucket_rows: int = 5_000,
) -> DataFrame:
    """One row per document: the id, source, size, source_size, target and
    ``passes``, the array of (pass, taken, position) in which the mix takes it:
    the pass from 0, the words taken in it and its training time.
    ``schedule_of(rank)`` is the schedule of the source with that rank by code
    point, null last."""
    spark = docs.sparkSession
    sized = docs.select(F.col(id).alias("__id"), F.col(source).cast("string").alias("__source"), word_count(F.col(text)).alias("__size"))
    sized = stored(sized.groupBy("__source", "__id", "__size").agg(F.count("*").alias("__n")), "mix-sizes")
    words = F.sum(F.col("__size") * F.col("__n"))
    stats = sized.groupBy("__source").agg(words.alias("size"), F.count("*").alias("n")).collect()
    stats.sort(key=lambda r: (r["__source"] is None, (r["__source"] or "").encode()))
    schedules = [schedule_of(i) for i in range(len(stats))]
    weights = [integral(s) for s in schedules]
    targets = share_out([r["size"] for r in stats], weights, sum(r["size"] for r in stats), max_passes)
    bits = max(0, math.ceil(math.log2(max([1, *(r["n"] for r in stats)]) / bucket_rows)))
    plan = spark.createDataFrame(
        [(_name(r["__source"]), r["size"], t, w, pieces(s)) for r, t, w, s in zip(stats, targets, weights, schedules)],
        T.StructType([T.StructField("__name", T.StringType()), T.StructField("__source_size", T.LongType()), T.StructField("__target", T.DoubleType()),
                      T.StructField("__whole", T.DoubleType()), T.StructField("__pieces", PIECES)]),
    )
    key = F.md5(F.coalesce(F.col("__id").cast("string"), F.lit("")).cast("binary"))
    bucket = F.conv(F.substring("__key", 1, 8), 16, 10).cast("bigint").bitwiseAND((1 << 32) - (1 << (32 - bits)))
    # a name that is never null: equal joins can then use the windows' partitioning
    name = F.coalesce(F.concat(F.lit("s"), F.col("__source")), F.lit("n"))
    ordered = sized.withColumn("__key", key).withColumn("__bucket", bucket).withColumn("__name", name)
    keys = ["__name", "__bucket"]
    totals = ordered.groupBy(keys).agg(words.alias("__sum"))
    # one row per source and bucket: a few rows for every bucket_rows documents
    before = (F.sum("__sum").over(Window.partitionBy("__name").orderBy("__bucket")) - F.col("__sum")).alias("__before")
    before = totals.select(*keys, before).join(plan, "__name")
    in_bucket = Window.partitionBy(keys).orderBy("__key", "__id", "__size")
    upto = F.sum(F.col("__size") * F.col("__n")).over(in_bucket.rowsBetween(Window.unboundedPreceding, 0))
    rows = ordered.withColumn("__upto", upto).join(before, keys)
    begin = F.col("__before") + F.col("__upto") - F.col("__size") * F.col("__n")
    rows = rows.select("__id", "__source", "__size", "__n", begin.alias("__begin"), "__source_size", "__target", "__whole", "__pieces")
    rows = copies(rows, "__n", "__copy")
    start = F.col("__begin") + F.col("__copy") * F.col("__size")
    passes = F.transform(
        F.sequence(F.lit(0), F.lit(max_passes - 1)),
        lambda p: F.struct(
            p.alias("pass"),
            F.least(F.col("__size"), F.greatest(F.lit(0), F.floor("__target") - start - p * F.col("__source_size")))
            .cast("bigint")
            .alias("taken"),
        ),
    )

    def timed(p: Column) -> Column:
        q = (start + p["pass"] * F.col("__source_size") + p["taken"]) / F.col("__target")
        return F.struct(p["pass"].alias("pass"), p["taken"].alias("taken"), _inverse(q * F.col("__whole"), F.col("__pieces")).alias("position"))

    return rows.select(
        F.col("__id").alias(id),
        F.col("__source").alias(source),
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.transform(F.filter(passes, lambda p: p["taken"] > 0), timed).alias("passes"),
    )


def _name(source: str | None) -> str:
    return "n" if source is None else "s" + source


def mixed(docs: DataFrame, schedule_of: Callable[[int], Schedule], id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` in training order, each as often as the mix takes
    it: a pass counts if it takes at least half of the document's words, and
    then the document is whole. Rows with equal id, source and size count
    alike."""
    plan = allot(docs, schedule_of, id, text, source, **options)
    plan = plan.groupBy(id, source, "size").agg(F.min("passes").alias("passes"))
    plan = plan.select(
        F.col(id).alias("__id"),
        F.col(source).alias("__source"),
        F.col("size").alias("__planned"),
        F.explode(F.filter("passes", lambda p: 2 * p["taken"] >= F.col("size"))).alias("__pass"),
    )
    same = F.col(id).eqNullSafe(F.col("__id")) & F.col(source).cast("string").eqNullSafe(F.col("__source")) & (F.col("__size") == F.col("__planned"))
    rows = docs.withColumn("__size", word_count(F.col(text))).join(stored(plan, "mix-plan"), same)
    return rows.orderBy("__pass.position", id).select(*docs.columns)


def curriculum(rank: int) -> Schedule:
    """Weights 5, 2, 1, repeating by rank. Heavy sources fade over the training
    and light ones grow; each integral is the weight itself."""
    weight, tilt = ((5.0, -0.5), (2.0, 0.0), (1.0, 0.5))[rank % 3]
    return [(0.0, weight * (1 - tilt)), (1.0, weight * (1 + tilt))]
