"""Filter interaction audit: what each filter removes in every order.

A document is described by the mask of filters that it fails. In a given order
of the filters it is removed at the first step whose filter is in its mask. In
lexicographic order of the permutations, those that begin with the same filters
are neighbours (their Lehmer ranks differ in the last digits only): a prefix of
s filters covers an interval of (k - s)! ranks. So a mask is removed at step s
exactly in the intervals of the prefixes that reach it with their last filter.
Counts by mask are added at the start of each interval and taken off at its
end, in one difference array for each part and step; its prefix sum gives the
documents removed at that step in each of the k! orders.

Documents are only ever counted by (part, mask): one narrow shuffle finds equal
texts, one brings the labels; all that follows is 2^k rows a part and k! * k a
part in the result. Texts are not shuffled, equal ones meet by their SHA-256.

Defined results: null text counts as empty (and equals it), null part as the
empty string; a null id is neither smaller nor larger than others, so filter E
never removes its row; rows of equal id and text don't fail E through each
other; several label rows of one id count as one, good or toxic if any says so;
an empty table gives no rows; columns besides the named ones are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored

FILTERS = "ABCDE"
#: Blanks between words.
BLANK = r"[\x20\x09-\x0D]+"
#: More filters make more orders than a report is for (7: 5,040).
MAX_FILTERS = 7


def removal_intervals(k: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, end): the ranks of the orders of ``k`` filters in
    which a document of this mask is removed at this step (end excluded)."""
    out = []
    for step in range(1, k + 1):
        width = math.factorial(k - step)
        for at, prefix in enumerate(itertools.permutations(range(k), step)):  # in lexicographic order
            free = [b for b in range(k) if b not in prefix]  # filters that come later may fail or not
            for more in itertools.product((0, 1), repeat=len(free)):
                mask = 1 << prefix[-1] | sum(m << b for m, b in zip(more, free))
                out.append((mask, step, at * width, (at + 1) * width))
    return out


def audit(masks: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from ``masks``:
    rows of (part, mask, n, good, toxic), bit i of the mask for filters[i].

    part, filter_order, step, kept (after the step), removed, redundant
    (failing its filter, removed earlier), unique_fails (failing its filter
    only), good_lost, toxic_lost, shapley (removed by its filter, summed over
    all orders)."""
    k = len(filters)
    if not 1 <= k <= MAX_FILTERS:
        raise ValueError(f"one to {MAX_FILTERS} filters, not {k}")
    spark = masks.sparkSession
    counts = ("n", "good", "toxic")
    orders = math.factorial(k)
    masks = masks.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in counts))
    intervals = F.broadcast(spark.createDataFrame(removal_intervals(k), "mask int, step int, start int, end int"))
    ends = F.explode(F.array(F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign"))))
    deltas = masks.join(intervals, "mask").select("part", "step", ends.alias("e"), *counts)
    deltas = deltas.select("part", "step", "e.rank", *((F.col("e.sign") * F.col(c)).alias(c) for c in counts))
    bits = [F.shiftright("mask", i).bitwiseAND(1) == 1 for i in range(k)]
    totals = masks.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*(F.sum(F.when(b, F.col("n")).otherwise(0)) for b in bits)).alias("fails"),
        F.array(*(F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(k))).alias("only"),
    )
    # every rank and step once with nothing, so that no row is missing
    zeros = totals.select("part", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"))
    zeros = zeros.select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"), "rank", *(F.lit(0).cast("bigint").alias(c) for c in counts))
    array = deltas.unionByName(zeros).groupBy("part", "step", "rank").agg(*(F.sum(c).alias(c) for c in counts))
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = array.select("part", "step", "rank", *(F.sum(c).over(upto).alias(c) for c in counts)).where(F.col("rank") < orders)
    steps = [
        (rank, step + 1, "".join(filters[i] for i in order), order[step])
        for rank, order in enumerate(itertools.permutations(range(k)))
        for step in range(k)
    ]
    named = summed.join(F.broadcast(spark.createDataFrame(steps, "rank int, step int, filter_order string, filter int")), ["rank", "step"]).join(totals, "part")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return named.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"),
        (F.get("fails", F.col("filter")) - F.col("n")).alias("redundant"),
        F.get("only", F.col("filter")).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def text_masks(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic) of the five filters: A under 100 words, B
    under 80 % distinct words, C over 10 % capitals A-Z, D a character of
    ``#$%&*|``, E a text that a smaller id has too."""
    plain = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    split = plain.withColumn("words", F.array_remove(F.split("text", BLANK), ""))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    fails = (n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * F.length("text"), F.col("text").rlike("[#$%&*|]"))
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    rows = stored(split.select("id", "part", F.unhex(F.sha2("text", 256)).alias("key"), mask.cast("int").alias("mask")), "audit-rows")
    # written first: the joins then shuffle both sides, and Spark splits a text or an id with very many rows
    firsts = rows.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    rows = rows.join(stored(firsts, "audit-copies").hint("merge"), "key", "left")
    rows = rows.select("id", "part", (F.col("mask") + F.when(F.col("id") > F.col("first"), 1 << 4).otherwise(0)).alias("mask"))
    said = labels.groupBy(F.col(id).alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = rows.join(stored(said, "audit-labels").hint("merge"), "id", "left")
    one = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c)
    return stored(rows.groupBy("part", "mask").agg(F.count("*").alias("n"), one("good"), one("toxic")), "audit-masks")
