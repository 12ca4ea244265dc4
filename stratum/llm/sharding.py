"""Sharding by vector bin packing over bytes, tokens and rows.

Equal texts form a group that stays together, unless it holds more than half of
a shard's share of bytes, tokens or rows (one group may hold a third of all
rows): then it is split into pieces of at most about a quarter. A group of more
than 1 / ``fine`` of a shard's share is packed as an item of its own; the many
small groups are bundled with groups of their own kind (near equal bytes a row,
near equal tokens a byte), so that a bundle is as heavy in one resource and
light in another as its groups are. A kind gets bundles by its share, some
``fine`` per shard in all. So at most a few times ``fine * shards``
items exist however large the input is, and only they are packed on the
driver: in descending order of size, each item goes to the shard where the dot
product of its (bytes, tokens, rows) with the shard's residual capacity, all
in parts of the totals, is highest among the shards in which it still fits
(the one with most bytes left if it fits nowhere).

The last items are the smallest, so shards end near equal in all three
resources. A row's slot is its rank in its shard by id, computed from bucket
counts and ranks inside buckets of about ``bucket_rows`` rows: no shard is ever
gathered in one task. Rows of equal id and text are one row with a number of
copies until the end; the copies of a split group are dealt evenly to its
pieces, whether its ids differ or not.

Defined results: a null text counts no bytes and no tokens, and all null texts
are one group; the same input gives the same shards; an empty table gives no
rows; equal ids get different slots.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import copies, stored

#: A group of up to this part of a shard is never split.
WHOLE = 0.5
#: Bytes that a row takes besides its text.
ROW_BYTES = 16


def pack(items: list[tuple[float, float, float]], shards: int) -> list[int]:
    """The shard of each item (bytes, tokens, rows)."""
    import numpy as np

    sizes = np.array(items, float).reshape(-1, 3)
    total = sizes.sum(axis=0)
    sizes = sizes / np.where(total > 0, total, 1) * shards  # one shard's share is 1 of each
    left = np.ones((shards, 3))
    out = [0] * len(items)
    # by falling size; equal sizes by position, so reruns agree
    for i in sorted(range(len(items)), key=lambda i: (-sizes[i].max(), i)):
        fits = (left >= sizes[i] - 1e-12).all(axis=1)
        score = np.where(fits, left @ sizes[i], -np.inf)
        at = int(score.argmax()) if fits.any() else int(left[:, 0].argmax())
        left[at] -= sizes[i]
        out[i] = at
    return out


def shard(
    docs: DataFrame,
    shards: int,
    id: str = "doc_id",
    text: str = "text",
    fine: int = 200,
    bucket_rows: int = 10_000,
) -> DataFrame:
    """One row per document: the id, size (bytes of the text plus 16), tokens
    (blank-separated words), text_crc32, shard and slot."""
    words = F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0))
    rows = docs.select(
        F.col(id).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.when(F.col(text).isNull(), 0).otherwise(words).cast("bigint").alias("tokens"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("text_hash"),
    ).withColumn("group", F.xxhash64("text_hash", "size", "text_crc32"))
    rows = stored(rows.groupBy("id", "size", "tokens", "text_crc32", "group").agg(F.count("*").alias("n")), "shard-rows")
    sums = [F.sum(F.col("size") * F.col("n")).alias("s"), F.sum(F.col("tokens") * F.col("n")).alias("t"), F.sum("n").alias("n")]
    total = rows.agg(*sums).first()
    # what a group or kind takes of one shard's share, in the resource where that is most
    part = F.greatest(*(F.col(c) / F.lit(max(1, total[c] or 0) / shards) for c in ("s", "t", "n")))
    # at most 3 * shards * fine groups are large: each holds that part of one resource
    large = rows.groupBy("group").agg(*sums).withColumn("part", part).where(F.col("part") > 1 / fine)
    large = large.select("group", F.when(F.col("part") <= WHOLE, 1).otherwise(F.ceil(2 / WHOLE * F.col("part"))).cast("int").alias("parts"))
    rows = rows.join(F.broadcast(large), "group", "left")
    # equal texts are of one kind: bytes to a power of two, tokens a byte to an eighth (at most 63 * 9 kinds)
    kind = (F.floor(F.log2("size")) * 16 + F.least(F.floor(8 * F.col("tokens") / F.col("size")), F.lit(8))).cast("int")
    rows = rows.withColumn("kind", kind)
    kinds = rows.where("parts IS NULL").groupBy("kind").agg(*sums).select("kind", F.ceil(part * fine).cast("bigint").alias("bundles"))
    rows = rows.join(F.broadcast(kinds), "kind", "left")
    # copies j of n go to the share j mod k, shares to pieces in turn
    k = F.least("n", "parts")
    share = F.when(F.col("parts") > 1, F.sequence(F.lit(0).cast("bigint"), k - 1)).otherwise(F.array(F.lit(0).cast("bigint")))
    rows = rows.withColumn("share", F.explode(share))
    rows = rows.withColumn("n", F.when(F.col("parts") > 1, F.floor((F.col("n") - F.col("share") + k - 1) / k)).otherwise(F.col("n")).cast("bigint"))
    piece = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("id") + F.col("share"), F.col("parts").cast("bigint")) + 1).otherwise(0)
    bundle = F.col("kind").cast("bigint") * (1 << 32) + F.pmod("group", "bundles")
    rows = rows.withColumn("piece", piece.cast("int")).withColumn("item", F.when(F.col("piece") > 0, F.col("group")).otherwise(bundle))
    items = rows.groupBy("item", "piece").agg(*sums).orderBy("item", "piece").collect()
    spark = docs.sparkSession
    placed = spark.createDataFrame(
        [(r["item"], r["piece"], s) for r, s in zip(items, pack([(r["s"], r["t"], r["n"]) for r in items], shards))],
        "item bigint, piece int, shard int",
    )
    rows = rows.join(F.broadcast(placed), ["item", "piece"])
    buckets = max(1, math.ceil((total["n"] or 0) / shards / bucket_rows))
    rows = rows.groupBy("id", "size", "tokens", "text_crc32", "group", "shard").agg(F.sum("n").alias("n"))
    return with_slots(rows, buckets).withColumnRenamed("id", id)


def with_slots(rows: DataFrame, buckets: int) -> DataFrame:
    """A row for each of the ``n`` copies, with ``slot``: gapless from 0 in
    each shard."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.sum("n").alias("sum"))
    before = (F.sum("sum").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("sum")).alias("before")
    before = counts.select("shard", "bucket", before)
    order = Window.partitionBy("shard", "bucket").orderBy("id", "size", "text_crc32", "group")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("upto", upto).join(before, ["shard", "bucket"]).withColumn("from", F.col("before") + F.col("upto") - F.col("n"))
    rows = copies(rows.select("id", "size", "tokens", "text_crc32", "shard", "from", "n"), "n", "copy")
    return rows.withColumn("slot", F.col("from") + F.col("copy")).drop("from", "copy")
