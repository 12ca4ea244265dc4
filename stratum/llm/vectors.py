"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are compared only within a label. Equal vectors are one class from the
start. Every class's vector is normalised and projected on Gaussian
directions; a table's key is made of ``hashes`` values floor((a.v + b) /
``width``), and ``tables`` keys are used. Two unit vectors of cosine 0.93 lie
0.374 apart and share one value with probability 0.85, so with 16 values and 72
tables a pair at the threshold is missed with probability 0.004 (a closer one
less); vectors at right angles meet in a table with probability 1e-5.

Classes that share a key meet in blocks: a bucket of n classes is cut into
ceil(n / ``block``) parts and every pair of parts is one small matrix product
of exact cosines in double precision. A block counts a pair only if the table
is the first in which the two meet, so no pair is counted twice, and returns
one row for each class: its links and the smallest class it is connected with
in this block. Pairs are never written out, and a bucket with a third of all
rows is many blocks. Connected components then follow from the blocks' edges
(at most one for each class and block) by repeated joins.

Many vectors about one place would share a bucket in nearly every table, and
all their parts would meet in each. So the classes of a bucket of several parts
are first compared with one class of it, their lead: two vectors that both lie
within half the threshold's angle of a third are near by the triangle
inequality. Such a *ball* is counted as a whole, without comparing its members,
a class is in one ball at most, and in every bucket the classes of its largest
ball meet only the others. The lead step is repeated a few times for what is
left; a bucket that is one ball costs its size, whatever that is. A wider
cluster of n classes in no ball still costs n * n / ``block`` rows a table.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors with a null label, have no links; vectors of different
length are never linked; rows with equal ids are separate members of their
class; an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import forget, stored
from stratum.llm.components import connected

TABLES, HASHES, WIDTH = 72, 16, 2.0
#: Buckets of up to so many classes are compared many at a time.
SMALL = 16
#: Lead steps; more find more balls, results are the same.
ROUNDS = 4


def _keys(vectors, tables: int, hashes: int, width: float, seed: int = 1):
    """The tables' keys of unit vectors: int64[n, tables]."""
    import numpy as np

    rng = np.random.default_rng([seed, vectors.shape[1]])
    directions = rng.standard_normal((vectors.shape[1], tables * hashes))
    shift = rng.uniform(0, width, tables * hashes)
    cells = np.floor((vectors @ directions + shift) / width).astype(np.int64).reshape(len(vectors), tables, hashes)
    key = np.full((len(vectors), tables), 0x1234567, np.int64)
    with np.errstate(over="ignore"):
        for i in range(hashes):
            key = (key ^ cells[:, :, i]) * np.int64(0x5851F42D4C957F2D)
            key ^= key >> np.int64(29)
    return key


def _unit(values):
    import numpy as np

    matrix = np.asarray(values, np.float64)
    # scaled first, so that no square overflows or vanishes
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _key_batches(batches, *, tables: int, hashes: int, width: float):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            values = part.column("vector").to_pylist()
            keys = np.zeros((len(values), tables), np.int64)
            for size in {len(v) for v in values}:
                own = [i for i, v in enumerate(values) if len(v) == size]
                keys[own] = _keys(_unit([values[i] for i in own]), tables, hashes, width, size)
            lists = pa.ListArray.from_arrays(pa.array(range(0, keys.size + 1, tables), pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("class"), lists], names=["class", "keys"])


def _ball_batches(batches, *, radius: float):
    """The classes whose cosine with their lead is ``radius`` at least."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            own, lead = part.column("vector").to_pylist(), part.column("lead_vector").to_pylist()
            near = np.zeros(part.num_rows, bool)
            for size in {len(v) for v in own}:
                at = [i for i, v in enumerate(own) if len(v) == size]
                near[at] = np.einsum("ij,ij->i", _unit([own[i] for i in at]), _unit([lead[i] for i in at])) >= radius
            inside = part.filter(pa.array(near))
            yield pa.RecordBatch.from_arrays([inside.column("class"), inside.column("lead")], names=["class", "ball"])


def _block(a, b, ka, kb, ca, cb, ma, mb, ba, bb, table: int, same: bool, threshold: float):
    """One pair of parts of one bucket: (class, links, low) of its classes;
    links inside a ball are left out."""
    import numpy as np

    links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    near = np.zeros((len(a), len(b)), bool)
    for i in range(0, len(a), 512):
        hit = a[i : i + 512] @ b.T >= threshold
        if same:
            hit &= ca[i : i + 512, None] != cb[None, :]
        hit &= (ba[i : i + 512, None] != bb[None, :]) | (bb < 0)[None, :]
        near[i : i + 512] = hit
        rows, cols = np.nonzero(hit)
        for j in range(0, len(rows), 1 << 16):
            r, c = rows[j : j + (1 << 16)] + i, cols[j : j + (1 << 16)]
            first = ~(ka[r, :table] == kb[c, :table]).any(axis=1)
            links_a += np.bincount(r[first], mb[c[first]], len(a)).astype(np.int64)
            if not same:
                links_b += np.bincount(c[first], ma[r[first]], len(b)).astype(np.int64)
    # components inside the block: the smallest class travels along the links
    low_a, low_b = ca.copy(), cb.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(low_a, np.where(near, low_b[None, :], top).min(axis=1, initial=top))
        new_b = np.minimum(low_b, np.where(near, new_a[:, None], top).min(axis=0, initial=top))
        if same:
            new_a = new_b = np.minimum(new_a, new_b)
        if (new_a == low_a).all() and (new_b == low_b).all():
            break
        low_a, low_b = new_a, new_b
    yield ca, links_a, low_a
    if not same:
        yield cb, links_b, low_b


def _buckets(rows: dict, threshold: float):
    """(class, links, low) of whole buckets of vectors of one length. Small
    ones, by far the most, are compared together: row i with row i + d."""
    import numpy as np

    n = len(rows["class"])
    new = np.zeros(n, bool)
    new[0] = True
    for name in ("place", "t", "key", "i", "j"):
        new[1:] |= rows[name][1:] != rows[name][:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.r_[start, n])
    group = np.cumsum(new) - 1
    small = (size <= SMALL) & (rows["i"][start] == rows["j"][start])
    unit = _unit(rows["vector"])
    keys, members, names, balls = rows["keys"], rows["members"], rows["class"], rows["ball"]
    left = np.where(small[group], (start + size)[group] - 1 - np.arange(n), 0)  # rows that follow in the bucket
    for d in range(1, SMALL):
        x = np.flatnonzero(left >= d)
        if not len(x):
            break
        y = x + d
        hit = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
        hit &= (balls[x] != balls[y]) | (balls[x] < 0)
        x, y = x[hit], y[hit]
        met = (keys[x] == keys[y]) & (np.arange(keys.shape[1])[None, :] < rows["t"][x][:, None])
        first = ~met.any(axis=1)
        low = np.minimum(names[x], names[y])
        yield names[x], np.where(first, members[y], 0), low
        yield names[y], np.where(first, members[x], 0), low
    for g in np.flatnonzero(~small):
        own = slice(start[g], start[g] + size[g])
        side = rows["side"][own]
        parts = [np.flatnonzero(side != 1) + start[g], np.flatnonzero(side != 0) + start[g]]
        same = bool((side == 2).all())
        pairs = ((v[parts[0]], v[parts[1]]) for v in (unit, keys, names, members, balls))
        yield from _block(*(v for pair in pairs for v in pair), int(rows["t"][start[g]]), same, threshold)


NUMBERS = ("place", "dim", "t", "key", "i", "j", "side", "class", "members", "ball")


def _bucket_batches(batches, *, threshold: float):
    """Rows sorted by bucket; a bucket that a batch leaves open waits for the next."""
    import numpy as np
    import pyarrow as pa

    def found(table):
        numbers = {name: table.column(name).to_numpy().astype(np.int64) for name in NUMBERS}
        for dim in np.unique(numbers["dim"]):
            own = np.flatnonzero(numbers["dim"] == dim)
            part = table.take(pa.array(own)).combine_chunks()
            rows = {name: v[own] for name, v in numbers.items()}
            for name in ("vector", "keys"):
                rows[name] = part.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
            for names, links, low in _buckets(rows, threshold):
                some = (links > 0) | (low != names)
                if some.any():
                    columns = [pa.array(v[some].astype(np.int64)) for v in (names, links, low)]
                    yield pa.RecordBatch.from_arrays(columns, names=["class", "links", "low"])

    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if waiting is None else pa.concat_tables([waiting, table])
        last = np.ones(table.num_rows, bool)
        for name in ("place", "t", "key", "i", "j"):
            values = table.column(name).to_numpy()
            last &= values == values[-1]
        whole = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if whole:
            yield from found(table.slice(0, whole))
        waiting = table.slice(whole)
    if waiting is not None:
        yield from found(waiting)


BUCKET = ["label", "dim", "t", "key"]


def _balls(classes: DataFrame, inside: DataFrame, threshold: float, block: int) -> DataFrame:
    """(class, ball): the classes that lie within half the threshold's angle of
    their ball's lead; ``inside`` has the places (bucket, class) in buckets of
    several parts."""
    # a little inside of half the angle, so that no rounding links what is not near
    radius = ((1 + threshold) / 2) ** 0.5 + 1e-9
    vectors = classes.select("class", "vector")
    balls = inside.sparkSession.createDataFrame([], "class bigint, ball bigint")
    for step in range(ROUNDS):
        leads = inside.groupBy(BUCKET).agg(F.min("class").alias("lead"), F.count("*").alias("n")).where(F.col("n") > block)
        leads = stored(leads.drop("n"), f"vector-leads-{step}")
        if leads.isEmpty():
            break
        # the same lead for as many as possible, whatever table they meet in
        chosen = stored(inside.join(leads.hint("merge"), BUCKET).groupBy("class").agg(F.min("lead").alias("lead")), f"vector-led-{step}")
        pairs = chosen.join(vectors.hint("merge"), "class").join(
            vectors.select(F.col("class").alias("lead"), F.col("vector").alias("lead_vector")).hint("merge"), "lead"
        )
        found = stored(pairs.mapInArrow(partial(_ball_batches, radius=radius), "class bigint, ball bigint"), f"vector-balls-{step}")
        balls = balls.unionByName(found)
        forget(leads, chosen)
        inside = stored(inside.join(found.select("class").hint("merge"), "class", "left_anti"), f"vector-left-{step}")
    return balls


def near_vectors(
    rows: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    block: int = 1000,
) -> DataFrame:
    """One row per vector: the id, n_links, component_id and kept."""
    doubles = F.col(vector).cast("array<double>")
    usable = (
        F.col(label).isNotNull()
        & F.coalesce(F.size(doubles) > 0, F.lit(False))
        & F.coalesce(F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
        & F.coalesce(F.exists(doubles, lambda x: x != 0), F.lit(False))
    )
    # -0.0 + 0.0 is 0.0: equal vectors have equal bits
    clean = F.transform(doubles, lambda x: x + 0.0)
    base = rows.select(F.col(id).cast("bigint").alias("id"), F.col(label).alias("label"), F.when(usable, clean).alias("vector"))
    good = base.where("vector IS NOT NULL")
    classes = stored(
        good.groupBy("label", "vector").agg(F.min("id").alias("low"), F.count("*").alias("members"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vector-classes",
    )
    run = partial(_key_batches, tables=tables, hashes=hashes, width=width)
    keys = stored(classes.select("class", "vector").mapInArrow(run, "class bigint, keys array<bigint>"), "vector-keys")
    sized = classes.select("label", "class", F.size("vector").alias("dim"))
    spots = sized.join(keys, "class").select("label", "dim", "class", F.posexplode("keys").alias("t", "key"))
    # written first: a join of two shuffles is split by Spark where a bucket is very large
    counts = stored(spots.groupBy(BUCKET).agg(F.count("*").alias("n")).where("n > 1"), "vector-buckets")
    large = counts.where(F.col("n") > block).select(BUCKET)
    inside = stored(spots.join(large.hint("merge"), BUCKET, "left_semi").select(*BUCKET, "class"), "vector-inside")
    balls = _balls(classes, inside, threshold, block)
    # each large bucket's largest ball
    cores = inside.join(balls.hint("merge"), "class").groupBy(*BUCKET, "ball").agg(F.count("*").alias("n"))
    cores = cores.groupBy(BUCKET).agg(F.max(F.struct("n", "ball")).alias("core")).select(*BUCKET, "core.ball", "core.n")
    cores = cores.select(*BUCKET, F.col("ball").alias("core"), F.col("n").alias("core_n"))
    none = F.lit(0).cast("bigint")
    sizes = counts.join(cores, BUCKET, "left").select(
        *BUCKET,
        "core",
        F.ceil(F.coalesce("core_n", none) / block).cast("int").alias("core_parts"),
        F.ceil((F.col("n") - F.coalesce("core_n", none)) / block).cast("int").alias("rest_parts"),
    )
    sizes = stored(sizes, "vector-sizes")
    # parts of the core are numbered first; of those it meets only what is not core
    in_core = F.coalesce(F.col("ball") == F.col("core"), F.lit(False))
    spread = lambda parts: F.pmod(F.xxhash64("class"), F.greatest(F.col(parts), F.lit(1))).cast("int")
    met = spots.join(sizes.hint("merge"), BUCKET).join(balls.hint("merge"), "class", "left")
    met = met.select(
        *BUCKET,
        "class",
        F.when(in_core, F.col("core_parts")).otherwise(0).alias("from"),
        (F.col("core_parts") + F.col("rest_parts") - 1).alias("to"),
        F.when(in_core, spread("core_parts")).otherwise(F.col("core_parts") + spread("rest_parts")).alias("part"),
    ).where(F.col("from") <= F.col("to"))
    # a class meets its own part (side 2) and, as left or right, every other part
    others = F.transform(
        F.sequence("from", "to"),
        lambda p: F.struct(
            F.least(p, F.col("part")).alias("i"),
            F.greatest(p, F.col("part")).alias("j"),
            F.when(p == F.col("part"), 2).when(F.col("part") < p, 0).otherwise(1).alias("side"),
        ),
    )
    met = met.withColumn("pair", F.explode(others)).select(*BUCKET, "class", "pair.i", "pair.j", "pair.side")
    ball = F.coalesce("ball", F.lit(-1).cast("bigint")).alias("ball")
    data = classes.select("class", "vector", "members").join(keys, "class").join(balls, "class", "left")
    data = data.select("class", "vector", "members", "keys", ball)
    order = ["place", "t", "key", "i", "j"]
    blocks = (
        met.withColumn("place", F.xxhash64("label", "dim"))
        .join(data, "class")
        .select(*NUMBERS, "vector", "keys")
        .repartition(*order)
        .sortWithinPartitions(*order)
    )
    compare = partial(_bucket_batches, threshold=threshold)
    found = stored(blocks.mapInArrow(compare, "class bigint, links bigint, low bigint"), "vector-links")
    # all members of a ball are linked with each other
    placed = stored(balls.join(classes.select("class", "members"), "class"), "vector-placed")
    whole = stored(placed.groupBy("ball").agg(F.sum("members").alias("all"), F.min("class").alias("low")), "vector-wholes")
    balled = placed.join(whole.hint("merge"), "ball").select("class", (F.col("all") - F.col("members")).alias("links"), "low")
    found = found.unionByName(balled)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.where("low != class").select(F.col("class").alias("a"), F.col("low").alias("b")).distinct()
    roots = connected(edges)
    named = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    summary = (
        named.join(low, "root")
        .join(links, "class", "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), "component_id")
    )
    linked = good.join(summary, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = base.where("vector IS NULL").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
