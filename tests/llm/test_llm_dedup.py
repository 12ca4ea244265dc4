"""Repeated strings, near texts, near vectors, components, the pipeline."""

import collections
import random

import brute
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from stratum.llm import components, near_texts, repeats, vectors


def documents(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("length, shorter", [(400, None), (400, 250), (250, None), (120, 50)])
def test_repeats_equal_brute_force(spark, length, shorter):
    rng = random.Random(3)

    def text(n):
        return "".join(rng.choice("abcdefghij é") for _ in range(n))

    p1, p2, p3, per = text(700), text(400), text(398), text(37)
    rows = [(-1, None), (-2, ""), (-3, text(500) + p1 + text(30)), (-4, p1 + text(600)), (-5, text(90) + p1[100:640] + text(4)), (-6, p2), (-7, "xy" + p2 + "q"),
            (-8, p3 + "z"), (-9, p3 + "y"), (-10, per * 60), (-11, "a" * 5000), (-12, "a" * 401), (-13, "b" * 399), (-14, "b" * 399), (-15, "c" * 400),
            (-16, "c" * 400), (-17, text(300) + per * 11), (-18, p1[:450] + "|" + p1[200:]), (-18, p1[:450] + "|" + p1[200:]), (-19, "日本" * 300),
            (-20, "z" + "日本" * 100 + "日x"), (-21, p2[:399]), (-22, text(200000) + p1)]
    rows += [(-1000 - i, text(rng.randrange(300)) + p1[i % 50 : 600 + i % 70] + text(rng.randrange(300))) for i in range(120)]
    docs = documents(spark).unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    docs = docs.withColumn("key", F.lit("clash")).withColumn("kept", F.lit(1))
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.repeats(given, length)
    got = repeats.remove_repeats(docs, length=length, shorter=shorter).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (i, n, removed, spans, brute.sha(kept)) for i, n, removed, spans, kept in want
    )
    passages = want if shorter is None else brute.repeats(given, shorter)
    assert sorted((r.doc_id, r.n_passage) for r in got) == sorted((i, removed) for i, _, removed, _, _ in passages)
    left = {r.doc_id: r.text for r in repeats.without_repeats(docs, length=length).collect()}
    assert left[-1] is None and all(left[i] == kept.decode(errors="ignore") for i, *_, kept in want if i != -1)
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_near_classes_equal_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = [(-1, None), (-2, None), (-3, ""), (-4, ""), (-5, " \n"), (-6, "a b c"), (-7, "a b c"), (-8, "a  b c"), (-9, "a b d"), (-10, "x " * 30000), (-10, "x " * 30000)]
    for i in range(80):  # J straddles the threshold, so classes join through others
        words = list(base)
        for j in rng.sample(range(100), rng.choice([1, 2, 2, 3])):
            words[j] = f"x{rng.randrange(10**6)}"
        rows.append((-100 - i, " ".join(words)))
    cycle = ["a", "b", "c", "d", "e"] * 10
    rows += [(-300, " ".join(cycle)), (-301, " ".join(cycle + ["a"])), (-302, " ".join(cycle * 2))]
    docs = documents(spark).unionByName(spark.createDataFrame(rows, "doc_id bigint, text string")).withColumn("key", F.lit(0))
    want = brute.near_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = near_texts.near_classes(docs, block=20).collect()  # families of several parts, too
    assert len(got) == docs.count()
    assert {r.doc_id: r.class_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    kept = near_texts.without_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())
    assert near_texts.near_classes(docs.limit(0)).count() == 0


def test_words_that_cancel_in_linear_hashes(spark):
    """Thue-Morse words and their complements differ in every byte, and any
    polynomial modulo 2^64 takes them for equal."""
    bits = [bin(i).count("1") & 1 for i in range(1 << 11)]
    one, two = ("".join("EJ"[b ^ flip] for b in bits) for flip in (0, 1))
    rows = [(1, one), (2, two), (3, f"a b c {one} d e f"), (4, f"a b c {two} d e f"), (5, one[:512] + " x"), (6, two[:512] + " x"), (7, one), (8, one[:60] + " y"), (9, two[:60] + " y")]
    got = near_texts.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == brute.near_classes(rows) and sum(r.kept for r in got) == 8
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    for size in (1, 8, 9, 63, 64, 65, 2048):
        at = np.array([0, 2049])
        names = near_texts.word_names(data, at, at + size)
        assert names[0] != names[1]


def test_signatures_estimate_probability_jaccard():
    import pyarrow as pa

    a, b = "p q r s t u v w x y z " * 3 + "1 2 3 4 5 6 7 8 9", "p q r s t u v w x y z " * 2 + "1 2 3 4 5 6 7 8 9"
    owner, shingle, weight = near_texts.weighted_shingles(pa.array([a, b]))
    kept = near_texts.prob_minhash(owner, shingle, weight, 2, 4096)
    exact = brute.probability_jaccard(brute.shingles(a), brute.shingles(b))
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.04
    one, two = owner == 0, owner == 1
    assert near_texts.similarity(shingle[one], weight[one], shingle[two], weight[two]) == pytest.approx(exact)


def brute_links(rows, threshold=0.93):
    classes, links, groups = brute.Classes([i for i, *_ in rows]), collections.Counter(), collections.defaultdict(list)
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            groups[label, len(v)].append((i, v))
    for g in groups.values():
        m = np.array([v for _, v in g], float)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(m @ m.T >= threshold, 1))):
            links[g[a][0]] += 1
            links[g[b][0]] += 1
            classes.union(g[a][0], g[b][0])
    return links, classes


def test_vectors_equal_brute_force(spark):
    given = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    x = given.limit(3).collect()
    rows = [(-1, None, 1), (-2, [0.0] * 64, 1), (-3, [float("nan")] * 64, 1), (-4, x[0].embedding, None), (-5, [2 * v for v in x[1].embedding], x[1].label),
            (-6, [1.0, 2.0], 1), (-7, [2.0, 4.1], 1), (-8, [], 1), (-9, [None] * 64, 1), (-10, [float("inf")] * 3, 2), (-11, [-0.0, 1.0], 3), (-12, [0.0, 1.0], 3)]
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(64)
    rows += [(-100 - i, [float(v) for v in centre + 0.2 * rng.standard_normal(64)], 1) for i in range(150)]
    docs = given.unionByName(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).withColumn("low", F.lit("clash"))
    links, classes = brute_links([(r.vec_id, r.embedding, r.label) for r in docs.collect()])
    got = vectors.near_vectors(docs, block=40).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], classes.find(r.vec_id), classes.find(r.vec_id) == r.vec_id), r
    assert vectors.near_vectors(docs.limit(0)).count() == 0


def test_ball_is_counted_without_comparing(spark):
    """Buckets of many parts: tight clusters (a ball each, one with repeated
    vectors), one as wide as the threshold, and single vectors."""
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centres = unit(rng.normal(size=(3, 24)))
    tight = [unit(centres[i] + 0.01 * rng.normal(size=(n, 24))) for i, n in ((0, 150), (1, 60))]
    wide = unit(centres[2] + 0.035 * rng.normal(size=(120, 24)))
    near = unit(centres[0] + 0.035 * rng.normal(size=(60, 24)))
    vectors_ = [*tight[0], *tight[0][:20], *tight[1], *wide, *near, *unit(rng.normal(size=(30, 24)))]
    rows = [(i, v.tolist(), "a" if i % 7 else "b") for i, v in enumerate(vectors_)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    links, classes = brute_links(rows)
    exact = {i: (links[i], classes.find(i)) for i, *_ in rows}
    for block in (10, 10_000):  # balls, none
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(docs, block=block).collect()}
        assert got == exact
    assert max(links.values()) > 100


def test_work_on_a_ball_grows_with_its_size(spark, monkeypatch):
    """Twice as many vectors about one place give at most some twice as many
    rows to compare, not four times."""
    shipped = []
    kind = type(spark.range(1))
    compare = kind.mapInArrow

    def counting(frame, run, schema):
        if "place" in frame.columns:
            shipped.append(frame.count())
        return compare(frame, run, schema)

    monkeypatch.setattr(kind, "mapInArrow", counting)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    centre /= np.linalg.norm(centre)
    points = centre + 0.01 * rng.normal(size=(800, 16))
    for n in (400, 800):
        rows = [(i, points[i].tolist(), "a") for i in range(n)]
        docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
        links = {r.n_links for r in vectors.near_vectors(docs, block=20).collect()}
        assert links == {n - 1}
    assert len(shipped) == 2 and shipped[1] <= 2.5 * shipped[0] + 100, shipped


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(7, 7), (5, None)]
    edges += [(2000, 2001 + i) for i in range(50)]
    classes = brute.Classes({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if b is not None:
            classes.union(a, b)
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: classes.find(n) for n in got}
    assert set(got) == {x for a, b in edges if b is not None and a != b for x in (a, b)}
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_pipeline_against_brute_force(spark):
    """Each stage's decisions, recomputed from what the stage before it kept."""
    import corpus_pipeline
    import public_tokenizers
    import tiktoken

    from stratum.llm import bpe
    from stratum.llm.common import stored

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("score", F.lit("extra"))
    odd = spark.createDataFrame([(-1, None, None, None, 0), (-2, "", "en", None, 0), (-3, "12 34", "en", "src0", 5)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.unionByName(odd.withColumn("score", F.lit("extra")))
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], SF_SMALL), f"test-{name}"))
    raw, named, unlike, cut, mixed, encoded = [s.collect() for s in steps]
    assert all(s.columns == docs.columns for s in steps[:5])
    assert {r.doc_id for r in raw} - {r.doc_id for r in named} == {-1, -2, -3}
    classes = brute.near_classes([(r.doc_id, r.text) for r in named])
    assert {r.doc_id for r in unlike} == set(classes.values())
    left = {i: kept.decode(errors="ignore") for i, *_, kept in brute.repeats([(r.doc_id, r.text) for r in unlike], corpus_pipeline.PASSAGE_BYTES)}
    assert {r.doc_id: r.text for r in cut} == left
    assert all(r.n_chars == len(r.text) for r in cut)
    times = collections.Counter(r.doc_id for r in mixed)
    assert max(times.values()) <= 3 and {r.doc_id for r in mixed} <= set(left)
    assert all(left[r.doc_id] == r.text for r in mixed)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert collections.Counter(r.doc_id for r in encoded) == times
    for r in encoded:
        assert r.token_ids == library.encode_ordinary(left[r.doc_id]) and r.round_trip and r.n_tokens == len(r.token_ids)


def test_training_order_survives_the_files(spark):
    """Sorted by place, the last stage's rows are in the order of the mix."""
    import corpus_pipeline

    from stratum.llm import mixing
    from stratum.llm.common import stored

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = stored(corpus_pipeline.mix(spark, docs, SF_SMALL), "test-order")
        assert mixed.columns == docs.columns and len(mixed.inputFiles()) > 3
        rows = corpus_pipeline.encode(spark, mixed.withColumn("train_row", F.lit("clash")), SF_SMALL).select("doc_id", "train_part", "train_row").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    got = [r.doc_id for r in sorted(rows, key=lambda r: (r.train_part, r.train_row))]
    plan = mixing.allot(docs, mixing.curriculum).collect()
    want = sorted((p["position"], r.doc_id) for r in plan for p in r.passes if 2 * p["taken"] >= r["size"])
    assert got == [i for _, i in want] and len(set(got)) < len(got)
    apart = corpus_pipeline.encode(spark, docs.limit(5).cache(), SF_SMALL)  # not read from files
    assert apart.count() == 5 and len({(r.train_part, r.train_row) for r in apart.collect()}) == 5


def test_null_ids_take_part(spark):
    rng = random.Random(5)

    def text(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))

    p1, p2, p3 = text(450), text(430), text(600)
    rows = [(1, text(80) + p1 + text(50)), (None, text(300) + p1), (None, p2 + text(20)), (None, text(20) + p2), (None, p3), (None, p3), (None, p3), (2, text(9) + p3[50:560])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    key = lambda r: (r[0] or 0, *r[1:])
    want = [(i, n, removed, spans, brute.sha(kept)) for i, n, removed, spans, kept in brute.repeats(rows)]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    words = [f"w{i}" for i in range(100)]
    other = [f"v{i}" for i in range(100)]
    rows = [(7, " ".join(words)), (None, " ".join(words[:-1])), (None, " ".join(words[:-1])), (None, " ".join(other)), (None, " ".join(other)), (None, " ".join(other[1:])), (None, None), (8, None)]
    near = near_texts.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = collections.Counter((r.doc_id, r.class_id, r.kept) for r in near.collect())
    assert got == {(7, 7, True): 1, (None, 7, False): 2, (None, None, True): 2, (None, None, False): 2, (8, 8, True): 1}


def test_block_memory_is_bounded_by_bytes():
    """2,000 texts that share many shingles, and a group of long texts: what
    the comparison of a block allocates follows neither."""
    import tracemalloc

    import pyarrow as pa

    n, each = 1000, 300
    shingle = (np.arange(n)[:, None] * 100 + np.arange(each)[None, :]).ravel().astype(np.uint64)  # 100,200 different
    owner = np.repeat(np.arange(n), each)
    weight = np.ones(n * each)
    weight[::each] = 2
    tracemalloc.start()
    links = list(near_texts._family_links(owner, shingle, weight, slice(0, n), np.full(n, 2), np.arange(n), 0.45))
    peak = tracemalloc.get_traced_memory()[1]
    assert sorted(tuple(sorted(x)) for x in links) == [(i, i + 1) for i in range(n - 1)]
    assert peak < 200e6
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30000))
    table = pa.table({"family": [1] * 40, "i": [0] * 40, "j": [0] * 40, "side": [2] * 40, "key": list(range(40)), "text": [f"{long} {k}" for k in range(40)]})
    tracemalloc.reset_peak()
    found = [r for b in near_texts._family_batches(table.to_batches(), words=5, threshold=0.8) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 39
    assert peak < 30 * table.nbytes


def test_families_of_long_texts(spark):
    """Parts by bytes: long texts alone, the others dealt, classes as ever."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(24):
        words = list(base) if i % 4 else base * 3
        for j in rng.sample(range(80), rng.choice([1, 2, 3])):
            words[j] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_texts.near_classes(docs, block_bytes=1200).collect()
    assert {r.doc_id: r.class_id for r in got} == brute.near_classes(rows)


def test_one_row_of_each_class_stays(spark):
    """Repeated rows, equal ids and null ids: one row of each class goes on,
    and the next stage has nothing to empty."""
    import corpus_pipeline

    rng = random.Random(8)

    def text(n=120):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    twice, copied, edited, unlike, nameless, lost, third = (text() for _ in range(7))
    rows = [(1, twice), (1, twice), (2, copied), (None, copied), (3, edited), (3, edited + " more"), (4, unlike), (4, third), (None, nameless),
            (None, nameless), (None, nameless + " more"), (5, lost + " more"), (None, lost), (6, None), (6, None), (None, None), (1, None), (9, third)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, n_chars int")
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert left.columns == docs.columns
    got = left.collect()
    texts = collections.Counter((r.doc_id, r.text) for r in got)
    for i, t in [(1, twice), (2, copied), (4, unlike), (4, third), (5, lost + " more")]:
        assert texts[i, t] == 1
    assert texts[3, edited] + texts[3, edited + " more"] == 1 and texts[None, nameless] + texts[None, nameless + " more"] == 1
    assert sum(1 for r in got if r.text is None) == 4 and len(got) == 7 + 4
    assert all((r.doc_id, r.text) == rows[r.n_chars] for r in got)  # a row's columns stay together
    assert sorted(r.text for r in corpus_pipeline.repeated_strings(spark, left, "").collect() if r.text is not None) == sorted(
        r.text for r in got if r.text is not None
    )


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
