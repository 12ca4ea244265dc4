"""Decontamination, filter audit, fill-in-the-middle."""

import collections
import hashlib
import itertools
import random
import re

import brute
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from stratum.llm import decontaminate, filter_audit, fim, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_contamination(docs, items, window=10):
    """[(id, n_words, n_hit, items, spans)] of [(id, text)]."""
    wanted = collections.defaultdict(set)
    for name, text in items:
        w = tuple(WORD.findall((text or "").translate(LOWER)))
        size = min(window, len(w))
        for i in range(len(w) - size + 1):
            if size:
                wanted[w[i : i + size]].add("" if name is None else str(name))
    out = []
    for i, text in docs:
        found = list(WORD.finditer((text or "").translate(LOWER)))
        w = [m.group() for m in found]
        hit, names = set(), set()
        for size in {len(k) for k in wanted}:
            for at in range(len(w) - size + 1):
                if tuple(w[at : at + size]) in wanted:
                    hit |= set(range(at, at + size))
                    names |= wanted[tuple(w[at : at + size])]
        runs = [k for k in sorted(hit) if k - 1 not in hit], [k for k in sorted(hit) if k + 1 not in hit]
        out.append((i, len(w), len(hit), sorted(names), [(found[a].start(), found[b].end()) for a, b in zip(*runs)]))
    return out


@pytest.mark.parametrize("part_words", [200_000, 40])
def test_contamination_equals_brute_force(spark, part_words):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünder", "STRASSE", "3", "x-y", "naïve", "日本"]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.randrange(1, 40))) for i in range(25)] + [(100, None), (101, ""), (102, "..."), (None, "one two three four"), (3, "another text of equal id"), (103, "alpha"), (104, "Alpha ALPHA"), (105, text(130))]
    docs = [(1000 + i, text(rng.randrange(60))) for i in range(60)] + [(-1, None), (-2, ""), (-3, "!?"), (-4, "ONE: two\0three-FOUR five"), (-5, "alpha alpha alpha"), (-6, "alphabet"), (-6, "alphabet")]
    docs += [(2000 + i, f"é{text(3)} é, {t} " + text(20)) for i, (_, t) in enumerate(items)] + [(-7, text(30000) + " " + items[4][1])]
    given = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("items", F.lit("clash")).withColumn("words", F.lit(1)).repartition(5)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("n_hit", F.lit(0))
    got = decontaminate.contamination(given, benchmark, part_words=part_words)
    assert got.columns == ["doc_id", "text", "words", "n_words", "n_hit", "items", "spans"]
    rows = got.collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in rows) == sorted(brute_contamination(docs, items))
    clean = decontaminate.without_contaminated(given, benchmark, part_words=part_words)
    assert clean.columns == given.columns and sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in rows if not r.n_hit)


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [(r.n_words, r.n_hit, r["items"], r.spans) for r in decontaminate.contamination(docs, none).orderBy("doc_id").collect()] == [(2, 0, [], []), (0, 0, [], [])]
    some = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert decontaminate.contamination(docs.limit(0), some).count() == 0


def brute_audit(rows, filters="ABCDE"):
    """{(part, order, step): measures} of [(part, failing letters, good, toxic)]."""
    out, removed_by = {}, collections.Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations(filters):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in own if f in r[1]]
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone), sum(set(r[1]) == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                removed_by[part, f] += len(gone)
    return {k: tuple(v) + (removed_by[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def audited(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


@pytest.mark.parametrize("filters", ["A", "XY", "ABCD", "ABCDE"])
def test_audit_equals_brute_force(spark, filters):
    rng = random.Random(8)
    k = len(filters)
    rows = [(rng.choice(["", "en", "fr"]), rng.randrange(1 << k), rng.randrange(2), rng.randrange(2)) for _ in range(300)]
    rows += [("de", 0, 1, 0), ("it", (1 << k) - 1, 1, 1)]  # nothing fails, everything fails
    masks = spark.createDataFrame([(p, m, 1, g, t) for p, m, g, t in rows], "part string, mask int, n bigint, good bigint, toxic bigint")
    want = brute_audit([(p, "".join(f for i, f in enumerate(filters) if m >> i & 1), g, t) for p, m, g, t in rows], filters)
    assert audited(filter_audit.audit(masks, filters)) == want
    assert filter_audit.audit(masks.limit(0), filters).count() == 0


def test_audit_of_odd_rows(spark):
    plain = " ".join(f"word{i}" for i in range(120))
    few = " ".join(f"word{i % 50}" for i in range(120))
    rows = [(1, plain, "en"), (2, plain, "en"), (2, plain, "en"), (3, plain, "fr"), (None, plain, None), (4, None, "en"), (5, "", "en"), (6, " \n\t", ""), (7, few, "en"), (8, few + " $", None),
            (9, "LOUD " * 200, "en"), (10, plain + " AB", "en"), (11, "é" * 50 + "ABCDEF " + plain.replace(" ", "  "), "en"), (12, plain * 300, "de"), (13, "a|b", "en"), (13, "other", "en")]
    labels = [(1, 1, 0), (2, 1, 0), (2, 0, 1), (7, 0, 1), (8, None, 1), (99, 1, 1), (None, 1, 1), (13, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("mask", F.lit("clash")).withColumn("n", F.lit("clash"))
    said = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = []
    for i, text, lang in rows:
        t = text or ""
        w = brute.WORD.findall(t)
        fails = "".join(c for c, x in (("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)), ("C", 100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in t) > 10 * len(t)), ("D", bool(set("#$%&*|") & set(t)))) if x)
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            fails += "E"
        want.append((lang or "", fails, any(j == i and q == 1 for j, q, _ in labels if j is not None), any(j == i and x == 1 for j, _, x in labels if j is not None)))
    assert audited(filter_audit.audit(filter_audit.text_masks(docs, said))) == brute_audit(want)
    assert filter_audit.audit(filter_audit.text_masks(docs.limit(0), said.limit(0))).count() == 0


def brute_fim(i, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text or ""
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("frame_chars", [fim.FRAME_CHARS, 7])
def test_fim_equals_brute_force(spark, frame_chars):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice(["a", "Bc", "<", ">", "P", "é", "日", " ", "\n", "1", "😀", "zzzzzzzzzz"]) for _ in range(rng.randrange(40)))) for i in range(300)]
    rows += [(-1, None), (-2, ""), (-3, "x<P>y"), (-4, "<M>"), (-5, "<" * 30), (-6, "a" * 50), (-6, "a" * 50), (None, "no id at all"), (None, "other"), (-7, "word " * 20000), (-8, "x" * 30000 + "é" * 30000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit("clash")).withColumn("own", F.lit(1)).withColumn("form", F.lit(0))
    done = fim.transform(fim.frames(docs, frame_chars=frame_chars), frame_chars=frame_chars)
    want = collections.Counter((i, *brute_fim(i, t)) for i, t in rows)
    out = fim.texts(done)
    assert out.columns == ["doc_id", "own", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()) == want
    got = collections.Counter((r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.digests(done).collect())
    assert got == collections.Counter((i, brute.sha(brute_fim(i, t)[-1].encode()), brute.sha((t or "").encode())) for i, t in rows)
    assert fim.digests(fim.transform(fim.frames(docs.limit(0)))).count() == 0


def test_a_unit_is_found_in_one_frame():
    import zstandard

    writer = fim.FrameWriter(zstandard.ZstdCompressor(), 100)
    text = "ab, " * 1000 + "q" * 950 + " end"
    writer.add(text)
    frames = writer.finish()
    read = []

    class Spy:
        def decompress(self, data):
            read.append(data)
            return zstandard.ZstdDecompressor().decompress(data)

    reader = fim.FrameReader(Spy(), frames, writer.chars, writer.units)
    assert writer.units == 3003 and len(frames) == 50
    assert reader.place(1501) == 2002 and len(read) == 1
    assert reader.place(3001) == 4950 and len(read) == 2  # behind a run that fills nine frames
    assert "".join(reader.pieces(1234, 2345)) == text[1234:2345] and len(read) == 14


def test_queries_on_given_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = {i: (n, hit, len(names), brute.sha(",".join(names).encode()), hit > 0) for i, n, hit, names, _ in brute_contamination([(r.doc_id, r.text) for r in docs], items)}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.op11_decontaminate(spark, SF_SMALL).collect()}
    assert got == want and any(x[4] for x in got.values())
    assert queries.op12_filter_audit(spark, SF_SMALL).count() == 600 * len({r.lang for r in docs})
    fims = {r.doc_id: r for r in queries.op13_fill_in_middle(spark, SF_SMALL).collect()}
    assert all(fims[r.doc_id].output_sha256 == brute.sha(brute_fim(r.doc_id, r.text)[-1].encode()) for r in docs)
