"""Sharding, vector codes and fill-in-the-middle against plain Python versions."""

import hashlib
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldnorm.llm import shards, vector_codes
from fieldnorm.llm.middle import count_units, fill_in_middle, restored
from fieldnorm.llm.shards import shard_documents, shard_places, write_shards

DOCS = "doc_id long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Sharding


def placed(rows, n):
    """doc_id, size, crc, shard, slot of rows (doc_id, text), by running sums over one list."""
    keyed = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        keyed.append((doc_id is not None, doc_id or 0, zlib.crc32(raw), len(raw) + 1))
    keyed.sort()
    total, start, out, slots = sum(x[3] for x in keyed), 0, [], Counter()
    for known, doc_id, crc, size in keyed:
        shard = n * (2 * start + size) // (2 * total)
        out.append((doc_id if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        start += size
    return out


def mixed_rows():
    r = random.Random(3)
    rows = [(k, "é" * r.randint(0, 300)) for k in range(400)]
    rows += [(7, "same"), (7, "same"), (7, "other"), (None, None), (None, ""), (None, "x"), (900, None), (901, "y" * 9000)]
    rows += [(None, "hot")] * 200 + [(5, "hot")] * 150
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "bits"), [(8, 16), (8, 3), (1, 2), (700, 4), (5, 0)])
def test_shards_match_running_sums(spark, monkeypatch, n, bits):
    monkeypatch.setattr(shards, "BLOCK_BITS", bits)
    rows = mixed_rows()
    found = shard_places(spark.createDataFrame(rows, DOCS).repartition(7), n).collect()
    assert Counter(map(tuple, found)) == Counter(placed(rows, n))


def test_shards_are_contiguous_and_near_equal(spark):
    rows = [(k, "w" * (k * 37 % 211)) for k in range(3000)]
    found = shard_places(spark.createDataFrame(rows, DOCS).repartition(5), 8)
    by = found.groupBy("shard").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"), F.max("slot").alias("last"))
    by = by.orderBy("shard").collect()
    assert [x.shard for x in by] == list(range(8)) and all(x.last == x.n - 1 for x in by)
    assert all(a.hi < b.lo for a, b in zip(by, by[1:]))
    target = sum(x.bytes for x in by) / 8
    assert max(abs(x.bytes - target) for x in by) <= 212


def test_whole_documents_are_sharded(spark, tmp_path):
    schema = "doc_id long, text string, shard string, size int, at int, crc int, row int, id int, nr int, block int, part int"
    rows = [(k % 40, f"text {k % 40} " * (k % 5), "old", 1, 2, 3, 4, 5, 6, 7, 8) for k in range(60)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    out = shard_documents(docs, 4)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    kept = Counter((x.doc_id, x.text, x.at, x.part) for x in out.collect())
    assert kept == Counter((x[0], x[1], x[4], x[10]) for x in rows)
    expected = {(x[0], x[3], x[4]) for x in placed([r[:2] for r in rows], 4)}
    assert {(x.doc_id, x.shard, x.slot) for x in out.collect()} == expected
    write_shards(docs, str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 4


def test_no_documents_no_shards(spark):
    empty = spark.createDataFrame([], DOCS)
    assert shard_places(empty, 8).collect() == [] and shard_documents(empty, 8).collect() == []
    with pytest.raises(ValueError, match="0 shards"):
        shard_places(empty, 0)


def test_sharding_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], DOCS)
    plan = shard_places(docs, 8)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# Vector codes


def codes_of(rows, parts=8, entries=16, rounds=6):
    """id, code, error, label_error of rows (id, vector, label) in exact integers, and the codebooks' digest."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = max((len(v) for _, v, _ in kept), default=0)
    across = -(-length // parts)

    def ints(v):
        own = [math.floor(Fraction(x) * 4096) for x in v]
        own += [0] * (parts * across - len(own))
        return [own[p * across : (p + 1) * across] for p in range(parts)]

    vectors = [(i, ints(v), lab) for i, v, lab in kept]
    first = sorted((x for x in vectors), key=lambda x: (x[0] is None, x[0] or 0))[:entries]
    books = [[x[1][p] for x in first] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            groups = [[] for _ in books[p]]
            for _, v, _ in vectors:
                groups[near(v[p], books[p])[0]].append(v[p])
            books[p] = [[sum(xs) // len(own) for xs in zip(*own)] if own else c for own, c in zip(groups, books[p])]
    found = []
    for i, v, lab in vectors:
        near_parts = [near(v[p], books[p]) for p in range(parts)]
        found.append((i, lab, "".join(f"{k:02x}" for k, _ in near_parts), sum(d for _, d in near_parts)))
    of_label = Counter()
    for _, lab, _, error in found:
        of_label[lab] += error

    def long(x):
        return x if x < 1 << 63 else None

    digest = sha(",".join(str(x) for book in books for entry in book for x in entry))
    over = {lab for _, lab, _, error in found if long(error) is None}
    return [(i, lab, code, long(e), None if lab in over else long(of_label[lab]), digest) for i, lab, code, e in found]


VECTORS = "vec_id long, embedding array<double>, label int"


def vectors(seed, n=300, length=24, scale=1.0):
    r = random.Random(seed)
    centers = [[r.gauss(0, scale) for _ in range(length)] for _ in range(9)]
    return [(k, [x + r.gauss(0, scale / 5) for x in r.choice(centers)], r.choice([None, 1, 2, 3])) for k in r.sample(range(10 * n), n)]


def check_codes(spark, rows, **kw):
    found = vector_codes.vector_codes(spark.createDataFrame(rows, VECTORS).repartition(4), **kw)
    assert found.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, found.collect())) == Counter(codes_of(rows, **kw))


def test_codes_match_exact_integers(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 1), (2, [1.0, None] * 12, 1), (3, [nan] * 24, 2), (4, [inf] + [0.0] * 23, None)]
    rows = vectors(1)
    check_codes(spark, rows + bad + [rows[0], rows[0], rows[5]])
    check_codes(spark, vectors(2, n=60, length=6), parts=3, entries=5, rounds=2)


@pytest.mark.parametrize("scale", [60.0, 5e4, 1e9, 1e30])
def test_codes_of_large_components(spark, scale):
    """Two limbs, distances of 63 bits, components beyond 31 and beyond 64 bits."""
    check_codes(spark, vectors(4, n=40, length=16, scale=scale) + vectors(5, n=30, length=16), rounds=3)


def test_one_outlier_is_compared_exactly(spark):
    rows = vectors(6, n=80, length=16)
    check_codes(spark, rows + [(-1, [1e300] + [0.0] * 15, 1), (10**6, [-3e38] * 16, None)], rounds=2)


def test_codes_of_odd_rows(spark):
    check_codes(spark, [(None, [1.0] * 8, 1), (5, [2.0] * 8, None), (6, [0.0] * 8, None)])  # fewer rows than entries, a null id
    check_codes(spark, [(1, [1.0] * 10, 1), (2, [-0.5] * 7, 1), (3, [], 2)])  # other lengths
    check_codes(spark, [(1, [], 1)])
    check_codes(spark, [(k, [0.5] * 8, 1) for k in range(40)])  # nothing but ties
    assert vector_codes.vector_codes(spark.createDataFrame([], VECTORS)).collect() == []
    assert vector_codes.vector_codes(spark.createDataFrame([(1, None, 1)], VECTORS)).collect() == []
    named = "vec_id long, embedding array<float>, label string, id int, of int, ints int, wide int, length int, code int, error int"
    out = vector_codes.vector_codes(spark.createDataFrame([(1, [0.25] * 8, "x", *[0] * 7)], named)).first()
    assert (out.vec_id, out.label, out.code, out.error) == (1, "x", "00" * 8, 0)


def test_limb_products_are_exact():
    r = np.random.default_rng(0)
    x, c = (r.integers(-(2**30), 2**30, (50, 3)) for _ in range(2))
    exact = [[sum(int(a) * int(b) for a, b in zip(row, entry)) for entry in c] for row in x]
    assert vector_codes.limb_products(x, c).tolist() == exact
    edge = np.array([[-(2**31), 2**30 - 1, -1, 0, 65535, 65536]])
    assert vector_codes.limb_products(edge, edge).tolist() == [[sum(int(a) ** 2 for a in edge[0])]]


# Fill-in-the-middle


def middle_of(doc_id, text):
    text = text or ""
    n, h = len(text), sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted([h1 % (n + 1), h2 % (n + 1)])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_middle_matches_slices(spark):
    r = random.Random(9)
    signs = "ab <>PSM$1\\{}\n\r é一\U0001f600́^*+?."
    rows = [(k, "".join(r.choice(signs) for _ in range(r.randint(0, 700)))) for k in range(300)]
    rows = [(k, t if k % 9 == 0 else t.replace("<P>", "<").replace("<S>", "<").replace("<M>", "<")) for k, t in rows]
    rows += [(None, "no id"), (1, None), (2, ""), (3, "a"), (3, "a"), (-4, "<<S"), (5, "x" * 256), (6, "\U0001f600" * 512), (7, "y" * 513)]
    out = fill_in_middle(spark.createDataFrame(rows, DOCS).repartition(3))
    found = out.select("doc_id", "text", "n", "form", "prefix_units", "middle_units", "output", restored(F.col("output"), F.col("form")).alias("back"))
    expected = Counter((i, t, *middle_of(i, t), t or "") for i, t in rows)
    assert Counter(map(tuple, found.collect())) == expected
    assert {x[3] for x in expected} == {"plain", "psm", "spm"}


def test_middle_of_very_long_texts(spark):
    rows = [(k, ("\U0001f600a\n" * 1_000_000)[: 2_500_000 + k]) for k in range(4)] + [(9, " " * 5_000_000)]
    out = fill_in_middle(spark.createDataFrame(rows, DOCS)).select(
        "doc_id", "n", "form", F.sha2("output", 256).alias("o"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("r")
    )
    for x in out.collect():
        text = dict(rows)[x.doc_id]
        n, form, _, _, output = middle_of(x.doc_id, text)
        assert (x.n, x.form, x.o, x.r) == (n, form, sha(output), sha(text))


def test_middle_keeps_columns_and_rates(spark):
    rows = [(k, f"text number {k}", 1, 2, 3, "old") for k in range(2000)]
    docs = spark.createDataFrame(rows, f"{DOCS}, whole int, h1 int, N int, output string")
    out = fill_in_middle(docs, percent=50, spm_percent=100)
    assert {"whole", "h1"} <= set(out.columns) and "_whole" not in out.columns
    forms = Counter(x.form for x in out.collect())
    assert set(forms) == {"plain", "spm"} and 900 < forms["plain"] < 1100
    assert {x.form for x in fill_in_middle(docs, percent=0).collect()} == {"plain"}
    assert fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []


def test_middle_by_words(spark):
    unit = r"\s*+\S++"
    rows = [(k, " ".join(f"w{j}%d" for j in range(k % 600)) + "  ") for k in range(0, 1200, 37)]
    out = fill_in_middle(spark.createDataFrame(rows, DOCS), unit=unit, percent=100)
    out = out.withColumn("back", restored(F.col("output"), F.col("form")))
    for x in out.collect():
        assert x.n == len(x.text.split()) and x.back == x.text
        if x.form == "psm":
            assert len(x.output[3 : x.output.index("<S>")].split()) == x.prefix_units
    assert spark.range(1).select(count_units(F.lit("aa b"), "a")).first()[0] == 2


def test_middle_stays_in_the_jvm(spark):
    out = fill_in_middle(spark.createDataFrame([(1, "a")], DOCS))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
