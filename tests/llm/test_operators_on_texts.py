"""Decontamination, line dedup, near-dedup, substring dedup and quality rules against plain Python."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from fieldnorm.llm import near_dedup as near  # noqa: E402
from fieldnorm.llm.components import components  # noqa: E402
from fieldnorm.llm.decontaminate import contamination, decontaminate  # noqa: E402
from fieldnorm.llm.lines import dedup_lines, line_report  # noqa: E402
from fieldnorm.llm.quality import apply_quality_rules, quality_rules, with_measures  # noqa: E402
from fieldnorm.llm.substrings import without_repeats  # noqa: E402

SCHEMA = "doc_id long, text string"


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def made_up(seed, n=120):
    """Short texts of few words, so that windows, lines and whole texts repeat; nulls and odd white space."""
    r = random.Random(seed)
    bases = [" ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(30, 90))) for _ in range(8)]
    out = []
    for k in range(n):
        words = r.choice(bases).split(" ")
        for _ in range(r.randint(0, 6)):
            words[r.randrange(len(words))] = r.choice(["zz", "É", "a\tb", "x-1", "Ab"])
        seps = [r.choice([" "] * 9 + ["\n", "  ", "\x0b", "\r\n"]) for _ in words]
        out.append((k, "".join(w + s for w, s in zip(words, seps))))
    return [*out, (n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "one"), (n + 4, bases[0]), (n + 5, bases[0])]


@pytest.fixture(scope="module")
def rows():
    return made_up(1)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.fixture(scope="module")
def clashing(spark):
    """Column names that the operators use themselves, and rows that repeat."""
    names = "doc_id long, text string, source string, row int, dropped int, holder int, text_hash int, hit_runs int, removed int, n_words int, kept_id int, host int"
    line = "this very line stands in many of the documents"
    texts = [f"{line}\n{' '.join(f'w{k}x{j}' for j in range(60))}" for k in range(4)]
    rows = [(k, texts[k], "s", *range(9)) for k in range(4)]
    return spark.createDataFrame([*rows, rows[0], (None, None, None, *[None] * 9), (None, texts[1], None, *[None] * 9)], names)


def test_contamination(spark, docs, rows):
    r = random.Random(3)
    items = [(k, " ".join((rows[k][1] or "").split()[5:30])) for k in range(0, 40, 3)]
    items += [(50, "zz"), (51, None), (52, ""), (None, rows[4][1]), (50, "É ab"), (53, "no such words here")]
    r.shuffle(items)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = ordered(brute.contamination(rows, items))
    for block in (4 << 20, 200):  # the second takes several scans
        found = contamination(docs, benchmark, block_bytes=block).select("doc_id", "n_words", "n_hit", "item_ids")
        assert ordered(found.collect()) == expected
    assert any(row[2] for row in expected)


def test_decontaminate_cuts_and_drops(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    texts = [(1, f"Before, {passage}! after"), (2, passage), (3, "clean text"), (4, None), (5, f"{passage} {' '.join('w%d' % k for k in range(30))}")]
    df = spark.createDataFrame([(*row, k) for k, row in enumerate(texts)], f"{SCHEMA}, hit_runs int")
    items = spark.createDataFrame([(1, passage)], "item_id int, text string")
    out = {row.doc_id: row.text for row in decontaminate(df, items, drop_share=0.9).collect()}
    assert out == {1: "Before, ! after", 3: "clean text", 4: None, 5: " " + " ".join("w%d" % k for k in range(30))}
    assert decontaminate(df, items).where("doc_id = 1").isEmpty()  # 12 of 14 words
    assert decontaminate(df, items.limit(0)).count() == 5
    assert decontaminate(df, items).columns == df.columns


def test_line_report(docs, rows):
    assert ordered(line_report(docs).collect()) == ordered(brute.line_report(rows))


def test_hot_lines_and_ties(spark, monkeypatch):
    line = "A line that is long enough to count"
    rows = [(k % 40, f"own {k}\n{line}\n\n{line.upper()} ") for k in range(90)] + [(None, line), (None, None), (39, line)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    expected = ordered(brute.line_report(rows))
    assert ordered(line_report(df).collect()) == expected
    import fieldnorm.llm.lines as lines

    monkeypatch.setattr(lines, "PIECE", 5)  # the frequent line's probes are dealt over pieces
    monkeypatch.setattr(lines, "SHARD", 7)
    assert ordered(line_report(df).collect()) == expected


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, rows, size):
    found = near.near_duplicates(docs, size=size).select("doc_id", "n_shingles", "component_id", "kept")
    expected = brute.near_duplicates(rows, size)
    assert ordered(found.collect()) == ordered(expected)
    assert 3 < len({row[2] for row in expected}) < len(rows)


def family(seed, n):
    """Copies of one text, each with a few words changed, some with many; truncated ones; two variants."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    other = base[:110] + [f"v{k}" for k in range(40)]
    out = []
    for k in range(n):
        words = list(base if k % 3 else other)
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 12, 20])):
            words[r.randrange(len(words))] = r.choice([f"x{k}{r.random()}", "of", "the"])
        out.append((k, " ".join(words[: len(words) - r.choice([0, 0, 0, 10, 25, 40])])))
    return out


@pytest.mark.parametrize("small", [8, 1])
def test_large_families_lose_no_link(spark, monkeypatch, small):
    monkeypatch.setattr(near, "SMALL", small)
    rows = family(7, 160)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = near.near_duplicates(df, size=2).select("doc_id", "n_shingles", "component_id", "kept")
    assert ordered(found.collect()) == ordered(brute.near_duplicates(rows))


def test_components_of_long_chains(spark):
    r = random.Random(5)
    chain = [(k, k + 1) for k in range(200)] + [(500 + k, 500) for k in range(50)]
    r.shuffle(chain)
    links = spark.createDataFrame([(a, b) if r.random() < 0.5 else (b, a) for a, b in chain], "a long, b long")
    found = {row.node: row.least for row in components(links).collect()}
    assert found == {k: 0 for k in range(1, 201)} | {500 + k: 500 for k in range(1, 50)}
    assert components(links.limit(0)).isEmpty()


@pytest.mark.parametrize("size", [35, 12, 3])
def test_without_repeats(docs, rows, size):
    assert ordered(without_repeats(docs, size=size).collect()) == ordered(brute.without_repeats(rows, size))


def test_periodic_texts(spark):
    rows = [(k, " ".join("ab" * k)) for k in range(60)] + [(None, "a b " * 100), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert ordered(without_repeats(df).collect()) == ordered(brute.without_repeats(rows))


def test_measures(docs, rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert ordered(with_measures(docs).select("doc_id", *names).collect()) == ordered((k, *brute.measures(text)) for k, text in rows)


def hosts(spark):
    """A host with a notice on every page, pages that are little but the notice, and a family of near copies."""
    r = random.Random(9)

    def words(n):
        return " ".join(f"w{r.randrange(10**9)}" for _ in range(n))

    notice = "\n".join(f"notice {k} {words(12)}" for k in range(6))
    rows = [(k, f"{words(20)}\n{words(60)}\n{notice}", "h") for k in range(40)]
    rows += [(100 + k, f"{words(5)}\n{notice}\n{words(4)}", "h") for k in range(20)]
    shared = [words(12) for _ in range(12)]
    for k in range(30):
        lines = list(shared)
        lines[r.randrange(12)] = words(12)
        rows.append((200 + k, "\n".join(lines), "h"))
    return rows, notice, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_quality_rules(spark):
    rows, notice, df = hosts(spark)
    verdict = {row.doc_id: row for row in quality_rules(df).collect()}
    assert {k for k, row in verdict.items() if not row.kept} == {k for k, _, _ in rows if 100 <= k < 200}
    assert not any(row.base_failed for row in verdict.values())
    kept = {row.doc_id: row.text for row in apply_quality_rules(df).collect()}
    assert kept == {k: text.replace("\n" + notice, "") for k, text, _ in rows if not 100 <= k < 200}


def test_empty_tables(empty, spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    for out in (
        contamination(empty, items), decontaminate(empty, items), line_report(empty), dedup_lines(empty), near.near_duplicates(empty),
        near.near_dedup(empty), without_repeats(empty), quality_rules(empty), apply_quality_rules(empty),
    ):
        assert out.isEmpty()


def test_clashing_names_nulls_and_repeated_rows(clashing, spark):
    items = spark.createDataFrame([(1, "many of the documents w0x0")], "item_id int, text string")
    before = clashing.count()
    for out in (decontaminate(clashing, items), dedup_lines(clashing), apply_quality_rules(clashing), near.near_dedup(clashing)):
        assert out.columns == clashing.columns
        assert dict(out.dtypes) == dict(clashing.dtypes)
    assert decontaminate(clashing, items).count() == dedup_lines(clashing).count() == before
    assert quality_rules(clashing).count() == near.near_duplicates(clashing).count() == without_repeats(clashing).count() == before
    lost = dedup_lines(clashing).where(F.col("text").startswith("this very line"))
    assert [row.doc_id for row in lost.collect()] == [3]
    kept = near.near_dedup(clashing).collect()
    assert sorted((row.doc_id is None, row.doc_id or 0, row.text is None) for row in kept) == [
        (False, 0, False), (False, 0, False), (False, 1, False), (False, 2, False), (False, 3, False), (True, 0, False), (True, 0, True),
    ]


def test_very_long_text(spark):
    long = " ".join(f"w{k}" for k in range(400_000))
    rows = [(1, long), (2, long + " end"), (3, "short")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {row.doc_id: (row.n_words, row.n_removed) for row in without_repeats(df).select("doc_id", "n_words", "n_removed").collect()}
    assert found == {1: (400_000, 400_000), 2: (400_001, 400_000), 3: (1, 0)}
    assert {row.doc_id: row.component_id for row in near.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}
