"""Line frequency by host: shared lines go by their number of documents, whatever their hashes."""

import random
from collections import Counter, defaultdict

import pytest

from fieldnorm.llm.quality import MAX_DOCS, apply_quality_rules, lines_above_limit, pages, quality_rules

SCHEMA = "doc_id long, text string, source string"
CASES = [(8, 3), (3, 8), (8, 1), (4, 1), (1, 1), (8, 0), (1, 0)]
PAGES = 40


def words(r, n):
    return " ".join(f"w{r.randrange(10**9)}" for _ in range(n))


@pytest.fixture(scope="module")
def hosts():
    """20 seeds of each case, one host each: pages of shared lines (12 words) and own ones (15 words)."""
    rows, shared_of = [], {}
    for seed in range(20):
        r = random.Random(seed)
        for shared, own in CASES:
            host = f"{seed}:{shared}+{own}"
            shared_of[host] = [words(r, 12) for _ in range(shared)]
            for _ in range(PAGES):
                lines = shared_of[host] + [words(r, 15) for _ in range(own)]
                r.shuffle(lines)
                rows.append((len(rows), "\n".join(lines if own else shared_of[host]), host))
    return rows, shared_of


def plain_verdicts(rows, limit=MAX_DOCS):
    """doc_id, removed words and whether the page is depleted."""
    texts = defaultdict(set)
    for _, text, host in rows:
        for line in set(filter(None, map(str.strip, (text or "").lower().split("\n")))):
            texts[host, " ".join(line.split())].add(text)
    out = {}
    for doc_id, text, host in rows:
        lines = [" ".join(line.split()) for line in (text or "").lower().split("\n") if line.strip()]
        gone = sum(len(line.split()) for line in lines if len(texts[host, line]) > limit)
        left = sum(len(line.split()) for line in lines) - gone
        out[doc_id, host] = (gone, left < 50 and gone >= left)
    return out


def test_all_shared_lines_go_at_every_seed(spark, hosts):
    rows, shared_of = hosts
    found = quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    expected = plain_verdicts(rows)
    host_of = {doc_id: host for doc_id, _, host in rows}
    by_case = defaultdict(set)
    for x in found:
        host = host_of[x.doc_id]
        gone, depleted = expected[x.doc_id, host]
        assert (x.n_removed_words, x.kept) == (gone, not x.base_failed and not depleted)
        shared, own = map(int, host.split(":")[1].split("+"))
        by_case[shared, own].add((x.n_removed_words, x.kept))
        # Equal texts are one document, so pages without own lines are exact copies, not boilerplate.
        assert gone == (12 * shared if own else 0)
    assert {case: len(outcomes) for case, outcomes in by_case.items()} == dict.fromkeys(CASES, 1)
    assert by_case[8, 3] == {(96, False)} and by_case[3, 8] == {(36, True)} and by_case[8, 1] == {(96, False)}


def test_pages_of_nothing_but_shared_lines_go_with_the_others(spark):
    r = random.Random(1)
    menu = [words(r, 12) for _ in range(8)]
    rows = [(k, "\n".join([*menu, words(r, 60)]), "h") for k in range(PAGES)] + [(100 + k, "\n".join(menu), "h") for k in range(50)]
    kept = {x.doc_id: x.text for x in apply_quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {k: text.rsplit("\n", 1)[1] for k, text, _ in rows[:PAGES]}


def test_hosts_are_judged_apart(spark):
    """The same id and text on another host, where no line repeats, is not charged for the first host's lines."""
    r = random.Random(2)
    menu = [words(r, 12) for _ in range(6)]
    rows = [(k, "\n".join([*menu, words(r, 60)]), "h") for k in range(PAGES)]
    rows += [(7, rows[7][1], "other"), (7, rows[7][1], "other"), (7, rows[7][1], None), (8, rows[8][1], "h")]
    df = spark.createDataFrame(rows, SCHEMA)
    removed = Counter((x.doc_id, x.n_removed_words) for x in quality_rules(df).where("doc_id in (7, 8)").collect())
    assert removed == {(7, 72): 1, (7, 0): 3, (8, 72): 2}
    texts = Counter(x.text == rows[7][1] for x in apply_quality_rules(df).where("doc_id = 7").collect())
    assert texts == {True: 3, False: 1}


def test_the_limit_is_a_number_of_texts(spark):
    r = random.Random(3)
    line, rows = words(r, 12), []
    for n, host in ((MAX_DOCS, "at"), (MAX_DOCS + 1, "over")):
        rows += [(len(rows) + k, f"{line}\n{words(r, 60)}", host) for k in range(n)]
    rows += [(1000 + k, rows[0][1], "at") for k in range(200)]  # copies do not count
    df = spark.createDataFrame(rows, SCHEMA)
    above = lines_above_limit(pages(df)).collect()
    assert [(x.host, x.n_docs) for x in above] == [("over", MAX_DOCS + 1)]
    assert quality_rules(df, max_docs=MAX_DOCS - 1).where("n_removed_words = 12").count() == len(rows)


def test_a_notice_on_eleven_pages_goes(spark):
    """Fewer texts than the limit, but each page has a context of its own; of two thousand pages it is too small a share."""
    r = random.Random(4)
    notice, rows = words(r, 60), []
    for n, more, host in ((10, 0, "ten"), (11, 0, "eleven"), (11, 1989, "large")):
        rows += [(len(rows) + k, f"{notice}\n{words(r, 20)}", host) for k in range(n)]
        rows += [(len(rows) + k, words(r, 60), host) for k in range(more)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter((x.source, x.text.startswith(notice)) for x in apply_quality_rules(df).where("text like '%\n%'").collect()) == {("ten", True): 10, ("large", True): 11}
    found = Counter((x.n_removed_words, x.kept) for x in quality_rules(df).where("n_words = 80").collect())
    assert found == {(0, True): 21, (60, False): 11}


def test_two_scans_of_the_texts_at_most(spark, tmp_path):
    spark.createDataFrame([(1, "a b", "h")], SCHEMA).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = apply_quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(str(tmp_path / "docs")) == 1 and "Python" not in plan  # the other scan is that of ``pages``
    assert str(tmp_path / "docs") not in quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
