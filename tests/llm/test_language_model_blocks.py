"""What the language model moves, and how often it reads: packed blocks, one pass over the texts to score them."""

import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from test_models import brute_model  # noqa: E402

from fieldnorm.llm import language_model as lm  # noqa: E402
from fieldnorm.llm.bitmap import may_hold_spread, spread_bitmap_of  # noqa: E402
from fieldnorm.llm.words import mixed  # noqa: E402


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rows():
    rng = random.Random(11)
    words = [f"w{int(rng.paretovariate(0.7)) % 70}" for _ in range(5000)]
    return [(k % 290, None if k % 50 == 3 else " ".join(words[11 * k : 11 * k + rng.randrange(40)]), k % 5 == 1) for k in range(300)]


@pytest.fixture
def small(monkeypatch):
    for name, value in (("SHARE", 60), ("COMBINED", 150), ("WORDS", 8), ("ARCS", 4), ("GAINS", 4)):
        monkeypatch.setattr(lm, name, value)


def test_texts_are_scored_in_one_pass_without_joins(spark, small, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(4)
    model, counts, gains = lm.learn_whole(docs.where(~F.col("held_out")), 2)
    words = counts.select("key", F.lit(0.5).alias("gain"))
    plan = _plan(lm._scored(docs, model, {lm._GAINS: gains.select("key", "gain"), lm._WORD_GAINS: words}))
    assert "Join" not in plan and "HashAggregate" not in plan
    assert len(re.findall(r"Scan ExistingRDD", plan)) == 1


def test_triples_meet_their_pairs_in_blocks(spark):
    pairs = spark.createDataFrame([(5, 0, 0, 3, 0.25, 0.0)], "key long, a long, b long, n long, p double, gain double")
    triples = spark.createDataFrame([], lm._ARCS)
    found = lm._joined_triples(pairs.select("key", "p"), pairs.drop("p"), triples, 3, 9)
    assert "Join" not in _plan(found)
    assert [tuple(row) for row in found.collect()] == [(lm._PAIR, 5, 0, 0, 3, 0.0, 0.0)]


def test_scores_of_rows_that_repeat_in_many_blocks(spark, small, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    found = lm.score_texts(docs, F.col("held_out"), least=2).collect()
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    for one, expected in zip(got, sorted(brute_model(rows, 1 << 60)), strict=True):
        assert one[:4] == tuple(expected[:4])
        assert one[4:] == pytest.approx(tuple(expected[4:]), rel=1e-9)


def test_blocks_are_told_by_their_words_in_order(spark, small, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    model, _, _ = lm.learn_whole(docs, 2)
    one = [lm._requests(df.coalesce(1), model, 3) for df in (docs, docs, docs.orderBy(F.desc("doc_id"), "text"))]
    a, again, other = ({row.block for row in df.where(f"kind = {lm._TEXTS}").collect()} for df in one)
    assert a and a == again and not a & other


def test_filter_of_hashes_loses_none(spark):
    keys = mixed(np.arange(1, 3000, dtype=np.uint64)).view(np.int64)
    bitmap = spread_bitmap_of(spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(3), 17)
    places = np.unique(keys.view(np.uint64) >> np.uint64(47))
    assert len(bitmap) == 1 << 11 and int(np.bitwise_count(bitmap).sum()) == len(places)
    assert may_hold_spread(bitmap, keys).all()
    other = mixed(np.arange(3000, 9000, dtype=np.uint64)).view(np.int64)
    assert (may_hold_spread(bitmap, other) == np.isin(other.view(np.uint64) >> np.uint64(47), places)).all()
    assert not spread_bitmap_of(spark.createDataFrame([], "key long"), 17).any()


def test_traversal_fails_from_pairs_to_words_to_the_root():
    """Words 0 to 2, arcs 0-1 and 0-1-2: each place costs its arc, or what its states fail with and its root."""
    model = lm.Model(20, 3, 2, np.arange(3), np.array([6, 5, 4]), np.arange(3))
    model.pairs, model.pair_counts = np.array([0 * 4 + 1, 1 * 4 + 2]), np.array([4, 3])
    model.triples, model.triple_counts = np.array([0 * 3 + 2]), np.array([2])
    automaton = lm.Automaton(model)
    root, back = automaton.root, automaton.back
    weight = np.log10([(4 - 0.5) / 6, (2 - 0.5) / 4, (3 - 0.5) / 5])
    of_pair = 5  # the first state of a pair
    for words, expected in (
        ([0, 1, 2], root[0] + weight[0] + weight[1]),
        ([1, 2, -1], root[1] + weight[2]),
        ([0, 1, 0], root[0] + weight[0] + back[of_pair] + back[2] + root[0]),
        ([0, 2], root[0] + back[1] + root[2]),
    ):
        assert automaton.scores(np.array(words), np.array([0, len(words)]))[0] == pytest.approx(expected)
