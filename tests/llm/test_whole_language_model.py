"""With ``least`` the language model keeps all pairs and triples, however few of them are broadcast."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from test_models import brute_model  # noqa: E402

from fieldnorm.llm import language_model as lm  # noqa: E402
from fieldnorm.llm import queries  # noqa: E402
from fieldnorm.llm.language import fold  # noqa: E402

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("words, arcs, gains", [(1 << 20, 1 << 18, 1 << 21), (3000, 2000, 9000), (50, 1, 1)])
def test_no_pair_is_lost_to_the_size_of_the_input(spark, monkeypatch, words, arcs, gains):
    """A small ARCS is to the given texts what the real one is to a large input."""
    monkeypatch.setattr(lm, "WORDS", words)
    monkeypatch.setattr(lm, "ARCS", arcs)
    monkeypatch.setattr(lm, "GAINS", gains)
    monkeypatch.setattr(lm, "COMBINED", 5000)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [tuple(row) for row in docs.select("doc_id", "text", fold(F.col("doc_id"), 5) == 1).collect()]
    found = {row.doc_id: row for row in queries.op4_lm_scoring(spark, DATA).collect()}
    assert len(found) == len(rows)
    for doc_id, *counts, base_score, score in brute_model(rows, 1 << 60):
        row = found[doc_id]
        assert [row.n_tokens, row.n_known, row.train_tokens] == counts
        assert row.base_score == pytest.approx(base_score, rel=1e-9)
        assert row.score == pytest.approx(score, rel=1e-9)


def test_odd_rows(spark):
    rows = [(1, None), (None, ""), (2, " \n"), (3, "12 %"), (3, "12 %"), (4, "a a a a a"), (None, "a")]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm.score_texts(odd, F.lit(False), least=2).collect()
    expected = sorted(row[-1] for row in brute_model([(*row, False) for row in rows], 1 << 60))
    assert sorted(row.score for row in found) == pytest.approx(expected)
    nothing = lm.score_texts(odd, F.lit(True), least=2).collect()
    assert len(nothing) == 7 and all(row.n_known == row.train_tokens == 0 for row in nothing)
    assert lm.score_texts(odd.limit(0), F.lit(False), least=2).isEmpty()


def test_grams_move_in_blocks_dealt_to_many_shards(spark, monkeypatch):
    """No row is shuffled for each pair or triple, however many shards and buffers there are."""
    monkeypatch.setattr(lm, "SHARE", 40)
    monkeypatch.setattr(lm, "COMBINED", 100)
    monkeypatch.setattr(lm, "WORDS", 8)
    monkeypatch.setattr(lm, "ARCS", 4)
    monkeypatch.setattr(lm, "GAINS", 4)
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(4000)]
    rows = [(k, " ".join(words[9 * k : 9 * k + rng.randrange(30)]), k % 5 == 1) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    found = {row.doc_id: row for row in lm.score_texts(docs, F.col("held_out"), least=2).collect()}
    for doc_id, *counts, base_score, score in brute_model(rows, 1 << 60):
        row = found[doc_id]
        assert [row.n_tokens, row.n_known, row.train_tokens] == counts
        assert [row.base_score, row.score] == pytest.approx([base_score, score], rel=1e-9)
    every = np.full(2, -1, np.int64).view(np.uint64)
    plan = lm._counted_grams(docs, 2, 2, every, 7)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "shard" in plan


def test_index_finds_all_places():
    keys = np.sort(lm.mixed(np.arange(1, 5000, dtype=np.uint64)).view(np.int64))
    asked = lm.mixed(np.arange(0, 9000, dtype=np.uint64)).view(np.int64)
    for own in (keys, keys[:1], keys[:0]):
        assert (lm.Index(own).place(asked) == lm._place(own, asked)).all()
