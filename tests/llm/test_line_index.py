"""The index holds every distinct line once, with its documents and last holder, in shards of any width."""

import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

import fieldnorm.llm.lines as lines  # noqa: E402
from fieldnorm.llm.perfect_hash import PerfectHash  # noqa: E402

ROWS = [(k % 70, f"line number {k % 211} of the table\nline number {k % 13} of the table\n common to every text here ") for k in range(400)]


def test_index_holds_all_distinct_lines(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD", 150)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    scanned = docs.selectExpr("doc_id", "xxhash64(text) AS text_hash", "text").mapInArrow(lines._line_rows(20), lines._LINES)
    rows, index = scanned.collect(), lines.line_index(scanned).collect()
    holders = {}
    for row in rows:
        holders.setdefault((row.key, row.check), set()).add(row.doc_id)
    assert len(index) > 3 and len(holders) == 212
    assert sum(row.n_lines for row in index) == len(rows)
    assert sum(len(row.checks) // 8 for row in index) == len(holders)
    found = {}
    for row in index:
        checks, lasts, counts = np.frombuffer(row.checks, np.int64), np.frombuffer(row.lasts, np.int64), np.frombuffer(row.counts, np.uint32)
        for key, check in holders:
            whole = lines._whole(np.array([key]), np.array([check]), row.turned)
            at = PerfectHash.load(row.levels).find(whole)[0]
            if at >= 0 and checks[at] == check:
                found[key, check] = (int(counts[at]), int(lasts[at]))
    assert found == {pair: (len(ids), max(ids)) for pair, ids in holders.items()}


def test_keys_alike_in_64_bits_are_told_apart():
    check = np.array([5, 9, 77], np.int64)
    key = lines._whole(np.zeros(3, np.int64), check, 1).view(np.int64)  # all look like zero when turned by 1
    assert len(np.unique(lines._whole(key, check, 1))) == 1
    table = pa.table({"shard": pa.array([4] * 3, pa.int32()), "key": key, "check": check, "n_docs": [3, 2, 1 << 40], "last": [7, 7, 7], "n_lines": [3, 2, 9]})
    row = lines._build(table).to_pylist()[0]
    assert row["turned"] > 1 and row["n_lines"] == 14
    assert lines._probe(row, key, check, np.array([6, 6, 6]), 3).tolist() == [True, False, True]
    assert lines._probe(row, key, check, np.array([7, 6, 7]), 3).tolist() == [False, False, False]


@pytest.mark.parametrize("piece", [3, 50, 10**6])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_wide_shards_in_pieces(spark, monkeypatch, piece, threshold):
    """Also where the table of wide shards is not broadcast; repeated rows and null ids among them."""
    rows = ROWS + [(None, ROWS[0][1])] * 60 + [ROWS[5]] * 60
    monkeypatch.setattr(lines, "SHARD", 100)
    monkeypatch.setattr(lines, "PIECE", piece)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        report = lines.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
        assert sorted(map(tuple, report.collect()), key=repr) == sorted(brute.line_report(rows), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_and_lineless_tables(spark):
    schema = "doc_id long, text string, shard int, piece string, key long"
    for rows in ([], [(1, None, 0, "x", 1), (2, "", 0, "x", 1), (None, "short\n\n", 0, "x", 1)]):
        docs = spark.createDataFrame(rows, schema)
        assert sorted(map(tuple, lines.dedup_lines(docs).collect()), key=repr) == sorted(rows, key=repr)
