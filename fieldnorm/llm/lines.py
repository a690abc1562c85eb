"""Line deduplication: documents probe a sharded minimal perfect hash of all distinct lines.

A line's key is the line with white space stripped at both ends and A-Z lower-cased. Keys of
at least ``min_chars`` code points found in at least ``min_docs`` documents lose all their
lines except in the largest doc_id that holds them (there they all stay). Keys are compared
by 128 bits of hash: a perfect hash of both halves finds the place, the second half is the
fingerprint kept there. Beside it stand the number of documents and the last holder; the
probe decides by these arrays.

Defined cases: a null or empty text is one empty line and loses nothing; a null doc_id counts
as one document below all others; rows that share a doc_id are one document; an empty table
gives an empty result.

Scale: lines are written once as narrow rows (hashes and places). They are counted with
map-side sums, so the index sees each distinct line once: a shard of it holds about ``SHARD``
lines at most, whatever their frequencies, and is built in one small task. Lines are dealt to
shards and probe the arrays there. Where a frequent line makes a shard wide, its probes are
dealt over pieces of about ``PIECE`` lines by a number stored with them, and each piece gets
the arrays. Which shards are wide is a table of its own, which Spark broadcasts if it is
small (one row for every ``PIECE`` lines at most) and joins otherwise. Texts are shuffled
once, to meet the places to drop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.decontaminate import free_name
from fieldnorm.llm.perfect_hash import PerfectHash
from fieldnorm.llm.storage import stored
from fieldnorm.llm.words import LOWER, is_space, slices, span_hashes, text_bytes, tidy

SHARD = 50_000
PIECE = 100_000
NO_ID = -(1 << 63)

_LINES = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("key", "check", "doc_id", "text_hash")]
    + [T.StructField(name, T.IntegerType()) for name in ("at", "turn")]
)
_ARRAYS = ["turned", "levels", "checks", "counts", "lasts"]
_INDEX = "shard int, n_lines long, turned int, levels binary, checks binary, counts binary, lasts binary"
MOST = (1 << 32) - 1  # counts are kept in 32 bits; a larger one stays there


def _line_rows(min_chars: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, row = text_bytes(part.column("text"))
                breaks = np.flatnonzero(data == 0x0A)
                start = np.sort(np.concatenate([row[:-1], breaks + 1]), kind="stable")
                end = np.sort(np.concatenate([row[1:], breaks]), kind="stable")
                owner = np.repeat(np.arange(part.num_rows), np.diff(np.searchsorted(breaks, row)) + 1)
                at = np.arange(len(owner)) - np.searchsorted(owner, owner)
                solid = np.append(np.flatnonzero(~is_space(data)), len(data))
                points = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=points[1:])
                first = solid[np.searchsorted(solid, start)]
                last = np.searchsorted(solid, end) - 1
                full = (first < end) & (last >= 0)
                first, stop = first[full], solid[last[full]] + 1
                wide = points[stop] - points[first] >= min_chars
                first, stop, keep = first[wide], stop[wide], np.flatnonzero(full)[wide]
                lower = LOWER[data]
                take = pa.array(owner[keep])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(span_hashes(lower, first, stop).view(np.int64)),
                        pa.array(span_hashes(lower, first, stop, "check").view(np.int64)),
                        part.column("doc_id").take(take),
                        part.column("text_hash").take(take),
                        pa.array(at[keep], pa.int32()),
                        pa.array(np.arange(len(keep)), pa.int32()),
                    ],
                    names=_LINES.names,
                )

    return scan


def _whole(key: np.ndarray, check: np.ndarray, turned: int) -> np.ndarray:
    """Both halves of a key in 64 bits, for the perfect hash."""
    check = check.view(np.uint64)
    return key.view(np.uint64) ^ ((check << np.uint64(turned)) | (check >> np.uint64(64 - turned)))


def _build(table: pa.Table) -> pa.Table:
    """The arrays of one shard, in the order of its perfect hash."""
    key, check, count, last, lines = (table.column(name).to_numpy() for name in ("key", "check", "n_docs", "last", "n_lines"))
    # Should two keys look the same in 64 bits, another turn tells them apart.
    turned = next(k for k in range(1, 64) if len(np.unique(_whole(key, check, k))) == len(key))
    whole = _whole(key, check, turned)
    index = PerfectHash.build(whole)
    order = np.argsort(index.find(whole))
    row = {
        "shard": table.column("shard")[0].as_py(), "n_lines": int(lines.sum()), "turned": turned, "levels": index.dump(),
        "checks": check[order].tobytes(), "counts": np.minimum(count, MOST)[order].astype(np.uint32).tobytes(),
        "lasts": last[order].tobytes(),
    }
    kinds = [("shard", pa.int32()), ("n_lines", pa.int64()), ("turned", pa.int32()), *[(name, pa.binary()) for name in _ARRAYS[1:]]]
    return pa.Table.from_pylist([row], schema=pa.schema(kinds))


def _probe(arrays: dict, key: np.ndarray, check: np.ndarray, doc_id: np.ndarray, min_docs: int) -> np.ndarray:
    """Which lines are to be dropped."""
    checks, lasts = (np.frombuffer(arrays[name], np.int64) for name in ("checks", "lasts"))
    counts = np.frombuffer(arrays["counts"], np.uint32)
    place = PerfectHash.load(arrays["levels"]).find(_whole(key, check, arrays["turned"]))
    return (place >= 0) & (checks[place] == check) & (counts[place] >= min_docs) & (doc_id < lasts[place])


def _probe_piece(min_docs: int):
    def probe(lines: pa.Table, index: pa.Table) -> pa.Table:
        found = lines.select(_GONE)
        if not lines.num_rows:
            return found
        columns = [lines.column(name).to_numpy() for name in ("key", "check", "doc_id")]
        return found.filter(pa.array(_probe(index.select(_ARRAYS).to_pylist()[0], *columns, min_docs)))

    return probe


_GONE = ["doc_id", "text_hash", "at"]


def line_index(lines: DataFrame) -> DataFrame:
    """One row for each shard of the distinct lines: the perfect hash and the arrays in its order.

    ``lines`` are rows of key, check and doc_id. Shards are dealt by ``_shard``.
    """
    shard = _shard(lines.count())
    counts = lines.groupBy("key", "check").agg(
        F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last"), F.count("*").alias("n_lines")
    )
    return counts.withColumn("shard", shard).groupBy("shard").applyInArrow(_build, _INDEX)


def _shard(n_lines: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(max(1, -(-n_lines // SHARD)))).cast("int")


def dropped_lines(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Documents that lose lines: holder (doc_id, or the lowest long for null), text_hash, dropped (places from 0)."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    lines = stored(keyed.mapInArrow(tidy(_line_rows(min_chars)), _LINES), "lines")
    index = stored(line_index(lines), "line-index")
    pieces = F.ceil(F.col("n_lines") / PIECE).cast("int")
    wide = stored(index.where(F.col("n_lines") > PIECE).select("shard", pieces.alias("pieces")), "wide-shards")
    dealt = lines.withColumn("shard", _shard(lines.count())).join(wide, "shard", "left")
    probes = dealt.withColumn("piece", F.pmod(F.xxhash64("turn", "text_hash"), F.coalesce("pieces", F.lit(1))).cast("int")).drop("pieces")
    arrays = index.select("shard", F.explode(F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1)).alias("piece"), *_ARRAYS)
    gone = probes.groupBy("shard", "piece").cogroup(arrays.groupBy("shard", "piece")).applyInArrow(
        _probe_piece(min_docs), "doc_id long, text_hash long, at int"
    )
    return gone.groupBy(F.col("doc_id").alias("holder"), "text_hash").agg(F.collect_set("at").alias("dropped"))


def _left(text: Column, dropped: Column) -> Column:
    """The text without the lines at the dropped places."""
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    return F.when(dropped.isNull(), text).otherwise(F.array_join(F.transform(stay, lambda at: F.get(lines, at)), "\n"))


def _with_dropped(docs: DataFrame, gone: DataFrame, dropped: str) -> DataFrame:
    holder, text_hash = free_name(docs, "holder"), free_name(docs, "text_hash")
    gone = gone.select(F.col("holder").alias(holder), F.col("text_hash").alias(text_hash), F.col("dropped").alias(dropped))
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col(holder)) & (F.xxhash64("text") == F.col(text_hash))
    return docs.join(gone, same, "left").drop(holder, text_hash)


def dedup_lines(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The documents without their repeated lines. All columns but ``text`` stay as they are."""
    dropped = free_name(docs, "dropped")
    joined = _with_dropped(docs, dropped_lines(docs, min_chars=min_chars, min_docs=min_docs), dropped)
    return joined.withColumn("text", _left(F.col("text"), F.col(dropped))).select(*docs.columns)


def line_report(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_text."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    joined = _with_dropped(docs, dropped_lines(docs, min_chars=min_chars, min_docs=min_docs), "dropped")
    return joined.select(
        "doc_id",
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        _left(F.col("text"), F.col("dropped")).alias("kept_text"),
    )
