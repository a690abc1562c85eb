"""A filter of fixed size over 64-bit values: it may let others through, but loses none."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnorm.llm.storage import dropping_shuffles
from fieldnorm.llm.words import tidy

BITS = 25  # 4 MB, whatever the number of values


def bitmap_of(df: DataFrame, value: Column, bits: int = BITS) -> np.ndarray:
    """Built from at most ``2 ** bits / 64`` rows of 64 bits each, or-ed by Spark."""
    at = F.shiftrightunsigned(F.xxhash64(value), 64 - bits)
    words = df.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int")).alias("bit"))
    with dropping_shuffles(df.sparkSession):
        rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64(values: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of a bigint column (seed 42)."""
    p1, p2, p3, p4, p5 = (
        np.uint64(x)
        for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )
    x = _rotated(values.view(np.uint64) * p2, 31) * p1
    x = (np.uint64(42) + p5 + np.uint64(8)) ^ x
    x = _rotated(x, 27) * p1 + p4
    x = (x ^ (x >> np.uint64(33))) * p2
    x = (x ^ (x >> np.uint64(29))) * p3
    return x ^ (x >> np.uint64(32))


def may_hold(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = xxhash64(values) >> np.uint64(64 - 6 - (len(bitmap).bit_length() - 1))
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def spread_bitmap_of(df: DataFrame, bits: int) -> np.ndarray:
    """The same over the column ``key`` of hashes, placed by their own first bits. Places move in packed blocks."""
    ranges = 16  # a task ors one of them

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.sort((batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.uint32))
                cuts = np.searchsorted(at, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(bits - 4))
                own = [k for k in range(ranges) if cuts[k] < cuts[k + 1]]
                raw = [at[cuts[k] : cuts[k + 1]].tobytes() for k in own]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(raw, pa.binary())], names=["range", "places"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("range").to_pylist(), batch.column("places").to_pylist(), strict=True):
                if k not in marked:
                    marked[k] = np.zeros(1 << bits - 4, bool)
                marked[k][np.frombuffer(raw, np.uint32) - np.uint32(k << bits - 4)] = True
        if marked:
            raw = [np.packbits(own, bitorder="little").tobytes() for own in marked.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(marked), pa.int32()), pa.array(raw, pa.binary())], names=["range", "places"])

    blocks = df.select("key").mapInArrow(tidy(scan), "range int, places binary").repartitionById(ranges, "range")
    with dropping_shuffles(df.sparkSession):
        rows = blocks.mapInArrow(tidy(joined), "range int, places binary").toArrow()
    out = np.zeros((ranges, (1 << bits) // 8 // ranges), np.uint8)
    for k, raw in zip(rows.column("range").to_pylist(), rows.column("places").to_pylist(), strict=True):
        out[k] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1).view("<u8")


def may_hold_spread(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) >> np.uint64(64 - 6 - (len(bitmap).bit_length() - 1))
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
