"""Substring deduplication by edges of a De Bruijn graph of words, grouped by anchors.

Each run of ``size`` consecutive words of a document is an edge. Neighbouring edges that
share their least inner run of ``ANCHOR`` words (their anchor) form a path, so a document is a
chain of paths, and equal text gives equal paths but for its two ends. Paths stand in place of
compacted ones: they are cut inside a row, no nodes are made and no join extends a path over its
end. Joins attach counts by anchor: where all paths of an anchor are equal, nothing branches
there, and the path stays one row for all its edges. Only where different paths share an anchor are single
edges counted: those of paths that occur once, and one copy of those that occur more often.
A repeated edge covers its words in the document at the place it came from.

Edges and paths are compared by 128 bits of hash: 64 of the anchor's words, 64 of all words.
Repeats are not compared word by word at their places.

Defined cases: a null text has no words; texts of fewer words than ``size`` have no edge and
stay whole; rows that repeat a text are repeats of each other; rows that share a doc_id count
as different places; an empty table gives an empty result.

Scale: words are hashed in place in three narrow scans; the first finds anchors that occur
twice, the second writes their paths, the third the edges of branching ones. What passes from
one scan to the next is a filter of fixed size that loses nothing; exact joins follow. Only
rows of paths and edges that may repeat move, counted with map-side sums, and joined in a way
that Spark can split. Texts are shuffled once, to meet the spans to remove.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.bitmap import bitmap_of, may_hold
from fieldnorm.llm.storage import stored
from fieldnorm.llm.words import mixed, powers, slices, sums, text_bytes, tidy, windows, words_of

SIZE = 35
ANCHOR = 8
_PLACE_BITS = 30  # an Arrow text has fewer words than 2 ** 30


class Paths:
    """The paths of a slice of texts: first edge, number of edges, anchor's hash, path's hash."""

    def __init__(self, texts: pa.Array, size: int):
        self.size, self.words = size, words_of(texts, signs=False, lower=False)
        hashes = self.words.hash
        anchor = min(ANCHOR, size)
        inner = windows(hashes, anchor)
        n = len(hashes) - size + 1
        self.first = self.edges = np.zeros(0, np.int64)
        self.anchor = self.path = np.zeros(0, np.uint64)
        if n <= 0:
            return
        # The least hash in each edge; of equal ones the first, which is the same one in equal edges.
        place = np.uint64(_PLACE_BITS)
        least = (inner >> place << place) | np.arange(len(inner), dtype=np.uint64)
        span, width = size - anchor + 1, 1
        while 2 * width <= span:
            least, width = np.minimum(least[: len(least) - width], least[width:]), 2 * width
        least = np.minimum(least[:n], least[span - width : span - width + n])
        at = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        edge = np.flatnonzero(np.arange(n) + size <= self.words.until()[:n])
        if not len(edge):
            return
        at = at[edge]
        begins = np.ones(len(edge), bool)
        begins[1:] = (at[1:] != at[:-1]) | (edge[1:] != edge[:-1] + 1)
        begins = np.flatnonzero(begins)
        self.first, self.edges = edge[begins], np.diff(np.append(begins, len(edge)))
        self.anchor = inner[at[begins]]
        total = sums("word", hashes)
        stop = self.first + self.edges + size - 1
        self.path = mixed((total[stop] - total[self.first]) * powers("word", len(total))[1][self.first] + self.edges.astype(np.uint64))

    def owner(self) -> np.ndarray:
        """The row of each path."""
        return np.searchsorted(self.words.first, self.first, side="right") - 1

    def edges_of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the chosen paths, every edge's place, and the path (among the chosen) that it is of."""
        n = self.edges[chosen]
        of = np.repeat(np.arange(len(chosen)), n)
        return self.first[chosen][of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), of


def _key(anchor: np.ndarray, path: np.ndarray) -> np.ndarray:
    """One value for a path, for filters."""
    return mixed(anchor * np.uint64(0x9E3779B97F4A7C15) ^ path)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _anchors(size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                anchor, n = np.unique(Paths(part.column("text"), size).anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([_long(anchor), _long(n)], names=["anchor", "n"])

    return scan


_PATHS = "anchor long, path long, key long, doc_id long, text_hash long, first int, edges int"


def _paths(size: int, anchors):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                paths = Paths(part.column("text"), size)
                may = np.flatnonzero(may_hold(anchors.value, paths.anchor))
                row = paths.owner()[may]
                take = pa.array(row)
                anchor, path = paths.anchor[may], paths.path[may]
                yield pa.RecordBatch.from_arrays(
                    [
                        _long(anchor),
                        _long(path),
                        _long(_key(anchor, path)),
                        part.column("doc_id").take(take),
                        part.column("text_hash").take(take),
                        pa.array((paths.first[may] - paths.words.first[row]).astype(np.int32)),
                        pa.array(paths.edges[may].astype(np.int32)),
                    ],
                    names=["anchor", "path", "key", "doc_id", "text_hash", "first", "edges"],
                )

    return scan


_EDGES = "anchor long, edge long, n int, doc_id long, text_hash long, first int"


def _edges(size: int, single, copies):
    """Edges of paths that occur once, with their places; edges of others, once in a slice, as two."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                paths = Paths(part.column("text"), size)
                key = _key(paths.anchor, paths.path)
                alone = may_hold(single.value, key)
                others = np.flatnonzero(~alone & may_hold(copies.value, key))
                others = others[np.unique(key[others], return_index=True)[1]]
                hashes = windows(paths.words.hash, size)
                for chosen, n in ((np.flatnonzero(alone), 1), (others, 2)):
                    at, of = paths.edges_of(chosen)
                    row = paths.owner()[chosen][of]
                    placed = pa.array(row, mask=np.full(len(row), n > 1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            _long(paths.anchor[chosen][of]),
                            _long(hashes[at]),
                            pa.array(np.full(len(at), n, np.int32)),
                            part.column("doc_id").take(placed),
                            part.column("text_hash").take(placed),
                            pa.array((at - paths.words.first[row]).astype(np.int32)),
                        ],
                        names=["anchor", "edge", "n", "doc_id", "text_hash", "first"],
                    )

    return scan


def repeated_edges(docs: DataFrame, *, size: int = SIZE) -> DataFrame:
    """Runs of repeated edges: doc_id, text_hash, first (word, from 0), edges (so many places in a row)."""
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    shared = spark.sparkContext.broadcast

    anchors = keyed.select("text").mapInArrow(tidy(_anchors(size)), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    twice = shared(bitmap_of(anchors.where("n > 1"), F.col("anchor")))
    paths = stored(keyed.mapInArrow(tidy(_paths(size, twice)), _PATHS), "paths")

    kinds = paths.groupBy("anchor", "path", "key").agg(F.count("*").alias("n"))
    of_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("singles"))
    kinds = stored(kinds.join(of_anchor, "anchor").where("n > 1 or kinds > 1"), "path-kinds")
    whole = paths.join(kinds.where("n > 1").select("anchor", "path"), ["anchor", "path"]).select("doc_id", "text_hash", "first", "edges")

    single = shared(bitmap_of(kinds.where("n = 1"), F.col("key")))
    copies = shared(bitmap_of(kinds.where("n > 1 and singles > 0"), F.col("key")))
    edges = stored(keyed.mapInArrow(tidy(_edges(size, single, copies)), _EDGES), "edges")
    repeated = edges.groupBy("anchor", "edge").agg(F.sum("n").alias("total")).where("total > 1").select("anchor", "edge")
    placed = edges.where("n = 1").join(repeated, ["anchor", "edge"]).select("doc_id", "text_hash", "first", F.lit(1).alias("edges"))
    return whole.unionByName(placed)


def _covered(n: int, spans, size: int) -> np.ndarray:
    """Which of n words are covered by the edges of some spans (first, edges)."""
    steps = np.zeros(n + 1, np.int32)
    first, edges = np.array(spans, np.int64).reshape(-1, 2).T
    np.add.at(steps, first, 1)
    np.add.at(steps, first + edges + size - 1, -1)
    return np.cumsum(steps[:n]) > 0


_REPORT = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]


def without_repeats(docs: DataFrame, *, size: int = SIZE) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    Every place of a repeated run loses its words, the first one too.
    """
    spans = repeated_edges(docs, size=size).groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"))
    spans = spans.agg(F.collect_set(F.array("first", "edges")).alias("spans"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("of_hash"))
    joined = docs.select("doc_id", "text").join(spans, same, "left").select("doc_id", "text", "spans")
    schema = T.StructType([docs.schema["doc_id"], *_REPORT])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, row = text_bytes(part.column("text"))
                raw, out = data.tobytes(), []
                spans_of = part.column("spans").to_pylist()
                for at, to, own in zip(row[:-1].tolist(), row[1:].tolist(), spans_of, strict=True):
                    words = raw[at:to].split()
                    n = len(words)
                    if own:
                        words = list(compress(words, (~_covered(n, own, size)).tolist()))
                    out.append((n, n - len(words), b" ".join(words).decode()))
                columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=schema.names)

    return joined.mapInArrow(tidy(cut), schema)
