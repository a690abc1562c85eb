"""Benchmark passages in training texts: a broadcast hash set of test windows, verified hits.

A window is ``size`` consecutive words of an item; an item of fewer words (but one at
least) is one window. Words are runs of letters, digits and non-ASCII characters, A-Z
lower-cased. A document word is hit if any occurrence of any window covers it.

Defined cases: a null or empty text has no words and is never hit; an item without words
has no windows; an item with a null id marks words but is not listed; items with the same
id are one item; repeated documents are judged one by one; an empty benchmark hits nothing.
Input columns may have any names: the columns added here take free ones.

Scale: documents are scanned where they are read, with no shuffle. The window table is
broadcast in blocks of at most ``block_bytes`` of item text (one longer item is a block of
its own); a benchmark beyond one block takes one more scan of the documents for each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.storage import stored
from fieldnorm.llm.words import slices, tidy, windows, words_of

BLOCK_BYTES = 4 << 20
_FILTER_BITS = 22


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


class WindowSet:
    """The windows of some items, by length in words: hashes, a filter, exact words."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        found: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(lambda: defaultdict(dict))
        words = words_of(pa.array([text for _, text in items], pa.string()), signs=True, lower=True)
        for row, (item_id, _) in enumerate(items):
            a, b = words.first[row], words.first[row + 1]
            length = min(size, int(b - a))
            if not length:
                continue
            for at, key in enumerate(windows(words.hash[a:b], length).tolist(), start=int(a)):
                ids = found[length][key].setdefault(self.text(words, at, length), set())
                if item_id is not None:
                    ids.add(item_id)
        self.exact = {length: dict(keys) for length, keys in found.items()}
        self.sorted = {length: np.sort(np.array(list(keys), np.uint64)) for length, keys in self.exact.items()}
        self.filter = {}
        for length, keys in self.sorted.items():
            self.filter[length] = np.zeros(1 << _FILTER_BITS, bool)
            self.filter[length][(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    @staticmethod
    def text(words, at: int, length: int) -> bytes:
        return b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[at : at + length], words.end[at : at + length], strict=True))

    def hits(self, words) -> Iterator[tuple[int, int, set[str]]]:
        """Verified occurrences: place of the first word, number of words, item ids."""
        until = words.until()
        for length, keys in self.sorted.items():
            seen = windows(words.hash, length)
            maybe = np.flatnonzero(self.filter[length][(seen >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            maybe = maybe[maybe + length <= until[maybe]]
            place = np.minimum(np.searchsorted(keys, seen[maybe]), len(keys) - 1)
            maybe = maybe[keys[place] == seen[maybe]]
            for at in maybe.tolist():
                ids = self.exact[length][int(seen[at])].get(self.text(words, at, length))
                if ids is not None:
                    yield at, length, ids


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in groups of about ``block_bytes`` of text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-2 * total // block_bytes) if total > block_bytes else 1
    for block in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block) if n > 1 else items
        yield [(row.item_id, row.text) for row in part.collect()]


def _marked(windows_of_block: WindowSet, text: str, runs: str, ids: str) -> Callable:
    """Adds this block's verified hits to the state columns ``runs`` and ``ids``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                words = words_of(part.column(part.schema.get_field_index(text)), signs=True, lower=True)
                hit = np.zeros(len(words.hash) + 1, np.int32)
                items: dict[int, set[str]] = defaultdict(set)
                for at, length, found in windows_of_block.hits(words):
                    hit[at] += 1
                    hit[at + length] -= 1
                    items[int(np.searchsorted(words.first, at, side="right")) - 1] |= found
                rows = part.num_rows
                out_runs = part.column(part.schema.get_field_index(runs)).to_pylist()
                out_ids = part.column(part.schema.get_field_index(ids)).to_pylist()
                if items:
                    hit = np.cumsum(hit[:-1]) > 0
                    for row in items:
                        a, b = words.first[row], words.first[row + 1]
                        own = hit[a:b].copy()
                        for start, end in out_runs[row]:
                            own[start:end] = True
                        edge = np.diff(own.astype(np.int8), prepend=0, append=0)
                        pairs = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
                        out_runs[row] = [list(pair) for pair in pairs]
                        out_ids[row] = sorted({*out_ids[row], *items[row]})
                state = {runs: pa.array(out_runs, pa.list_(pa.list_(pa.int32()))), ids: pa.array(out_ids, pa.list_(pa.string()))}
                assert len(out_runs) == rows
                yield pa.RecordBatch.from_arrays(
                    [state.get(name, part.column(k)) for k, name in enumerate(part.schema.names)], names=part.schema.names
                )

    return scan


def mark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    runs: str,
    ids: str,
    then: Callable | None = None,
    out_schema: T.StructType | None = None,
    *,
    size: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with two more columns, or what ``then`` makes of their batches in the same pass.

    ``runs``: maximal runs of hit words as ``[first, end)``, words counted from 0.
    ``ids``: sorted ids of the items whose windows occur.
    """
    state = [T.StructField(runs, T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField(ids, T.ArrayType(T.StringType()))]
    out = docs.withColumns({field.name: F.array().cast(field.dataType) for field in state})
    schema, scan = T.StructType([*docs.schema.fields, *state]), None
    for items in _blocks(benchmark, block_bytes):
        if scan is not None:
            out = stored(out.mapInArrow(tidy(scan), schema), "hits")
        scan = _marked(WindowSet(items, size), "text", runs, ids)
    if then is None:
        return out.mapInArrow(tidy(scan), schema)
    return out.mapInArrow(tidy(lambda batches: then(scan(batches))), out_schema)


def contamination(docs: DataFrame, benchmark: DataFrame, *, size: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, item_ids, runs, contaminated."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), signs=True, lower=True, hashes=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(words.first), pa.int64()), part.column("runs"), part.column("item_ids")],
                    names=["doc_id", "n_words", "runs", "item_ids"],
                )

    kept = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(T.ArrayType(T.IntegerType()))),
            T.StructField("item_ids", T.ArrayType(T.StringType())),
        ]
    )
    found = mark_hits(
        docs.select("doc_id", "text"), benchmark, "runs", "item_ids", counted, kept, size=size, block_bytes=block_bytes
    )
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda total, run: total + (run[1] - run[0]))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids", "runs",
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, size: int = 10, drop_share: float = 0.5, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents without their hit words.

    Each run of hit words is cut out, from its first to its last character; what stands
    around it stays. A document of which ``drop_share`` of the words or more is hit goes.
    Windows are judged on the input, not on what is left. All columns are kept as they are
    but for ``text``.
    """
    runs, ids = free_name(docs, "hit_runs"), free_name(docs, "hit_items")
    names, schema = docs.columns, docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(part.schema.get_field_index("text"))
                words = words_of(texts, signs=True, lower=False, hashes=False)
                out, keep = texts.to_pylist(), np.ones(part.num_rows, bool)
                for row, own in enumerate(part.column(part.schema.get_field_index(runs)).to_pylist()):
                    if not own:
                        continue
                    a, n = words.first[row], words.first[row + 1] - words.first[row]
                    keep[row] = sum(end - start for start, end in own) < drop_share * n
                    left, at = [], words.row[row]
                    for start, end in own:
                        left.append(words.data[at : words.start[a + start]].tobytes())
                        at = words.end[a + end - 1]
                    left.append(words.data[at : words.row[row + 1]].tobytes())
                    out[row] = b"".join(left).decode()
                columns = [
                    pa.array(out, texts.type) if name == "text" else part.column(k)
                    for k, name in enumerate(part.schema.names)
                    if name not in (runs, ids)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    return mark_hits(docs, benchmark, runs, ids, cut, schema, size=size, block_bytes=block_bytes)
