"""Vector codes by exact integer k-means over parts, with products from limb-split GEMM.

A component x becomes the integer floor(4096 x). Vectors are cut into ``PARTS`` equal parts;
each part position has a codebook of ``ENTRIES`` entries, which starts as that part of the
vectors with the smallest ids. Each of ``ROUNDS`` rounds assigns every part to its nearest
entry (squared Euclidean distance, ties to the lower index) and replaces each entry by the
componentwise floor of its parts' mean; entries without parts stay. A vector's code is the
indexes of a last assignment, its error the sum of its parts' squared distances.

Exactness: an integer of 31 bits is split into a low limb of 16 bits without sign and a high
one with sign. The four products of limb matrices run as float64 GEMM, whose sums stay below
2**53 for parts of up to 2**21 components; dot products are put together in int64, distances
are |x|^2 - 2 x.c + |c|^2, and the first least one wins. Where a vector or an entry is so long
that a distance could pass 63 bits, that vector is compared in Python integers instead. Sums
for the new entries travel as 32-bit limbs, so they are exact for any number of rows.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped;
rows without an id come last in the order of ids, rows of one id are ordered by their vector;
vectors shorter than the longest, or whose length the parts don't divide, are filled with zeros
at the end; with fewer rows than entries the codebooks have that many entries; an error beyond
64 bits is null, and so is the sum of errors over its label; no rows give no rows. Input columns
may have any names.

Scale: vectors are turned into integers once and stored; each round is one scan with the
codebooks (entries times length numbers) as a broadcast, and returns for each task one row of
sums for each entry, which Spark adds up. Nothing is grouped by vector or label but the sums
of errors: labels are pre-aggregated, and a hot label is only a skewed join that Spark splits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.storage import stored
from fieldnorm.llm.words import tidy

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMB = 16
_CELLS = 1 << 20  # numbers of a batch that are worked on at a time
_SUM_LIMB = 32


def limb_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of int64 rows (31 bits and sign at most), modulo 2**64."""
    if x.shape[1] > 1 << 53 - 2 * LIMB:
        raise ValueError(f"parts of {x.shape[1]} components are too long for exact products")
    halves = [[(m & ((1 << LIMB) - 1)).astype(np.float64), (m >> LIMB).astype(np.float64)] for m in (x, c)]
    out = np.zeros((len(x), len(c)), np.int64)
    for i, left in enumerate(halves[0]):
        for j, right in enumerate(halves[1]):
            out += (left @ right.T).astype(np.int64) << np.int64(LIMB * (i + j))
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the first nearest row of c, and the squared distance. Both of int64, or Python integers."""
    if x.dtype == object or c.dtype == object:
        x, c = x.astype(object), c.astype(object)
        found = [[int(((row - entry) ** 2).sum()) for entry in c] for row in x]
        at = [distances.index(min(distances)) for distances in found]
        return np.array(at, np.int64), np.array([d[k] for d, k in zip(found, at, strict=True)], object)
    distances = (x * x).sum(axis=1)[:, None] - 2 * limb_products(x, c) + (c * c).sum(axis=1)[None, :]
    at = distances.argmin(axis=1)
    return at, distances[np.arange(len(x)), at]


def _floor(x: float) -> int:
    """floor(4096 x), also where the product has no double."""
    return int(x) * SCALE if abs(x) >= 2.0**52 else math.floor(x * SCALE)


def integers(df: DataFrame, vector: str = "embedding", keep: dict[str, str] | None = None) -> DataFrame:
    """Kept rows with their components as integers: ``ints`` (bytes of int32) or, where one has more bits, ``wide`` (text).

    ``keep`` maps further columns to their new names.
    """
    keep = keep or {}
    schema = T.StructType(
        [
            *[T.StructField(new, df.schema[old].dataType) for old, new in keep.items()],
            T.StructField("ints", T.BinaryType()),
            T.StructField("wide", T.ArrayType(T.StringType())),
            T.StructField("length", T.IntegerType()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _row_slices(batch, "vector"):
                vectors = part.column("vector")
                lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy().astype(np.int64)
                flat = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
                first = np.concatenate([[0], np.cumsum(lengths)])
                owner = np.repeat(np.arange(len(lengths)), lengths)
                good = np.bincount(owner[~np.isfinite(flat)], minlength=len(lengths)) == 0
                good &= vectors.is_valid().to_numpy(zero_copy_only=False)
                with np.errstate(invalid="ignore", over="ignore"):
                    scaled = np.floor(flat * SCALE)
                    fits = np.bincount(owner[~(np.abs(scaled) < 2**31)], minlength=len(lengths)) == 0
                    packed = np.where(np.abs(scaled) < 2**31, scaled, 0).astype("<i4")
                rows = np.flatnonzero(good)
                ints = [packed[first[r] : first[r + 1]].tobytes() if fits[r] else None for r in rows]
                wide = [None if fits[r] else [str(_floor(x)) for x in flat[first[r] : first[r + 1]].tolist()] for r in rows]
                columns = [part.column(new).take(pa.array(rows)) for new in keep.values()]
                columns += [pa.array(ints, pa.binary()), pa.array(wide, pa.list_(pa.string())), pa.array(lengths[rows], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    chosen = df.select(F.col(vector).alias("vector"), *[F.col(old).alias(new) for old, new in keep.items()])
    return chosen.mapInArrow(tidy(scan), schema)


def _row_slices(batch: pa.RecordBatch, vector: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with a bounded number of components (one row at least)."""
    lengths = pc.fill_null(pc.list_value_length(batch.column(vector)), 0).to_numpy()
    ends, at = np.cumsum(lengths), 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + _CELLS, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _matrices(batch: pa.RecordBatch, size: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows and their components, filled up to ``size``: int64 below ``limit``, Python integers above."""
    step = max(1, _CELLS // max(size, 1))
    for a in range(0, batch.num_rows, step):
        part = batch.slice(a, step)
        ints, wide = part.column("ints").to_pylist(), part.column("wide").to_pylist()
        matrix = np.zeros((len(ints), size), np.int64)
        own = [r for r, x in enumerate(ints) if x is not None]
        if len(own) == len(ints) and all(len(x) == 4 * size for x in ints):
            matrix = np.frombuffer(b"".join(ints), "<i4").reshape(len(ints), size).astype(np.int64)
        else:
            for r in own:
                matrix[r, : len(ints[r]) // 4] = np.frombuffer(ints[r], "<i4")
        narrow = np.array([x is not None for x in ints], bool) & (np.abs(matrix).max(axis=1, initial=0) < limit)
        if narrow.all():
            yield np.arange(a, a + len(ints)), matrix
            continue
        yield a + np.flatnonzero(narrow), matrix[narrow]
        others = matrix[~narrow].astype(object)
        for k, r in enumerate(np.flatnonzero(~narrow)):
            if wide[r] is not None:
                others[k, : len(wide[r])] = [int(x) for x in wide[r]]
        yield a + np.flatnonzero(~narrow), others


@dataclass
class Codebooks:
    """Entries by part, entry and place in the part, as Python integers; ``length`` is that of the longest vector."""

    entries: np.ndarray
    length: int

    @property
    def size(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    @property
    def limit(self) -> int:
        """Components below it in size cannot give a sum of squared distances of 63 bits."""
        return 1 << (60 - max(self.size - 1, 1).bit_length()) // 2

    def by_part(self) -> list[np.ndarray]:
        narrow = not self.entries.size or max(map(abs, self.entries.ravel().tolist())) < self.limit
        return [part.astype(np.int64) if narrow else part for part in self.entries]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """Codebooks of the rows with the smallest ids, from the stored rows of ``integers`` with ``id``."""
    length = rows.agg(F.max("length")).first()[0] or 0
    across = -(-length // parts)
    chosen = rows.orderBy(F.col("id").asc_nulls_last(), "ints", "wide").limit(entries).select("ints", "wide").collect()
    found = np.zeros((len(chosen), parts * across), object)
    for k, row in enumerate(chosen):
        own = np.frombuffer(row.ints, "<i4").tolist() if row.ints is not None else [int(x) for x in row.wide]
        found[k, : len(own)] = own
    return Codebooks(found.reshape(len(chosen), parts, across).transpose(1, 0, 2), length)


def _sum_limbs(value: int, count: int) -> list[int]:
    """``count`` limbs from the lowest; the last one keeps the sign."""
    low = [(value >> _SUM_LIMB * k) & ((1 << _SUM_LIMB) - 1) for k in range(count - 1)]
    return [*low, value >> _SUM_LIMB * (count - 1)]


def next_codebooks(rows: DataFrame, books: Codebooks, limbs: int) -> Codebooks:
    """One round: assign all parts and take the floors of the means."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, across = books.entries.shape

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, by_part = shared.value, shared.value.by_part()
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, across), object)
        for batch in batches:
            for _, matrix in _matrices(batch, own.size, own.limit):
                for p, c in enumerate(by_part):
                    x = matrix[:, p * across : (p + 1) * across]
                    at, _ = nearest(x, c)
                    counts[p] += np.bincount(at, minlength=entries)
                    if x.dtype == object:
                        for k, row in zip(at.tolist(), x, strict=True):
                            sums[p, k] += row
                    else:
                        # A batch has at most 2**20 numbers of 31 bits, so these float sums are exact.
                        added = [np.bincount(at, weights=x[:, j], minlength=entries) for j in range(across)]
                        sums[p] += np.array(added, np.int64).reshape(across, entries).T.astype(object)
        cells = np.flatnonzero(counts.ravel())
        flat = sums.reshape(parts * entries, across)
        values = [[limb for value in flat[cell].tolist() for limb in _sum_limbs(int(value), limbs)] for cell in cells.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(counts.ravel()[cells]), pa.array(values, pa.list_(pa.int64()))], names=["cell", "n", "sums"]
        )

    found = rows.select("ints", "wide").mapInArrow(tidy(scan), "cell int, n long, sums array<long>")
    # A vector of no components still counts, at place 0.
    long = found.select("cell", "n", F.posexplode_outer("sums").alias("place", "value"))
    total = long.groupBy("cell", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).toArrow()
    out = books.entries.copy()
    sums, counts = {}, {}
    for cell, place, n, value in zip(*(total.column(name).to_pylist() for name in ("cell", "place", "n", "value")), strict=True):
        counts[cell] = n
        if place is not None:
            key = cell, place // limbs
            sums[key] = sums.get(key, 0) + (value << _SUM_LIMB * (place % limbs))
    for (cell, j), value in sums.items():
        out[cell // entries, cell % entries, j] = value // counts[cell]
    return Codebooks(out, books.length)


def learn_codebooks(rows: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from the stored rows of ``integers``, which must have ``id``."""
    books = first_codebooks(rows, parts, entries)
    longest = rows.select(F.max(F.expr("aggregate(wide, 0, (most, x) -> greatest(most, length(x)))"))).first()[0] or 10
    limbs = -(-(4 * longest + 40) // _SUM_LIMB)  # four bits hold a decimal digit; a task sums less than 2**40 rows
    for _ in range(rounds):
        books = next_codebooks(rows, books, limbs)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Adds ``code`` (two hex digits a part) and ``error`` to rows of ``integers`` and takes their components away."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    others = [field for field in rows.schema.fields if field.name not in ("ints", "wide", "length")]
    schema = T.StructType([*others, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, by_part = shared.value, shared.value.by_part()
        across = own.entries.shape[2]
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(by_part)), np.uint8)
            errors: list[int | None] = [0] * batch.num_rows
            for places, matrix in _matrices(batch, own.size, own.limit):
                total = np.zeros(len(places), object)
                for p, c in enumerate(by_part):
                    at, distance = nearest(matrix[:, p * across : (p + 1) * across], c)
                    codes[places, p] = at
                    total += distance.astype(object)
                for place, value in zip(places.tolist(), total.tolist(), strict=True):
                    errors[place] = int(value) if value < 1 << 63 else None
            columns = [batch.column(field.name) for field in others]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(errors, pa.int64())], names=schema.names
            )

    return rows.mapInArrow(tidy(scan), schema)


def vector_codes(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per kept vector: vec_id, label, code, error, label_error and codebooks_sha256."""
    if not 1 <= entries <= 256:
        raise ValueError("a code's part is one byte: 1 to 256 entries")
    rows = stored(integers(df, vector, {vec_id: "id", label: "of"}), "vector-integers")
    books = learn_codebooks(rows, parts=parts, entries=entries, rounds=rounds)
    coded = stored(encode(rows, books), "vector-codes")
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("of").alias("label")).agg(F.when(F.count("error") == F.count("*"), whole).try_cast("long").alias("label_error"))
    return coded.join(sums, F.col("of").eqNullSafe(F.col("label"))).select(
        F.col("id").alias("vec_id"), "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
