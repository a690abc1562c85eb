"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct shingles of ``size`` words; one of fewer words, but not
none, has a single shingle.
``HASHES`` permutations are evaluated once each, and both the minimum and the maximum are
kept: twice as many values for the same work, each equal for two sets with the probability of
their similarity. Bands of ``ROWS`` values from different permutations make buckets; two sets
of similarity 0.8 share none with a probability below 1e-6. What shares a bucket is a
candidate, and links are confirmed on the full sets: 100 * intersection >= 80 * union.

Equal sets are one node. Nodes of a bucket are not paired with each other: each is compared
with the least and the last node of its buckets, and links are closed to components. Pairs
that share a bucket of at most ``SMALL`` nodes and still are in different components are then
compared as they are. In larger buckets each node is first compared with the one nearest to
what most of them have in common (the core); of the other pairs across
components those are compared whose sizes and members outside the core allow a link (see
``_Cores``). So no link that could join components is lost, while a large group of near copies
costs a few comparisons a node and not one for each pair.

Defined cases: documents without words, or a null text, have an empty set and are linked with
nothing; so are rows with a null doc_id (their component_id is null, they are kept). Rows that
share a doc_id are compared like others, and a component takes its least doc_id; those rows of
it that have that doc_id are kept. An empty table gives an empty result.

Scale: texts are read twice and never shuffled. Sketches are stored once; only bands, ids,
and the sets of candidates move. A bucket with very many nodes is aggregated or joined (Spark
splits it), never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.bitmap import bitmap_of, may_hold
from fieldnorm.llm.components import components
from fieldnorm.llm.decontaminate import free_name
from fieldnorm.llm.storage import stored
from fieldnorm.llm.words import mixed, slices, tidy, windows, words_of

BANDS = 48
ROWS = 6  # half of them minima, half maxima
HASHES = BANDS * ROWS // 2
SIZE = 5  # words of a shingle
SMALL = 8
_KEPT_BYTES = 5  # of each shingle's hash, in sets that are compared

_SKETCH = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("row", "doc_id", "text_hash", "n_shingles", "set_a", "set_b")]
    + [T.StructField("bands", T.ArrayType(T.LongType()))]
)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles."""
    words = words_of(texts, signs=False, lower=True)
    shingles = windows(words.hash, size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        out.append(np.unique(shingles[a : b - size + 1]) if b - a >= size else windows(words.hash[a:b], b - a) if b > a else shingles[:0])
    return out


def _salts() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:HASHES], seeds[HASHES:] | np.uint64(1)


def min_max(sets: list[np.ndarray]) -> np.ndarray:
    """For each set that isn't empty, the minima and then the maxima under all permutations."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *[len(own) for own in sets[:-1]]])
    out = np.empty((2 * HASHES, len(sets)), np.uint64)
    salt, factor = _salts()
    for k in range(HASHES):
        order = (flat ^ salt[k]) * factor[k]
        np.minimum.reduceat(order, starts, out=out[k])
        np.maximum.reduceat(order, starts, out=out[HASHES + k])
    return out


def _bands(values: np.ndarray) -> np.ndarray:
    """Bucket keys, a row for each set. A band's minima and maxima are of different permutations."""
    half, out = ROWS // 2, np.empty((BANDS, values.shape[1]), np.uint64)
    for band in range(BANDS):
        key = np.full(values.shape[1], band + 1, np.uint64)
        for k in range(half):
            low, high = band * half + k, (band * half + k + HASHES // 2) % HASHES
            key = mixed(mixed(key ^ values[low]) ^ values[HASHES + high])
        out[band] = key
    return out.T


def _sketch(size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                full = np.flatnonzero([len(own) > 0 for own in sets])
                bands: list = [[]] * len(sets)
                if len(full):
                    keys = _bands(min_max([sets[k] for k in full])).view(np.int64)
                    for row, own in zip(full.tolist(), keys, strict=True):
                        bands[row] = own
                salt = np.uint64(0x5851F42D4C957F2D)
                sums = [[int(mixed(own ^ s).sum().view(np.int64)) for own in sets] for s in (np.uint64(0), salt)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + part.num_rows)),
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array([len(own) for own in sets], pa.int64()),
                        *[pa.array(x, pa.int64()) for x in sums],
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=_SKETCH.names,
                )
                number += part.num_rows

    return scan


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The sets of the given nodes (node, doc_id, text_hash): node, n, members."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap_of(nodes, F.xxhash64("doc_id", "text_hash")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(wanted.value, batch.column("both").to_numpy())))
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                kept = [own.view(np.uint8).reshape(-1, 8)[:, :_KEPT_BYTES].tobytes() for own in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array([len(own) for own in sets], pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "text_hash", "n", "members"],
                )

    keyed = docs.select("doc_id", "text_hash", F.xxhash64("doc_id", "text_hash").alias("both"), "text")
    sets = keyed.mapInArrow(tidy(scan), "doc_id long, text_hash long, n long, members binary")
    return stored(sets.join(nodes, ["doc_id", "text_hash"]).select("node", "n", "members"), "sets")


def _members(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _KEPT_BYTES, 8), np.uint8)
    out[:, :_KEPT_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _KEPT_BYTES)
    return out.view(np.uint64).ravel()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets are similar enough."""
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part, keep = batch.slice(at, 100), []
            rows = zip(*[part.column(name).to_pylist() for name in ("n_a", "members_a", "n_b", "members_b")], strict=True)
            for n_a, a, n_b, b in rows:
                both = len(np.intersect1d(_members(a), _members(b)))
                keep.append(100 * both >= 80 * (n_a + n_b - both))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are linked: a stored table."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("members").alias(f"members_{side}")), side)
    return stored(pairs.mapInArrow(tidy(_linked), "a long, b long"), "similar")


def _pairs(df: DataFrame, one: str, other: str) -> DataFrame:
    return df.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).where("a < b").distinct()


def _fit(n: str, m: str) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * 80


def _labelled(buckets: DataFrame, joined: DataFrame) -> DataFrame:
    return buckets.join(joined, "node", "left").withColumn("least", F.coalesce("least", "node"))


def _mixed(buckets: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of buckets whose nodes are in several components, with the node's component (least) and the bucket's main one."""
    labelled = _labelled(buckets.select("bucket", "node", "n", "nodes", "first"), joined)
    sizes = labelled.groupBy("bucket", "least").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max_by("least", F.struct("n", -F.col("least"))).alias("main"), F.count("*").alias("kinds"))
    return stored(labelled.join(main.where("kinds > 1").drop("kinds"), "bucket"), "mixed")


def _across(rows: DataFrame, others: DataFrame, on: list[str], *columns: str) -> DataFrame:
    """Pairs a, b of rows and others with the same values of ``on``, of different components and of fitting sizes.

    One side holds the nodes outside the main component, so that component's own pairs are not looked at.
    """
    kept = ["node", "least", "n", *columns]
    one = rows.where("least <> main").select(*on, *[F.col(c).alias(f"{c}_a") for c in kept])
    two = others.select(*on, *[F.col(c).alias(f"{c}_b") for c in kept], F.col("main").alias("main_b"))
    apart = (F.col("least_a") != F.col("least_b")) & ((F.col("least_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b")))
    return one.join(two, on).where(apart & _fit("n_a", "n_b"))


class _Cores:
    """What the sets of large mixed buckets have beyond a core.

    Nodes connected by such buckets are a family, and its core holds the shingles of more than
    half of its nodes (so it is less than twice an average set). Let x and y be sets of sizes n
    and m that have v and w members within the core, and s members outside it in common. Then
    they have at most min(v, w) + s members in common. With s = 0 they can only be linked if
    these numbers allow it. Otherwise s is at least 0.8 n - v, and 1: so y must hold one of the
    rarest members of x outside the core, of all but that number less one.
    """

    def __init__(self, sets: DataFrame, large: DataFrame):
        families = components(large.select(F.col("node").alias("a"), F.col("first.node").alias("b")))
        of = large.select("node").distinct().join(families, "node", "left").select("node", F.coalesce("least", "node").alias("family"))
        own = stored(sets.join(of, "node"), "family-sets")
        sizes = own.groupBy("family").agg(F.count("*").alias("nodes"))
        times = own.mapInArrow(tidy(_spread), "family long, member long").groupBy("family", "member").agg(F.count("*").alias("times"))
        core = times.where(F.col("times") * 2 > SMALL).join(sizes, "family").where("2 * times > nodes")
        cores = sizes.join(core.groupBy("family").agg(F.collect_list("member").alias("core")), "family", "left")
        apart = own.join(cores, "family").mapInArrow(tidy(_outside), "family long, node long, n long, within long, core_size long, outside array<long>")
        self.nodes = stored(apart.repartition("node"), "family-nodes")

    def with_central(self) -> DataFrame:
        """Pairs of each node with the node that differs least from the core."""
        off = F.col("n") + F.col("core_size") - 2 * F.col("within")
        central = self.nodes.groupBy("family").agg(F.min_by(F.struct("node", "n"), F.struct(off, "node")).alias("central"))
        near = self.nodes.join(central, "family").select("node", "n", F.col("central.node").alias("c"), F.col("central.n").alias("m"))
        return _pairs(near.where(_fit("n", "m")), "node", "c")

    def across(self, joined: DataFrame) -> DataFrame:
        """Pairs of nodes of families that still are in different components and may be linked."""
        nodes = _labelled(self.nodes, joined)
        sizes = nodes.groupBy("family", "least").agg(F.count("*").alias("nodes"))
        main = sizes.groupBy("family").agg(F.max_by("least", F.struct("nodes", -F.col("least"))).alias("main"), F.count("*").alias("kinds"))
        nodes = stored(nodes.join(main.where("kinds > 1").drop("kinds"), "family"), "family-labels")
        common, both = F.least("within_a", "within_b"), F.col("n_a") + F.col("n_b")
        # By family and not by bucket: a pair may share many buckets.
        direct = _across(nodes, nodes, ["family"], "within").where(common * 100 >= (both - common) * 80)

        member = ["family", "member"]
        own = nodes.where("least <> main").withColumn("member", F.explode("outside")).drop("outside")
        each = nodes.select("family", "node", F.explode("outside").alias("member"))
        times = each.groupBy(*member).agg(F.count("*").alias("times")).where("times > 1")
        ranked = own.join(times, member)
        # Members that no other set of the family holds come first, and are already gone.
        alone = F.col("n") - F.col("within") - F.count("*").over(Window.partitionBy("node"))
        rank = F.row_number().over(Window.partitionBy("node").orderBy("times", "member")) + alone
        needed = F.greatest(F.lit(1), F.ceil(F.col("n") * 0.8 - F.col("within")))
        rare = ranked.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.col("within") - needed + 1)
        others = each.join(rare.select(*member).distinct(), member, "left_semi").join(nodes.drop("outside", "family"), "node")
        # Those that sizes alone allow are direct pairs already; others need enough members outside the core.
        most = common + F.least(F.col("n_a") - F.col("within_a"), F.col("n_b") - F.col("within_b"))
        shared = _across(rare, others, member, "within").where((common * 100 < (both - common) * 80) & (most * 100 >= (both - most) * 80))
        return _pairs(direct.select("node_a", "node_b").union(shared.select("node_a", "node_b")), "node_a", "node_b")


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each member of each set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            sets = [_members(raw) for raw in part.column("members").to_pylist()]
            take = pa.array(np.repeat(np.arange(len(sets)), [len(own) for own in sets]))
            yield pa.RecordBatch.from_arrays(
                [part.column("family").take(take), pa.array(np.concatenate(sets).view(np.int64))], names=["family", "member"]
            )


def _outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many members of each set the core holds, and the other members."""
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part, rest = batch.slice(at, 100), []
            cores = [np.array(core or [], np.int64) for core in part.column("core").to_pylist()]
            for raw, core in zip(part.column("members").to_pylist(), cores, strict=True):
                rest.append(np.setdiff1d(_members(raw).view(np.int64), core))
            n = part.column("n").to_numpy()
            within = n - np.array([len(own) for own in rest], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("family"),
                    part.column("node"),
                    part.column("n"),
                    pa.array(within),
                    pa.array([len(core) for core in cores], pa.int64()),
                    pa.array(rest, pa.list_(pa.int64())),
                ],
                names=["family", "node", "n", "within", "core_size", "outside"],
            )


def near_duplicates(docs: DataFrame, *, size: int = SIZE) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sketches = stored(keyed.mapInArrow(tidy(_sketch(size)), _SKETCH), "sketches")
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    same = ["set_a", "set_b", "n_shingles"]
    nodes = full.groupBy(*same).agg(F.min("row").alias("node"))

    own = full.join(nodes.select(F.col("node").alias("row")), "row").select(
        F.col("row").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")
    )
    ends = [f(F.struct("node", "n")).alias(name) for name, f in (("first", F.min), ("last", F.max))]
    shared = own.groupBy("bucket").agg(*ends, F.count("*").alias("nodes")).where("nodes > 1")
    buckets = stored(own.join(shared, "bucket"), "buckets")
    active = full.join(buckets.select(F.col("node").alias("row")).distinct(), "row")
    sets = _sets_of(keyed, active.select(F.col("row").alias("node"), "doc_id", "text_hash"), size)

    ends = [F.when(_fit("n", f"{end}.n"), F.col(f"{end}.node")) for end in ("first", "last")]
    tried = buckets.groupBy("node").agg(F.min(ends[0]).alias("first"), F.max(ends[1]).alias("last"))
    tried = tried.select("node", F.explode(F.array("first", "last")).alias("other"))
    links = _similar(_pairs(tried, "node", "other"), sets)
    joined = components(links)

    mixed_rows = _mixed(buckets, joined)
    small = mixed_rows.where(F.col("nodes") <= SMALL)
    pairs = _across(small, small, ["bucket"]).select("node_a", "node_b")
    large = mixed_rows.where(F.col("nodes") > SMALL)
    if not large.isEmpty():
        cores = _Cores(sets, large)
        links = links.union(_similar(cores.with_central(), sets))
        joined = components(links)
        pairs = pairs.union(cores.across(joined))
    joined = components(links.union(_similar(_pairs(pairs, "node_a", "node_b"), sets)))

    of_row = full.select("row", *same).join(nodes, same).select("row", "node").join(joined, "node", "left")
    of_row = of_row.select("row", F.coalesce("least", "node").alias("component"))
    rows = sketches.select("row", "doc_id", "text_hash", "n_shingles").join(of_row, "row", "left")
    rows = rows.withColumn("component", F.coalesce("component", "row"))
    least_ids = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least_ids, "component").select(
        "doc_id", "text_hash", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def near_dedup(docs: DataFrame, *, size: int = SIZE) -> DataFrame:
    """The documents that are kept: one of each component. All columns stay.

    Rows that repeat both id and text are the same document and stay or go together.
    """
    doc_id, text_hash = free_name(docs, "kept_id"), free_name(docs, "kept_hash")
    kept = near_duplicates(docs, size=size).where("kept").select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_hash))
    return docs.join(kept, same, "left_semi").select(*docs.columns)


def one_of_each_group(docs: DataFrame, *, size: int = SIZE) -> DataFrame:
    """One row of each component, the first of those with its least doc_id; null ids come last. All columns stay.

    Rows are told apart by numbers of their own, so rows that repeat an id or have none are
    compared like others. Rows without words stay.
    """
    row = free_name(docs, "row_number")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), size=size).select(F.col("doc_id").alias("row"), "component_id")
    ids = numbered.select(F.col(row).alias("row"), F.col("doc_id").alias("id"))
    first = groups.join(ids, "row").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    kept = first.select(F.col("first.row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)
