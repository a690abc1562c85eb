"""Contiguous shards of nearly equal bytes, in DataFrame functions only.

Documents are put in one global order (doc_id, nulls first; then crc32 of the text, its size
and, for equal ones, their place in the input). A document weighs its UTF-8 bytes plus 1. With
``start`` the bytes in front of it, it goes to shard ``floor(n * (start + weight / 2) / total)``:
the order is cut at ``n`` equal targets, each at the nearest document border.

How: a range shuffle gives ordered partitions, whose rows are numbered in order and stored.
Rows fall into blocks of ``2 ** BLOCK_BITS`` numbers; bytes and rows are summed per block, then
per partition, and prefix sums run over the partitions' totals and inside each over its
blocks. Only blocks that a target falls into (one for each cut at most) look at single rows,
to find the first row of each shard. A row's shard and slot follow from its number and what
its block says; no running sum over all rows is made.

Defined cases: a null text weighs 1; null ids come first; repeated rows are documents of
their own, told apart by their place; with fewer documents than shards, or one that is larger
than a shard, shards between stay empty; an empty table gives an empty result; input columns
may have any names.

Scale: only (id, size, crc) move for ``shard_places``, once; ``shard_documents`` moves whole
rows once. Many rows of one id, or of one text, are spread by the later parts of the order.
A block has at most 65,536 rows. The one unpartitioned window runs over totals of partitions,
one row for each task. The table of blocks is joined by block, which no key dominates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldnorm.llm.storage import stored

BLOCK_BITS = 16
_TASK_BITS = 33  # monotonically_increasing_id counts below them, a fixed value of Spark


def _placed(rows: DataFrame) -> DataFrame:
    """Rows (row, id, size, crc, nr) stored in the global order, numbered by ``at``."""
    order = ["id", "crc", "size", "nr"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.select("row", "size", "crc", F.monotonically_increasing_id().alias("at")), "shard-order")


def _rows(docs: DataFrame, row: Column, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        row.alias("row"),
        F.col(doc_id).alias("id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("crc"),
        F.monotonically_increasing_id().alias("nr"),
    )


def _before(name: str, window) -> Column:
    return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def _blocks(placed: DataFrame) -> DataFrame:
    """One row per block: its rows and bytes, and those in front of it."""
    totals = placed.groupBy(F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    totals = stored(totals.withColumn("task", F.shiftright("block", _TASK_BITS - BLOCK_BITS)), "shard-blocks")
    tasks = totals.groupBy("task").agg(F.sum("n").alias("task_n"), F.sum("bytes").alias("task_bytes"))
    over_tasks, over_blocks = Window.orderBy("task"), Window.partitionBy("task").orderBy("block")
    tasks = tasks.select("task", _before("task_n", over_tasks).alias("n_0"), _before("task_bytes", over_tasks).alias("bytes_0"))
    return totals.join(tasks, "task").select(
        "block",
        "bytes",
        (F.col("n_0") + _before("n", over_blocks)).alias("rows_before"),
        (F.col("bytes_0") + _before("bytes", over_blocks)).alias("bytes_before"),
    )


def _target(twice_middle: Column, n_shards: int, total: int) -> Column:
    """The shard of twice a place in bytes; in decimals, since the product can pass 64 bits."""
    wide = "decimal(38,0)"
    return F.call_function("div", twice_middle.cast(wide) * F.lit(n_shards), F.lit(2 * total).cast(wide)).cast("int")


def _numbered(placed: DataFrame, n_shards: int) -> DataFrame:
    """Adds shard and slot to stored rows that have ``at`` and ``size``."""
    if n_shards < 1:
        raise ValueError(f"{n_shards} shards")
    blocks = stored(_blocks(placed), "shard-prefixes")
    total = blocks.agg(F.sum("bytes")).first()[0] or 1
    lowest = _target(F.col("bytes_before") * 2, n_shards, total)
    highest = _target((F.col("bytes_before") + F.col("bytes")) * 2, n_shards, total)
    blocks = blocks.withColumns({"shard": lowest, "cut": lowest != highest})
    block = F.shiftright("at", BLOCK_BITS).alias("block")

    inside = placed.select("at", "size", block).join(blocks.where("cut").select("block", "bytes_before"), "block")
    start = F.col("bytes_before") + _before("size", Window.partitionBy("block").orderBy("at"))
    inside = inside.select("block", "at", _target(start * 2 + F.col("size"), n_shards, total).alias("shard"))
    firsts = inside.groupBy("block", "shard").agg(F.min("at").alias("first_at"))
    firsts = firsts.union(blocks.where(~F.col("cut")).select("block", "shard", F.shiftleft("block", BLOCK_BITS)))
    firsts = firsts.join(blocks.select("block", "rows_before"), "block")
    firsts = stored(firsts.withColumn("index", F.col("rows_before") + F.col("first_at").bitwiseAND((1 << BLOCK_BITS) - 1)), "shard-firsts")
    bases = firsts.groupBy("shard").agg(F.min("index").alias("base"))
    parts = firsts.join(bases, "shard").groupBy("block").agg(
        F.max("rows_before").alias("rows_before"), F.sort_array(F.collect_list(F.struct("first_at", "shard", "base"))).alias("parts")
    )
    # The last of the block's shards that begins at the row or in front of it.
    joined = placed.withColumn("block", block).join(parts, "block")
    joined = joined.withColumn("part", F.element_at(F.filter("parts", lambda part: part["first_at"] <= F.col("at")), -1))
    index = F.col("rows_before") + F.col("at").bitwiseAND((1 << BLOCK_BITS) - 1)
    return joined.select("row", "size", "crc", F.col("part.shard").alias("shard"), (index - F.col("part.base")).alias("slot"))


def shard_places(docs: DataFrame, n_shards: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, without its text: doc_id, size, text_crc32, shard, slot."""
    # Stored before it is sorted: the sort samples its input, which would scan the texts twice.
    rows = stored(_rows(docs, F.struct(F.col(doc_id).alias("id")), doc_id, text), "shard-rows")
    out = _numbered(_placed(rows), n_shards)
    return out.select(F.col("row.id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def shard_documents(docs: DataFrame, n_shards: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The whole documents, with two more columns, ``shard`` and ``slot`` (columns of these names are replaced)."""
    out = _numbered(_placed(_rows(docs, F.struct("*"), doc_id, text)), n_shards)
    names = [name for name in docs.columns if name.lower() not in ("shard", "slot")]
    return out.select(*[F.col(f"row.`{name}`").alias(name) for name in names], "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int, *, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write one folder ``shard=k`` for each shard that has documents; files are in order of slots."""
    placed = shard_documents(docs, n_shards, doc_id=doc_id, text=text)
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
