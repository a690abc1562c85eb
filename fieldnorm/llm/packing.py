"""Packing of tokenized documents into sequences: bounded-space online best-fit.

A document's ids are its text's tokens and one end id. Documents longer than a sequence are
cut into full pieces; the first piece may be shorter. Shorter pieces arrive in an order given
by a hash. Each goes to the open sequence with the least free space that still holds it; if
none does, a new one is opened, and where ``OPEN`` are open already the fullest closes first.

Defined cases: a null text is empty (one end id); repeated documents are packed each; an
empty table gives an empty result; doc_id may be null.

Scale: texts are tokenized where they are read; only narrow rows of pieces (no ids) move.
They are dealt by a hash of their content to tasks of about ``PER_TASK`` documents, and a task
holds nothing but its open sequences. What a task's last open sequences leave free is the
price of packing in parallel.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.words import slices, tidy

OPEN = 512
PER_TASK = 100_000
#: Pattern of byte-level BPE with ``use_regex``, a fixed value of the file format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as the pattern has it (the Unicode property), a fixed value, in runs the pattern is spared.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def _byte_letters() -> dict[str, int]:
    """The letters by which the file format writes bytes: printable ones stand for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + k): byte for k, byte in enumerate(others)}


def _merged_by_rank(file: dict) -> bool:
    """Whether the file is byte-level BPE whose ids are the order of its merges, with nothing around it."""
    model, before = file["model"], file["pre_tokenizer"] or {}
    if model["type"] != "BPE" or file["normalizer"] or before.get("type") != "ByteLevel":
        return False
    if before["add_prefix_space"] or not before["use_regex"] or model.get("ignore_merges") or model.get("dropout"):
        return False
    if any(token[flag] for token in file["added_tokens"] for flag in ("lstrip", "rstrip", "single_word", "normalized")):
        return False
    pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    return [model["vocab"]["".join(pair)] for pair in pairs] == list(range(256, len(model["vocab"])))


@functools.cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """Encodes a text as ``tokenizers`` does with the file, without adding special tokens.

    A byte-level BPE file whose ids are the order of its merges is run by ``tiktoken``, which
    gives the same ids four times as fast; any other file by ``tokenizers`` itself.

    The pattern steps back through white space, on a stack that a million blanks overflow. Long
    runs are therefore taken out first: what stands in front of a run ends there by the pattern
    as well, the run is one piece but for its last character, which belongs to what follows,
    and at the end of the text it is one piece. Texts with long runs and names of special
    tokens, at which pieces end too, are left to ``tokenizers``.
    """
    file = json.loads(Path(path).read_text(encoding="utf-8"))

    @functools.cache
    def tokenizer():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def plainly(text: str) -> list[int]:
        return tokenizer().encode(text, add_special_tokens=False).ids

    if not _merged_by_rank(file):
        return plainly
    import tiktoken

    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): n for token, n in file["model"]["vocab"].items()}
    special = {token["content"]: token["id"] for token in file["added_tokens"]}
    coder = tiktoken.Encoding(Path(path).name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    one_piece = tiktoken.Encoding(f"{Path(path).name} unsplit", pat_str=r"(?s:.)+", mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        named, ids, at = any(name in text for name in special), [], 0
        for run in BLANKS.finditer(text):
            if named:
                return plainly(text)
            a, b = run.span()
            b -= b < len(text)
            ids += coder.encode_ordinary(text[at:a])
            ids += one_piece.encode_ordinary(text[a:b])
            at = b
        if named:
            return coder.encode(text, allowed_special="all")
        return ids + coder.encode_ordinary(text[at:]) if at else coder.encode_ordinary(text)

    return encode


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids)."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("piece", T.IntegerType()),
            *[T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32")],
            *[T.StructField("ids", T.ArrayType(T.IntegerType()))][: int(with_ids)],
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple] = []
                for row, text in enumerate(part.column("text").to_pylist()):
                    raw = np.array(encode(text or ""), "<u4").tobytes() + end
                    n = len(raw) // 4
                    start, stop, piece = 0, (n - 1) % capacity + 1, 0
                    while start < n:
                        own = raw[4 * start : 4 * stop]
                        rows.append((row, piece, start, stop - start, zlib.crc32(own), own))
                        start, stop, piece = stop, stop + capacity, piece + 1
                of, pieces, starts, lengths, crcs, own = zip(*rows, strict=True)
                columns = [
                    part.column("doc_id").take(pa.array(of)),
                    pa.array(pieces, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs)],
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<i4") for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(tidy(scan), schema)


class BestFit:
    """Open sequences in a bitset keyed by free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits, self.open, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        own = self.by_free[free]
        sequence = own.pop()
        if not own:
            self.bits ^= 1 << free
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the offset in it for a piece of this length."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
        return sequence, self.capacity - free


def pack(pieces: DataFrame, tasks: int, *, capacity: int = 1024, open_sequences: int = OPEN) -> DataFrame:
    """Adds sequence_id and offset to the rows of ``token_pieces``."""
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, base = BestFit(capacity, open_sequences), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [best.place(length) for length in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=schema.names,
            )

    # The same rows come to a task in the same order again if it is repeated.
    dealt = F.xxhash64("doc_id", "piece", "length", "ids_crc32")
    ordered = pieces.repartition(tasks, dealt).sortWithinPartitions(F.xxhash64(dealt), "doc_id", "piece", "start", "length", "ids_crc32")
    return ordered.mapInArrow(tidy(place), schema)


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pack all documents; one row per piece with its place."""
    tasks = max(1, -(-docs.count() // PER_TASK))
    return pack(token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, with_ids=with_ids), tasks, capacity=capacity)
