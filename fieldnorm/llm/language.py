"""Language identification: nearest of several centroids per language, by cosine.

A text is a vector of hashed n-grams of one to three bytes (A-Z and Latin-1 capitals
lower-cased, other ASCII characters as blanks), weighted by log(1 + count) and inverse
document frequency, of length 1. Spherical k-means gives each language up to ``CENTROIDS``
centroids. A text takes the language of the nearest one; it is ``rejected`` when it lies
farther off than nearly all (``WITHIN``) training texts of that centroid.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text
if nothing can be learned from. Rows without ``lang`` are predicted, not learned from. Ties
go to the language first in order. Repeated rows are predicted each.

Scale: learning reads all labelled rows and keeps, by a hash of id and text, at most ``SAMPLE`` texts
of each language (a documented bound; whole texts), so the model's size depends on the number
of languages only. Prediction is one narrow pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.storage import stored
from fieldnorm.llm.words import mixed, slices, text_bytes, tidy

FEATURES = 4096
SAMPLE = 400
CENTROIDS = 4
WITHIN = 0.995
ROUNDS = 10
_ROWS = 500
_TASKS = 16

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = re.compile("[A-Za-z]")


def counts_of(texts: pa.Array) -> np.ndarray:
    """Counts of hashed n-grams, a row for each text."""
    raw, row = text_bytes(texts)
    data = _LETTER[raw]
    capital = (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)
    data[1:][capital] += 0x20
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(row))
    out = np.zeros(len(texts) * FEATURES, np.float32)
    code = np.zeros(len(data), np.uint64)
    for n in range(1, 4):
        if len(data) < n:
            break
        code = code[: len(data) - n + 1] * np.uint64(256) + data[n - 1 :]
        inside = (owner[: len(code)] == owner[n - 1 :]) & (data[: len(code)] != 0x20)
        if n > 1:
            inside &= data[1 : len(code) + 1] != 0x20
        place = (mixed(code[inside] * np.uint64(4) + np.uint64(n)) % np.uint64(FEATURES)).astype(np.int64)
        out += np.bincount(owner[: len(code)][inside] * FEATURES + place, minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), FEATURES)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def clustered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of rows of length 1, and the distance within which nearly all of a centroid's rows lie."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < min(CENTROIDS, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centers = x[chosen]
    for _ in range(ROUNDS):
        of = np.argmax(x @ centers.T, axis=1)
        centers = _unit(np.stack([x[of == k].sum(axis=0) if (of == k).any() else centers[k] for k in range(len(centers))]))
    near = x @ centers.T
    of = np.argmax(near, axis=1)
    far = [float(np.quantile(1 - near[of == k, k], WITHIN)) if (of == k).any() else 0.0 for k in range(len(centers))]
    return centers, np.array(far)


@dataclass
class LanguageModel:
    langs: list[str]  # of each centroid
    centers: np.ndarray
    far: np.ndarray
    idf: np.ndarray

    def predict(self, texts: pa.Array) -> list[tuple[str, float, bool]]:
        out = []
        for at in range(0, len(texts), _ROWS):
            own = texts.slice(at, _ROWS)
            if self.langs:
                near = weighted(counts_of(own), self.idf) @ self.centers.T
                best = np.argmax(near, axis=1)
                score = np.clip(near[np.arange(len(best)), best], 0, 1)
            for row, text in enumerate(own.to_pylist()):
                if self.langs and text and (_ASCII_LETTER.search(text) or any(map(str.isalpha, text))):
                    k = best[row]
                    out.append((self.langs[k], float(score[row]), bool(1 - score[row] > self.far[k])))
                else:
                    out.append(("und", 0.0, True))
        return out


def learn(labelled: DataFrame) -> LanguageModel:
    """Learn from columns doc_id, text and lang; rows with a null text or lang don't count."""
    labelled = labelled.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = {row.lang: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel([], np.zeros((0, FEATURES)), np.zeros(0), np.zeros(FEATURES))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, SAMPLE / n))])
    # By a hash of id and text, so that rows of one id, or of none, aren't chosen together; rows that
    # repeat count once. Twice the share first, then a rank: no language has more than SAMPLE.
    drawn = labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    drawn = drawn.where(F.pmod("h", F.lit(1 << 20)) < F.lit(2 << 20) * share[F.col("lang")]).dropDuplicates(["lang", "h"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = drawn.withColumn("rank", rank).where(F.col("rank") <= SAMPLE).drop("rank", "h")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for at in range(0, part.num_rows, _ROWS):
                    own = part.slice(at, _ROWS)
                    rows = [row.tobytes() for row in counts_of(own.column("text"))]
                    yield pa.RecordBatch.from_arrays([own.column("lang"), pa.array(rows, pa.binary())], names=["lang", "counts"])

    sample = stored(chosen.mapInArrow(tidy(vectors), "lang string, counts binary").repartition(_TASKS), "languages")

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                df += np.frombuffer(raw, np.float32) > 0
                n += 1
        yield pa.RecordBatch.from_pylist([{"df": df.tobytes(), "n": n}])

    parts = sample.mapInArrow(tidy(seen), "df binary, n long").collect()
    n = sum(row.n for row in parts)
    idf = (np.log((1 + n) / (1 + sum(np.frombuffer(row.df, np.int64) for row in parts))) + 1).astype(np.float32)

    def centroids(table: pa.Table) -> pa.Table:
        x = weighted(np.stack([np.frombuffer(raw, np.float32) for raw in sorted(table.column("counts").to_pylist())]), idf)
        centers, far = clustered(x)
        lang = table.column("lang")[0].as_py()
        return pa.Table.from_pylist([{"lang": lang, "k": k, "center": c.astype(np.float32).tobytes(), "far": float(f)} for k, (c, f) in enumerate(zip(centers, far, strict=True))])

    rows = sample.groupBy("lang").applyInArrow(centroids, "lang string, k long, center binary, far double").collect()
    rows.sort(key=lambda row: (row.lang, row.k))
    centers = np.stack([np.frombuffer(row.center, np.float32) for row in rows])
    return LanguageModel([row.lang for row in rows], centers, np.array([row.far for row in rows]), idf)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, rejected = zip(*shared.value.predict(part.column("text")), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang), pa.array(score, pa.float64()), pa.array(rejected)], names=schema.names
                )

    return docs.select("doc_id", "text").mapInArrow(tidy(scan), schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
