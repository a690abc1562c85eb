"""Quality rules in DataFrame functions: text measures and cross-document line frequency.

A line's key is a 60-bit hash of its words, lower-cased, joined by one space. For each host
(column ``source``) the distinct documents that hold a key are counted; documents with equal
texts are one. A line is above the limit when more than ``max_docs`` hold it, a fixed number at
every size of host. Below that number a line goes by its contexts, that is, how many different
least other lines its documents have: when these exceed ``MIN_CONTEXTS`` and ``MAX_SHARE`` of
the host's documents and are at least half of the documents that hold it. So a notice on a few
pages goes too, while near copies of one text mostly share their least line. Such lines are removed from all documents of the host. A document is
depleted, and rejected, when fewer than ``min_words`` of its words are left and at least half
of them were removed.

Exact copies are never taken for boilerplate, whatever their number. Near copies are: of a
family of more than ``max_docs`` different versions of one text on one host the common lines
go, as menus do, since the two cannot be told apart by the frequency of lines.

Defined cases: a null text is empty, has no words and fails; null hosts form one host; lines
without words are neither counted nor removed; repeated rows (same id, text and host) get the
same verdict and count once; in the contexts they count as documents; rows of one id and text on
several hosts are judged on each by its own; an empty table gives an empty result; columns may have any names.

Scale: one scan takes measures and line keys and stores them without the text. From that
table distinct (host, key, text) are made by a map-side combined grouping, so that a hot line
is spread by its texts, and then counted, with their contexts. Lines above the limit come back by an ordinary join
on (host, key), which Spark turns into a broadcast only below its own size threshold and
splits when skewed. Only ``apply_quality_rules``, which returns texts, scans them once more.
Windows of one document stay in that document's row: nothing is exploded by words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnorm.llm.storage import stored

MAX_DOCS = 30
MIN_CONTEXTS = 10
MAX_SHARE = 0.01
SPACES = "\t\n\x0b\f\r "
_SPACE_RUN = r"[\x20\x09-\x0D]+"
_SPACE_RUN_IN_LINE = r"[\x20\x09\x0B-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def _words(trimmed: Column) -> Column:
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE_RUN))


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Two windows of three words are taken to be equal when their 64-bit hashes are.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns(
        {
            "__words": _words(_trimmed(whole)),
            "__lines": F.filter(F.split(whole, "\n"), lambda line: _trimmed(line) != ""),
            "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, _SYMBOLS, ""))).cast("long"),
        }
    )
    n = F.size("__words")
    hashed = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)).alias("h"), i.alias("i")),
    )
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__sorted": F.sort_array(hashed),
        }
    ).drop("__words", "__lines")
    repeated = F.filter(
        "__sorted",
        lambda x, k: (F.get("__sorted", k + 1)["h"] == x["h"]) | ((k > 0) & (F.get("__sorted", k - 1)["h"] == x["h"])),
    )
    out = out.withColumn("__at", F.sort_array(F.transform(repeated, lambda x: x["i"]))).drop("__sorted")
    # A window covers three words, or those up to the next window if that starts earlier.
    covered = F.aggregate(
        "__at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(F.lit(3), at - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    out = out.withColumn("n_repeat_words", covered).drop("__at")
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def _line_keys(text: Column) -> Column:
    """For each line with a word: its place, its key and its number of words."""
    normal = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE_RUN_IN_LINE, " "))
    return F.transform(
        F.filter(
            F.transform(F.split(normal, "\n"), lambda line, at: F.struct(at.alias("at"), F.btrim(line).alias("words"))),
            lambda x: x["words"] != "",
        ),
        lambda x: F.struct(
            x["at"].alias("at"),
            F.conv(F.substring(F.md5(x["words"]), 1, 15), 16, 10).cast("long").alias("key"),
            (F.length(x["words"]) - F.length(F.replace(x["words"], F.lit(" "), F.lit(""))) + 1).alias("n"),
        ),
    )


def pages(docs: DataFrame, *more: Column) -> DataFrame:
    """Without the texts: doc_id, text_hash, host, lines (place, key and words of each) and ``more``."""
    host = F.coalesce(F.col("source"), F.lit("")).alias("host")
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), host, _line_keys(F.col("text")).alias("lines"), *more)


def lines_above_limit(pages: DataFrame, *, max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per host and line above the limit: host, key, n_docs (different texts)."""
    keys = F.array_distinct("lines.key")
    lines = pages.select("host", "text_hash", F.slice(F.sort_array(keys), 1, 2).alias("least"), F.explode(keys).alias("key"))
    first, second = F.get("least", F.lit(0)), F.get("least", F.lit(1))
    # No key is negative; -1 is the context of a page with one line.
    other = F.coalesce(F.when(first == F.col("key"), second).otherwise(first), F.lit(-1))
    held = lines.groupBy("host", "key", "text_hash").agg(F.count("*").alias("n"), F.min(other).alias("other"))
    counts = held.groupBy("host", "key").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_rows"), F.count_distinct("other").alias("n_contexts")
    )
    varied = (F.col("n_contexts") > MIN_CONTEXTS) & (F.col("n_contexts") * 2 >= F.col("n_rows"))
    sizes = pages.groupBy("host").agg(F.count("*").alias("host_docs"))
    above = counts.where((F.col("n_docs") > max_docs) | varied).join(sizes, "host")
    above = above.where((F.col("n_docs") > max_docs) | (F.col("n_contexts") > F.col("host_docs") * MAX_SHARE))
    return above.select("host", "key", "n_docs")


def removed_lines(pages: DataFrame, *, max_docs: int = MAX_DOCS) -> DataFrame:
    """Documents with lines above the limit: of, of_hash, of_host, removed (places and words of these lines)."""
    above = lines_above_limit(pages, max_docs=max_docs).select("host", "key")
    lines = pages.select("doc_id", "text_hash", "host", F.explode("lines").alias("line")).select("doc_id", "text_hash", "host", "line.*")
    # A set, since rows that repeat bring the same lines again.
    found = lines.join(above, ["host", "key"]).groupBy("doc_id", "text_hash", "host").agg(F.collect_set(F.struct("at", "n")).alias("removed"))
    return found.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), F.col("host").alias("of_host"), "removed")


def _removed_words(removed: Column) -> Column:
    return F.coalesce(F.aggregate(removed, F.lit(0).cast("long"), lambda total, x: total + x["n"]), F.lit(0).cast("long"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def quality_rules(docs: DataFrame, *, min_words: int = 50, max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per document: doc_id, the measures, n_removed_words, base_failed, kept."""
    measured = with_measures(docs.select("doc_id", "text", "source"))
    found = stored(pages(measured, *map(F.col, MEASURES)), "quality-pages")
    removed = removed_lines(found, max_docs=max_docs)
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")) & (F.col("host") == F.col("of_host"))
    joined = found.drop("lines").join(removed, same, "left").withColumn("n_removed_words", _removed_words(F.col("removed")))
    kept = ~F.col("base_failed") & ~depleted(F.col("n_words"), F.col("n_removed_words"), min_words)
    return joined.select("doc_id", *MEASURES[:-1], "n_removed_words", "base_failed", kept.alias("kept"))


def depleted(n_words: Column, n_removed: Column, min_words: int) -> Column:
    return (n_words - n_removed < min_words) & (n_removed * 2 >= n_words)


def apply_quality_rules(docs: DataFrame, *, min_words: int = 50, max_docs: int = MAX_DOCS) -> DataFrame:
    """The documents that are kept, without the lines above the limit; all columns stay."""
    found = stored(pages(with_measures(docs.select("doc_id", "text", "source")), F.col("n_words"), F.col("base_failed")), "quality-pages")
    lines = removed_lines(found, max_docs=max_docs).withColumn("gone", _removed_words(F.col("removed")))
    # One row for each (id, text, host), whose verdict all rows that repeat it share.
    judged = found.groupBy("doc_id", "text_hash", "host").agg(F.max("n_words").alias("n_words"), F.max("base_failed").alias("base_failed"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")) & (F.col("host") == F.col("of_host"))
    judged = judged.join(lines, same, "left").where(~F.col("base_failed"))
    judged = judged.where(~depleted(F.col("n_words"), F.coalesce("gone", F.lit(0)), min_words)).select(
        F.struct(F.col("doc_id").alias("id"), "text_hash", "host").alias("verdict_of"), "removed"
    )
    # The rows are kept in a struct of their own, so that no column of the input can clash.
    rows = docs.select(F.struct("*").alias("row"))
    host = F.coalesce("row.source", F.lit(""))
    same = F.col("row.doc_id").eqNullSafe(F.col("verdict_of.id")) & (F.xxhash64("row.text") == F.col("verdict_of.text_hash")) & (host == F.col("verdict_of.host"))
    out = rows.join(judged, same)
    lines_of = F.split("row.text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines_of) - 1), F.transform("removed", lambda x: x["at"]))
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(stay, lambda at: F.get(lines_of, at)), "\n")
    )
    return out.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
