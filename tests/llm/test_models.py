"""Language identification, language model, HTML extraction, licenses and packing."""

import html
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from brute import LOWER, sign_words, space_words  # noqa: E402

from fieldnorm.llm import language_model as lm  # noqa: E402
from fieldnorm.llm import licenses, main_text  # noqa: E402
from fieldnorm.llm.dom import blocks_of  # noqa: E402
from fieldnorm.llm.language import fold, identify, learn  # noqa: E402
from fieldnorm.llm.packing import BestFit, encoder, pack_documents, token_pieces  # noqa: E402

DATA = "/root/testdata/sf0.01"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, texts without words or letters, repeated rows, an extra column with a clashing name."""
    rows = [(1, None, "en", 0), (None, "", None, 0), (2, " \n", "en", 0), (3, "12 %", "de", 0), (None, "Wort und Satz", None, None)]
    return spark.createDataFrame([*rows, rows[3], rows[3]], "doc_id long, text string, lang string, row int")


def test_languages_held_out(documents):
    held_out = fold(F.col("doc_id"), 4) == 2
    found = identify(documents.where(held_out), learn(documents.where(~held_out))).join(documents, "doc_id")
    right, low, high = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right > 0.97 and low >= 0 and high <= 1
    assert {row.lang_pred for row in found.collect()} == {"de", "en", "es", "fr"}


def test_foreign_text_is_rejected(spark, documents):
    model = learn(documents)
    strange = spark.createDataFrame([(1, "これは日本語の文章です。" * 20), (2, "qqzx xzzq wqx " * 30)], "doc_id long, text string")
    assert all(row.rejected for row in identify(strange, model).collect())
    assert identify(documents, model).where("rejected").count() < 0.1 * documents.count()


def test_languages_odd_rows(odd):
    for model in (learn(odd), learn(odd.limit(0))):
        found = identify(odd, model).collect()
        assert len(found) == 7
        assert {row.lang_pred for row in found if row.doc_id is not None} == {"und"}
    assert learn(odd.limit(0)).langs == []


def brute_model(rows, arcs):
    """Base and backoff scores by the definition, and the counts."""
    ones, twos, threes, starts = Counter(), Counter(), Counter(), 0
    for _, text, held_out in rows:
        if not held_out:
            tokens = ["<", *space_words((text or "").translate(LOWER)), None]
            starts += 1
            ones.update(tokens[1:])
            twos.update(zip(tokens, tokens[1:]))
            threes.update(zip(tokens, tokens[1:], tokens[2:]))
    total = ones.total()
    whole, least = total + 0.5 * (len(ones) + 1), max(2, total / arcs)
    twos, threes = ({k: n for k, n in own.items() if n >= least} for own in (twos, threes))
    after = defaultdict(list)
    for own in (*twos, *threes):
        after[own[:-1]].append(own[-1])

    def one(w):
        return (ones[w] + 0.5) / whole

    def two(a, w):
        return (twos[a, w] - 0.5) / (starts if a == "<" else ones[a]) if (a, w) in twos else back((a,)) * one(w)

    def three(a, b, w):
        return (threes[a, b, w] - 0.5) / twos[a, b] if (a, b, w) in threes else back((a, b)) * two(b, w)

    @cache
    def back(context):
        own = after.get(context, [])
        if len(context) == 1:
            return (1 - sum(two(*context, w) for w in own)) / (1 - sum(map(one, own))) if own else 1
        return (1 - sum(three(*context, w) for w in own)) / (1 - sum(two(context[1], w) for w in own)) if own else 1

    for (a,) in [key for key in after if len(key) == 1][:5]:
        assert sum(two(a, w) for w in ones) + back((a,)) * 0.5 / whole == pytest.approx(1)
    out = []
    for doc_id, text, _ in rows:
        tokens = ["<", *space_words((text or "").translate(LOWER)), None]
        score = math.log10(two(*tokens[:2])) + sum(math.log10(three(*x)) for x in zip(tokens, tokens[1:], tokens[2:]))
        base = sum(math.log10(one(w)) for w in tokens[1:])
        out.append((doc_id, len(tokens) - 1, sum(ones[w] > 0 for w in tokens[1:]), total, base, score))
    return out


@pytest.mark.parametrize("words, arcs", [(1 << 20, 1 << 18), (3000, 2000)])
def test_language_model(documents, monkeypatch, words, arcs):
    monkeypatch.setattr(lm, "WORDS", words)
    monkeypatch.setattr(lm, "ARCS", arcs)
    held_out = fold(F.col("doc_id"), 5) == 1
    rows = [tuple(row) for row in documents.select("doc_id", "text", held_out).collect()]
    found = {row.doc_id: row for row in lm.score_texts(documents, held_out).collect()}
    base = score = 0
    for doc_id, *counts, base_score, full_score in brute_model(rows, arcs):
        row = found[doc_id]
        assert [row.n_tokens, row.n_known, row.train_tokens] == counts
        assert row.base_score == pytest.approx(base_score, rel=1e-9)
        assert row.score == pytest.approx(full_score, rel=1e-9)
        if row.held_out:
            base, score = base + base_score, score + full_score
    assert score > base


def test_language_model_odd_rows(odd):
    found = lm.score_texts(odd, F.lit(False)).collect()
    assert sorted(row.n_tokens for row in found) == [1, 1, 1, 3, 3, 3, 4]
    assert all(row.n_known == row.n_tokens and row.score < 0 for row in found)
    nothing = lm.score_texts(odd, F.lit(True)).collect()
    assert len(nothing) == 7 and all(row.n_known == row.train_tokens == 0 for row in nothing)
    assert lm.score_texts(odd.limit(0), F.lit(False)).isEmpty()


def article_of(page):
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    inner = re.sub("</?b>", "", re.sub("<(?:/?(?:p|h1)|br)>", "\n", inner))
    return " ".join(html.unescape(inner).split())


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{DATA}/pages.parquet")


def test_articles_of_the_given_pages(pages):
    found = {row.page_id: row.text for row in main_text.extract(pages, main_text.learn(pages)).collect()}
    expected = {row.page_id: article_of(row.html) for row in pages.collect()}
    assert sum(found[k] == text for k, text in expected.items()) >= 0.99 * len(expected)


def test_composed_pages_held_out(pages):
    field = main_text.learn(pages.limit(0))
    right = total = 0
    for blocks, labels in main_text.sample_pages(150, seed=99):
        decoded = field.decode(main_text.features_of(blocks))
        right, total = right + sum(a == b for a, b in zip(decoded, labels)), total + len(labels)
    assert right > 0.97 * total


def test_pages_that_are_odd(spark, pages):
    rows = [(1, "u", None, 1), (2, None, "", 2), (None, "u", "<p", None), (3, "u", "<b>unclosed <i>text &amp; more &#8211; end", 3)]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, text int")
    found = main_text.extract(df, main_text.learn(df)).collect()
    assert len(found) == 5 and all(row.text == "" for row in found if row.page_id in (1, 2))
    assert main_text.extract(df.limit(0), main_text.learn(df.limit(0))).isEmpty()


def test_blocks():
    page = """<!-- <p>no</p> --><script>var t="</p><p>no";</script><div class='Side-Bar x'>A <b>b&nbsp;c</b>d<p>e<p>f<br>g
      <ul><li>h<li>i <a href="?a>b">j</a></ul></div><style>p{}</style>k < l &lt;m&gt;<p hidden>n"""
    blocks = blocks_of(page)
    assert [block.text for block in blocks] == ["A b cd", "e", "f g", "h", "i j", "k < l <m>", "n"]
    assert {"is:side", "is:bar", "in:ul"} <= {*blocks[3].context} and "hidden" in blocks[6].context
    assert 0 < blocks[4].linked < 1 and "in:div" not in blocks[5].context


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute_base(text):
    words, starts, labels = sign_words(text), [], set()
    for phrase, label in PHRASES.items():
        own = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(own)] == own:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base(spark, documents):
    extra = ["CC BY cc-by CC\nBY 4.0", None, "", "all rights reserved all rights reserved", "The GNU General Public License; cc by"]
    df = documents.select("doc_id", "text").union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(extra)], "doc_id long, text string"))
    texts = {row.doc_id: row.text for row in df.collect()}
    for row in licenses.license_scan(df).collect():
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute_base(texts[row.doc_id])
        assert {*row.base_labels.split(",")} - {""} <= {*row.labels.split(",")} and 0 <= row.score <= 1
        assert bool(row.score) == bool(row.labels)


@pytest.mark.parametrize(
    "text, labels",
    [
        ("licensed under the apache license version 2 0", "apache-2.0"),
        ("this work is under cc by nc sa 4 0", "cc-by-nc-sa-4.0"),
        ("spdx license identifier mpl 2 0", "mpl"),
        ("released under the gnu lesser general public license version 2 1", "gpl,lgpl-2.1"),
        ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
        ("mit freundlichen grüßen", ""),
    ],
)
def test_license_rules(text, labels):
    found = {*licenses.scan_text(text)[4].split(",")}
    assert {*labels.split(",")} - {"gpl"} <= found


def test_license_rules_and_gate_agree():
    assert len(licenses.rules()) > 200
    scan = re.compile("|".join(f"(?:{rule.pattern.pattern})" for rule in licenses.rules()))
    for phrase in ("apache license version 2 0", "cc by sa 3 0", "gplv3", "bsd 3 clause license", "creativecommons org licenses by nd 4 0"):
        assert bool(scan.search(phrase)) == bool(licenses.scan_text(phrase)[4])


def test_encoder_gives_the_tokenizer_s_ids():
    tokenizer, encode, r = Tokenizer.from_file(BPE), encoder(BPE), random.Random(4)
    letters = "ab é.\n\t'sA1²\x1c\x85　Ⅷ!?ll  -日\U0001f600"
    texts = ["".join(r.choices(letters, k=r.randrange(50))) for _ in range(3000)] + ["a<|endoftext|> b", "", "we'll  go\n\n\nx "]
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_of_another_file():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert encoder(path)("some words") == Tokenizer.from_file(path).encode("some words", add_special_tokens=False).ids


def test_packing_round_trip(documents, odd):
    docs = documents.where("doc_id > 10").select("doc_id", "text").union(odd.select("doc_id", "text"))
    tokenizer = Tokenizer.from_file(BPE)
    expected = Counter()
    for row in docs.collect():
        expected[row.doc_id, *tokenizer.encode(row.text or "", add_special_tokens=False).ids, 2] += 1
    pieces = pack_documents(docs, BPE, with_ids=True).collect()
    by_sequence, joined = defaultdict(list), defaultdict(list)
    for row in pieces:
        assert row.length == len(row.ids) <= 1024
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        by_sequence[row.sequence_id].append((row.offset, row.length))
        joined[row.doc_id].append(row)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    found = Counter()
    for doc_id, own in joined.items():
        own.sort(key=lambda row: (row.piece, row.ids))
        if len({row.piece for row in own}) == len(own):
            assert [row.start for row in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
            assert all(row.length == 1024 for row in own[1:])
            found[doc_id, *[x for row in own for x in row.ids]] += 1
        else:  # rows that share a doc_id are short here
            found.update((doc_id, *row.ids) for row in own)
    assert found == expected
    assert len(by_sequence) < 1.03 * sum(row.length for row in pieces) / 1024


def test_packing_of_nothing(odd):
    assert pack_documents(odd.limit(0), BPE).isEmpty()
    assert token_pieces(odd, BPE).where("doc_id = 1").collect()[0].length == 1


def test_fullest_closes_first():
    best = BestFit(10, 2)
    assert [best.place(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert best.place(3) == (1, 7)  # fills the fuller one, which is closed by that
    assert best.place(8) == (2, 0)
    assert best.place(5) == (3, 0)  # neither fits: sequence 2 is the fullest and closes
    assert best.place(2) == (0, 6) and best.place(5) == (3, 5)
