"""Main text of HTML pages: a linear-chain conditional random field over leaf blocks.

Each leaf block of a page is main text or not. A block's features are its ancestors (names,
words of class, id and role) and its text (length, share of links, punctuation, telling
words); neighbouring labels are linked. The weights are trained by gradient steps on the
exact log-likelihood (forward-backward) of labelled pages, and a page is decoded by Viterbi.

Labelled pages are of two kinds. ``sample_pages`` composes pages from parts whose label is
known: menus, notices, adverts, forms, comments and so on around and inside an article. And
of the given pages, at most ``SAMPLE`` chosen by a hash (the documented bound) that mark
their article themselves, have at most ``LONGEST`` characters and at most ``DEEPEST`` elements
open at once (that bounds what the driver holds; they are extracted like all others). In a part of the pages the telling marks are hidden while training,
so that the text features count as well.

Defined cases: a null or empty page, or one without main text, gives an empty text; rows that
repeat are extracted each; an empty table gives an empty result (the model then rests on the
composed pages). Text is never cut. Of equally probable labellings a last
block is left out and a block before it is kept. Very long pages, also of tags that are never closed or
have no end, take time and memory in proportion to their length.

Scale: pages are labelled where they are read, one narrow pass; learning looks at a bounded
number of pages.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.dom import Block, blocks_of
from fieldnorm.llm.words import slices, tidy

SAMPLE = 150
LONGEST, DEEPEST = 200_000, 200
COMPOSED = 260
STEPS = 150
_RATE, _PULL = 0.15, 0.002
_HIDE = 0.35

#: Words that tell something about a block.
TELLING = {
    "cookie": r"\bcookies?\b|\bconsent\b|\bgdpr\b|\bprivacy\b|\bdatenschutz\b|confidentialité|privacidad",
    "rights": r"©|\(c\)|\bcopyright\b|all rights reserved|alle rechte|tous droits|derechos reservados",
    "join": r"\bsubscribe\b|\bnewsletter\b|\bsign (?:up|in)\b|\blog ?in\b|\bregister\b|abonn|anmelden|suscr",
    "share": r"\bshare\b|\btweet\b|\bfacebook\b|\btwitter\b|teilen|partager|compartir",
    "reply": r"\breply\b|\bcomments?\b|antworten|kommentar|répondre|commentaire|responder|comentario",
    "more": r"\bread more\b|\brelated\b|\bmore from\b|\btrending\b|mehr lesen|lire la suite|leer más",
    "advert": r"\badvert|\bsponsored\b|\bpromo|anzeige|publicité|publicidad",
    "home": r"^(?:home|about|contact|menu|search|next|previous|back|top)\b",
}
#: Of each pattern, the words of which every match holds one (tested); looking for them is much faster.
GATES = {
    "cookie": "cookie consent gdpr privacy datenschutz confidentialité privacidad".split(),
    "rights": ["©", "(c)", "copyright", "all rights reserved", "alle rechte", "tous droits", "derechos reservados"],
    "join": ["subscribe", "newsletter", "sign up", "sign in", "log in", "login", "register", "abonn", "anmelden", "suscr"],
    "share": "share tweet facebook twitter teilen partager compartir".split(),
    "reply": "reply comment antworten kommentar répondre responder comentario".split(),
    "more": ["read more", "related", "more from", "trending", "mehr lesen", "lire la suite", "leer más"],
    "advert": "advert sponsored promo anzeige publicité publicidad".split(),
    "home": "home about contact menu search next previous back top".split(),
}
_TELLING = {name: (GATES[name], re.compile(pattern)) for name, pattern in TELLING.items()}
_MARKED = ("in:article", "in:main")
_NOT_MAIN = frozenset("in:nav in:aside in:footer in:form is:comment is:comments is:ad is:ads is:advert is:share is:related hidden".split())


def telling(text: str) -> list[str]:
    """Features of the telling words in a lower-cased text."""
    out = []
    for name, (words, pattern) in _TELLING.items():
        for word in words:
            if word in text:
                if pattern.search(text):
                    out.append(f"says:{name}")
                break
    return out


def own_features(blocks: list[Block]) -> Iterator[set[str]]:
    """Names of the features that each block has beside those of its ancestors."""
    seen_h1 = False
    for k, block in enumerate(blocks):
        text, n = block.text, block.text.count(" ") + 1
        seen_h1 |= block.tag == "h1"
        own = {f"tag:{block.tag}"}
        own.add(f"words:{min(n.bit_length(), 7)}")
        own.add(f"linked:{int(block.linked * 3.999)}")
        own.add(f"ends:{text[-1] if text[-1] in '.!?:,;…»”)' else 'other'}")
        own.add(f"stops:{min(3, text.count('. '))}")
        own.add(f"commas:{min(2, text.count(','))}")
        own.add("after-h1" if seen_h1 else "before-h1")
        own.add("first" if k == 0 else "last" if k == len(blocks) - 1 else "between")
        if n <= 60 and len(text) <= 2000:
            own.update(telling(text.lower()))
        own.add(f"{block.tag}/words:{min(n.bit_length(), 7)}")
        yield own


def features_of(blocks: list[Block]) -> list[list[str]]:
    """Names of all features that hold for each block."""
    return [sorted(own | block.context) for block, own in zip(blocks, own_features(blocks), strict=True)]


class Field:
    """A two-state linear chain: weights of features for "main text", of neighbours, of the first label."""

    def __init__(self, weights: dict[str, float], link: np.ndarray, start: np.ndarray):
        self.weights, self.link, self.start = weights, link, start

    def score(self, names: Iterable[str]) -> float:
        """What these features say for "main text"."""
        weight = self.weights.get
        return sum([weight(name, 0.0) for name in names])

    def decode(self, features: list[list[str]]) -> list[bool]:
        """The most probable labels of blocks with these features."""
        return self.best_path(map(self.score, features))

    def best_path(self, scores: Iterable[float]) -> list[bool]:
        """The most probable labels of blocks with these scores (Viterbi). In a tie the last is not main text, one before it is."""
        (l00, l01), (l10, l11) = self.link.tolist()
        a, b = self.start.tolist()
        back: list[tuple[bool, bool]] = []
        some = False
        for k, score in enumerate(scores):
            if k:
                from_a, from_b = a + l01 > b + l11, a + l00 > b + l10
                a, b = (a + l00 if from_b else b + l10), (a + l01 if from_a else b + l11)
                back.append((not from_b, not from_a))
            b += score
            some = True
        if not some:
            return []
        labels = [b > a]
        for to_a, to_b in reversed(back):
            labels.append(to_b if labels[-1] else to_a)
        return labels[::-1]


def train(pages: list[tuple[list[list[str]], list[bool]]]) -> Field:
    """Fit a field to labelled pages (feature names and labels of their blocks)."""
    pages = [page for page in pages if page[0]]
    names = sorted({name for features, _ in pages for own in features for name in own})
    number = {name: k for k, name in enumerate(names)}
    count, longest = len(pages), max(len(features) for features, _ in pages)
    slot, column = [], []
    gold, real = np.zeros((longest, count), np.int64), np.zeros((longest, count), bool)
    for p, (features, labels) in enumerate(pages):
        for k, own in enumerate(features):
            gold[k, p], real[k, p] = labels[k], True
            slot += [k * count + p] * len(own)
            column += [number[name] for name in own]
    slot, column = np.array(slot), np.array(column)
    weights = np.zeros(len(names) + 6)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    pairs = real[1:]
    for step in range(1, STEPS + 1):
        own, link, start = weights[: len(names)], weights[-6:-2].reshape(2, 2), weights[-2:]
        score = np.zeros((longest, count, 2))
        score[:, :, 1] = np.bincount(slot, own[column], longest * count).reshape(longest, count)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[0] = start + score[0]
        for k in range(1, longest):
            ahead[k] = np.where(real[k][:, None], np.logaddexp.reduce(ahead[k - 1][:, :, None] + link, axis=1) + score[k], ahead[k - 1])
        for k in range(longest - 2, -1, -1):
            behind[k] = np.where(pairs[k][:, None], np.logaddexp.reduce(link + (score[k + 1] + behind[k + 1])[:, None, :], axis=2), behind[k + 1])
        whole = np.logaddexp.reduce(ahead[-1], axis=1)
        one = np.exp(ahead + behind - whole[:, None])
        two = np.exp(ahead[:-1][:, :, :, None] + link + (score[1:] + behind[1:])[:, :, None, :] - whole[:, None, None])
        slope = np.zeros_like(weights)
        error = np.where(real, gold - one[:, :, 1], 0.0).ravel()
        slope[: len(names)] = np.bincount(column, error[slot], len(names))
        held = np.zeros((2, 2))
        np.add.at(held, (gold[:-1][pairs], gold[1:][pairs]), 1)
        slope[-6:-2] = (held - two[pairs].sum(axis=0)).ravel()
        slope[-2:] = np.bincount(gold[0], minlength=2) - one[0].sum(axis=0)
        slope = slope / count - _PULL * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weights = weights + _RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(names, weights.tolist(), strict=False)), weights[-6:-2].reshape(2, 2), weights[-2:])


_MAIN = "\x01"  # in composed pages, in front of main text
_SYLLABLES = "an be cor da el fi gu ha in jo ka lo mi no or pe qua ri sa tu un ve wi xa yo ze".split()


class _Composer:
    """Pages put together from labelled parts."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, least: int, most: int, stop: str = ".") -> str:
        r = self.random
        words = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(least, most))]
        for k in range(6, len(words) - 1, r.randint(5, 14)):
            words[k] += r.choice([",", ".", ". "]).strip()
        return " ".join(words).capitalize() + stop

    def pick(self, *choices: str) -> str:
        return self.random.choice(choices)

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{k}">{self.words(1, 3, "")}</a></li>' for k in range(n))

    def around(self) -> str:
        """A part that isn't main text."""
        r, w = self.random, self.words
        return r.choice(
            [
                lambda: f"<nav><ul>{self.links(r.randint(3, 8))}</ul></nav>",
                lambda: f'<div class="{self.pick("menu", "navbar", "nav-links", "site-nav")}"><ul>{self.links(r.randint(3, 8))}</ul></div>',
                lambda: f'<header class="site-header"><div class="logo">{w(1, 3, "")}</div><p>{w(3, 8, "")}</p></header>',
                lambda: f'<div id="{self.pick("header", "top", "masthead")}"><a href="/">{w(1, 2, "")}</a> <span>{w(2, 6)}</span></div>',
                lambda: f'<aside><h3>{w(1, 3, "")}</h3><p>{w(8, 40)}</p><ul>{self.links(r.randint(2, 5))}</ul></aside>',
                lambda: f'<div class="{self.pick("sidebar", "widget", "side-bar")}"><h4>{w(1, 3, "")}</h4><p>{w(6, 30)}</p></div>',
                lambda: f'<div class="{self.pick("ad", "ads", "advert", "promo", "sponsored")}">{self.pick("", "Advertisement. ", "Sponsored: ")}{w(4, 25)}</div>',
                lambda: f'<div class="{self.pick("ad", "banner-ad", "advertisement")}"><p>{w(4, 25)}</p></div>',
                lambda: f'<div class="{self.pick("cookie-banner", "notice", "consent", "alert")}" role="alert">{self.pick("We use cookies.", "This site uses cookies to work.", "")} {w(5, 25)} <button>{w(1, 1, "")}</button></div>',
                lambda: f'<form action="/s"><label>{self.pick("Search", "Subscribe to our newsletter", "Sign up")}</label><p>{w(3, 12)}</p><input name="q"><button>{w(1, 2, "")}</button></form>',
                lambda: f'<div class="{self.pick("breadcrumb", "breadcrumbs", "crumbs")}"><a href="/">Home</a> / <a href="/x">{w(1, 2, "")}</a></div>',
                lambda: f'<div class="{self.pick("share", "social", "share-buttons")}"><a href="#">Share</a> <a href="#">Tweet</a></div>',
                lambda: f'<section class="{self.pick("related", "more-posts", "recommended")}"><h2>Related</h2><ul>{self.links(r.randint(2, 5))}</ul></section>',
                self.comments,
            ]
        )()

    def comments(self) -> str:
        r, w = self.random, self.words
        own = "".join(f'<li class="comment"><b>{w(1, 2, "")}</b><p>{w(5, 60)}</p><a href="#">Reply</a></li>' for _ in range(r.randint(1, 4)))
        plain = "".join(f'<div class="comment-body"><p>{w(5, 60)}</p></div>' for _ in range(r.randint(1, 4)))
        return r.choice([f'<section id="comments"><h3>{r.randint(1, 40)} comments</h3><ol>{own}</ol></section>', f'<div class="comments">{plain}</div>'])

    def foot(self) -> str:
        w = self.words
        return self.pick(
            f"<footer>&copy; {w(1, 3, '')} &middot; {w(3, 20)}</footer>",
            f"<footer><p>Copyright 2024 {w(1, 3)}</p><ul>{self.links(3)}</ul></footer>",
            f'<div class="footer"><p>{w(3, 15)} All rights reserved.</p></div>',
            "",
        )

    def part(self) -> str:
        """A part of the main text."""
        r, w, m = self.random, self.words, _MAIN
        return r.choices(
            [
                lambda: f"<p>{m}{w(12, 90)}</p>",
                lambda: f"<p>{m}{w(1, 6)}",
                lambda: f"<p>{m}<b>{w(10, 60)}<br>",
                lambda: f'<p>{m}{w(8, 30, "")} <a href="/x">{w(1, 3, "")}</a> {w(5, 30)}</p>',
                lambda: f"<h2>{m}{w(1, 7, '')}</h2>",
                lambda: "<ul>" + "".join(f"<li>{m}{w(3, 20)}</li>" for _ in range(r.randint(2, 4))) + "</ul>",
                lambda: f"<blockquote>{m}{w(8, 40)}</blockquote>",
                lambda: f"<div>{m}{w(12, 60)}</div>",
            ],
            [8, 4, 2, 3, 1.5, 1, 1, 1],
        )[0]()

    def page(self) -> str:
        r = self.random
        parts = [self.part() for _ in range(r.randint(1, 10))]
        if r.random() < 0.25:
            parts.insert(r.randint(0, len(parts)), self.around())
        head = r.choice([f"<h1>{_MAIN}{self.words(2, 12, '')}</h1>", f"<header><h1>{_MAIN}{self.words(2, 12, '')}</h1></header>", ""])
        body = head + "".join(parts) + (self.comments() if r.random() < 0.2 else "")
        name = self.pick("article-body", "post-content", "entry-content", "story", "content", "main", "text")
        body = self.pick(
            f"<article>{body}</article>", f"<main>{body}</main>", f"<main><article>{body}</article></main>",
            f'<div class="{name}">{body}</div>', f'<div id="{name}">{body}</div>', f"<section>{body}</section>", body,
        )
        before = "".join(self.around() for _ in range(r.randint(1, 4)))
        after = "".join(self.around() for _ in range(r.randint(0, 3)))
        return f"<html><head><title>{self.words(2, 8)}</title></head><body>{before}{body}{after}{self.foot()}</body></html>"


def sample_pages(count: int, seed: int = 1) -> list[tuple[list[Block], list[bool]]]:
    """Composed pages: their blocks and which of them are main text."""
    composer, out = _Composer(seed), []
    for _ in range(count):
        blocks = blocks_of(composer.page())
        labels = [_MAIN in block.text for block in blocks]
        for block in blocks:
            block.text = " ".join(block.text.replace(_MAIN, "").split()) or "."
        out.append((blocks, labels))
    return out


def _self_labelled(page: str) -> tuple[list[Block], list[bool]] | None:
    """Blocks and labels of a page that marks its article."""
    blocks = blocks_of(page, deepest=DEEPEST)
    labels = [any(mark in block.context for mark in _MARKED) and not _NOT_MAIN & block.context for block in blocks]
    return (blocks, labels) if any(labels) else None


def learn(pages: DataFrame) -> Field:
    """Train on composed pages and on a bounded sample of the given ones (columns page_id, html)."""
    pages = pages.where(F.length(F.coalesce("html", F.lit(""))) <= LONGEST)
    total = pages.count()
    share = min(1.0, SAMPLE / max(total, 1))
    # By a hash of id and page, so that pages of one id, or of none, aren't chosen together; rows that
    # repeat count once. Twice the share first, then the least hashes: never more than SAMPLE.
    drawn = pages.select(F.coalesce("html", F.lit("")).alias("page"), F.xxhash64("page_id", "html").alias("h"))
    drawn = drawn.where(F.pmod("h", F.lit(1 << 20)) < F.lit(int((2 << 20) * share))).dropDuplicates(["h"])
    chosen = drawn.orderBy("h").limit(SAMPLE).select("page").collect()
    given = [own for (page,) in sorted(chosen) if (own := _self_labelled(page))]
    hide, labelled = random.Random(2), []
    for blocks, labels in [*sample_pages(COMPOSED), *given]:
        features = features_of(blocks)
        if hide.random() < _HIDE:
            features = [[name for name in own if name not in _MARKED and not name.startswith("is:")] for own in features]
        labelled.append((features, labels))
    return train(labelled)


def main_text(page: str | None, field: Field) -> str:
    blocks = blocks_of(page or "", known=field.weights.keys())

    def scores() -> Iterator[float]:
        said: dict[int, float] = {}
        for block, own in zip(blocks, own_features(blocks), strict=True):
            if (key := id(block.context)) not in said:
                said[key] = field.score(sorted(block.context))
            yield said[key] + field.score(sorted(own))

    return " ".join(block.text for block, main in zip(blocks, field.best_path(scores()), strict=True) if main)


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """One row per page: page_id, url, text."""
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(page, shared.value) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=schema.names)

    return pages.select("page_id", "url", "html").mapInArrow(tidy(scan), schema)
