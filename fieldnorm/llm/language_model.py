"""Scoring by a weighted backoff automaton over words.

Tokens are words between white space, A-Z lower-cased, then one end. The base model gives a
token that was seen c times the probability (c + 0.5) / (N + 0.5 (V + 1)). Above it stand
pairs and triples of tokens, absolutely discounted: each is an arc of an automaton whose
states are contexts of up to two tokens (or the beginning of a text), and each state has a
failure arc to its shorter context, weighted so that probabilities sum to one. A text is read
once from left to right; the state is carried and log10 probabilities are added up.

Which pairs and triples the model has is said by ``least``: all that occur that often, at any
input size, or where it is None only those that hold at least 1 / ``ARCS`` of all training
tokens and occur twice. With ``least`` the automaton's arcs are still the frequent ones, with
the weights of the whole model. The others are a stored table of gains: a word's failure
weight; what a pair adds to its word's and its context's weight, with its own failure weight;
what a triple adds to its pair's. A score is the sum of what the automaton gives and of the
gains of the text's other words, pairs and triples: the next frequent ones (at most ``GAINS`` of
each) are broadcast beside the automaton, all others meet the text's where their keys are dealt.
No pair is more frequent than its words, nor a triple than its pairs, so the parts of an arc are arcs.

Defined cases: a null text is empty (one end token); rows with a null id are learned from;
with nothing to learn from every token is unknown; repeated rows count and are scored each.

Scale: all counts cover all training texts and are map-side sums. At most ``ARCS`` words,
pairs and triples each and ``WORDS`` base counts pass the relative thresholds, so what is
broadcast has a bound that no input can exceed. Triples meet the probabilities of their pairs,
the other, rare words their counts, and the other pairs and triples their gains, by keys dealt to
shards of a few times ``SHARE``, whose number follows the input; keys and counts move as packed
blocks, one for each task's buffer and shard. Pairs and triples that a bitmap of fixed size rules
out aren't moved. Texts are scored in one pass: a block of them moves with the keys it asks for,
which name their rows by their place in it, and meets the sums of what they gain.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnorm.llm.bitmap import may_hold_spread, spread_bitmap_of
from fieldnorm.llm.storage import discard, dropping_shuffles, stored
from fieldnorm.llm.words import mixed, slices, tidy, words_of

WORDS = 1 << 20
ARCS = 1 << 18  # at most WORDS
GAINS = 1 << 21  # pairs, and triples, whose gains are broadcast
COMBINED = 1 << 21  # grams counted in a task before they move
SHARE = 1 << 20  # tokens whose grams, or grams whose gains, are met in one task
SEEN = 27  # log2 of the bits of a filter of grams: 16 MB
DISCOUNT = 0.5
_BEGIN = int(mixed(np.array([0x626567], np.uint64)).view(np.int64)[0])
_END = int(mixed(np.array([0x656E64], np.uint64)).view(np.int64)[0])


def _with_ends(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and where each text's tokens begin (one more at the end)."""
    words = words_of(texts, signs=False, lower=True)
    ends = words.first[1:] + np.arange(len(texts))
    out = np.empty(len(words.hash) + len(texts), np.int64)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = words.hash.view(np.int64)
    out[ends] = _END
    return out, words.first + np.arange(len(texts) + 1)


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in the sorted ones, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


class Index:
    """Where keys stand in sorted, evenly spread ones: their first bits say where to look."""

    def __init__(self, sorted_keys: np.ndarray):
        self.size, self.bits = len(sorted_keys), len(sorted_keys).bit_length() + 1
        ranges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.first = np.searchsorted(sorted_keys, (ranges ^ np.uint64(1 << 63)).view(np.int64)).astype(np.int32)
        self.keys = np.append(sorted_keys, np.iinfo(np.int64).max)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Where each key stands, or -1."""
        at = self.first[((keys.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(64 - self.bits)).view(np.int64)]
        found = self.keys[at]
        out = np.where((found == keys) & (at < self.size), at, -1).astype(np.int64)
        left = np.flatnonzero(found < keys)
        at = at[left]
        while len(left):
            at += 1
            found, own = self.keys[at], keys[left]
            met = (found == own) & (at < self.size)
            out[left[met]] = at[met]
            more = found < own
            left, at = left[more], at[more]
        return out


def _joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit key for each pair of keys; a triple's is that of its pairs' keys."""
    return mixed(mixed(a.view(np.uint64)) * np.uint64(0xD1342543DE82EF95) + b.view(np.uint64)).view(np.int64)


def _grams(texts: pa.Array, size: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens, a beginning in front of each text, where each text begins, and the keys of the pair and
    (``size`` 3) the triple that start at each token (those that leave a text are marked by ``_within``)."""
    hashes, first = _with_ends(texts)
    return _grams_of(hashes, first, size)


def _grams_of(hashes: np.ndarray, first: np.ndarray, size: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    tokens = np.insert(hashes, first[:-1], _BEGIN)
    pairs = _joint(tokens[:-1], tokens[1:])
    triples = _joint(pairs[:-1], pairs[1:]) if size > 2 else pairs[:0]
    return tokens, first + np.arange(len(first)), pairs, triples


def _within(first: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` tokens lie in one text."""
    whole = np.ones(max(first[-1] - size + 1, 0), bool)
    for k in range(1, size):
        own = first[1:-1] - k
        whole[own[(own >= 0) & (own < len(whole))]] = False
    return whole


@dataclass
class Model:
    """Base counts of frequent words and the automaton's arcs, as arrays.

    ``words``: sorted hashes of frequent words, ``counts`` theirs. ``grams``: which of them
    (by place) may be in pairs; -1 stands for the beginning of a text and the last number for it.
    """

    tokens: int
    kinds: int
    texts: int
    words: np.ndarray
    counts: np.ndarray
    grams: np.ndarray
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    triples: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    triple_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    #: log10 failure weights of the whole model: of the grams and the beginning, and of the pairs (nan: no arcs).
    gram_back: np.ndarray | None = None
    pair_back: np.ndarray | None = None
    #: Which other gains there may be.
    gains: np.ndarray | None = None
    #: Sorted keys of the next frequent words, pairs and triples with their gains, and of those the automaton
    #: accounts for, without one.
    gain_keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    gain_values: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def whole(self) -> float:
        return self.tokens + 0.5 * (self.kinds + 1)

    def gram_sequence(self, texts: pa.Array) -> np.ndarray:
        """Numbers among ``grams`` of all tokens, the beginning's number in front of each text; -1 for rare words."""
        hashes, first = _with_ends(texts)
        own = _place(self.words[self.grams], hashes)
        return np.insert(own, first[:-1], len(self.grams))

    def seen_pairs(self, texts: pa.Array) -> np.ndarray:
        at = self.gram_sequence(texts)
        a, b = at[:-1], at[1:]
        whole = (a >= 0) & (b >= 0) & (b < len(self.grams))
        return a[whole] * (len(self.grams) + 1) + b[whole]

    def seen_triples(self, texts: pa.Array) -> np.ndarray:
        at, n = self.gram_sequence(texts), len(self.grams)
        a, b = at[:-1], at[1:]
        pair = np.where((a >= 0) & (b >= 0) & (b < n), _place(self.pairs, a * (n + 1) + b), -1)
        whole = (pair[:-1] >= 0) & (pair[1:] >= 0)
        return pair[:-1][whole] * n + at[2:][whole]


class Automaton:
    """States, arcs and failure arcs of a model, and the traversal."""

    def __init__(self, model: Model):
        n, pairs = len(model.grams), model.pairs
        p_word = (model.counts + 0.5) / model.whole
        self.root = np.log10(p_word)
        first, second = pairs // (n + 1), pairs % (n + 1)
        context = np.append(model.counts[model.grams], model.texts)
        p_pair = (model.pair_counts - DISCOUNT) / context[first]
        of_pair, third = model.triples // max(n, 1), model.triples % max(n, 1)
        p_triple = (model.triple_counts - DISCOUNT) / model.pair_counts[of_pair]
        lower = p_pair[_place(pairs, second[of_pair] * (n + 1) + third)]
        # State 0 is the root, 1 to n + 1 are single tokens and the beginning, the rest are pairs.
        states = n + 2 + len(pairs)
        kept, below = np.zeros(states), np.zeros(states)
        np.add.at(kept, 1 + first, p_pair)
        np.add.at(below, 1 + first, p_word[model.grams][second])
        np.add.at(kept, n + 2 + of_pair, p_triple)
        np.add.at(below, n + 2 + of_pair, lower)
        has_arcs = kept > 0
        back = np.log10(np.maximum(1 - kept, 1e-12) / np.maximum(1 - below, 1e-12))
        if model.gram_back is not None:
            back = np.concatenate([[0.0], model.gram_back, model.pair_back])
            has_arcs = ~np.isnan(back)
            has_arcs[0] = False
        fail = np.concatenate([np.zeros(n + 2, np.int64), np.where(has_arcs[1 + second], 1 + second, 0)])
        # A state without arcs is never entered: its failure state stands for it.
        entry = np.where(has_arcs, np.arange(states), fail)
        self.fail, self.back, self.start = fail.tolist(), back.tolist(), int(entry[n + 1])
        self.after = np.zeros(len(model.words), np.int64)
        self.after[model.grams] = entry[1 : n + 1]
        after_triple = entry[n + 2 + _place(pairs, second[of_pair] * (n + 1) + third)]
        state = np.concatenate([1 + first, n + 2 + of_pair])
        word = model.grams[np.concatenate([second, third])] if n else np.zeros(0, np.int64)
        arcs = self._key(state, word)
        order = np.argsort(arcs)
        self.arcs = Index(arcs[order])
        self.target = np.concatenate([entry[n + 2 :], after_triple])[order]
        self.weight = np.log10(np.concatenate([p_pair, p_triple]))[order]
        self.fail, self.back, self.start, self.begin = fail, back, entry[n + 1], n + 1
        self.after, self.single = np.zeros((2, len(model.words) + 1), np.int64)  # the last is that of rare words
        self.after[model.grams], self.single[model.grams] = entry[1 : n + 1], np.arange(1, n + 1)
        self.root = np.append(self.root, 0.0)
        self.words, self.near = Index(model.words), Index(model.gain_keys)
        if model.gains is not None:
            near = np.append(self.near.place(model.words), -1)
            self.word_gain = np.append(model.gain_values, 0.0)[near]
            self.word_ask = np.append(may_hold_spread(model.gains, model.words), False) & (near < 0)

    @staticmethod
    def _key(state: np.ndarray, word: np.ndarray) -> np.ndarray:
        return mixed(((state << 20) | word).view(np.uint64)).view(np.int64)

    def _arc(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        return np.where((state > 0) & (word >= 0), self.arcs.place(self._key(state, word)), -1)

    def scores(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probabilities of texts of numbered words; rare words (-1) only cost their failure arcs here.

        All places go down their failure arcs in step. The state in front of each is known before:
        a context's parts are contexts, so after a word it is the word with the one in front of it
        if they are an arc, otherwise the word alone; the former fails to the latter.
        """
        single = np.append(self.begin, self.single[words[:-1]])
        single[first[:-1]] = self.begin
        arc = self._arc(single, words)
        after = np.where(arc >= 0, self.target[arc] if len(self.target) else 0, self.after[words])
        state = np.append(0, after[:-1])
        state[first[:-1]] = self.start
        total, left = np.zeros(len(words)), np.ones(len(words), bool)

        def step(at: np.ndarray, arc: np.ndarray) -> None:
            found, failed = arc >= 0, at[arc < 0]
            total[at[found]] += self.weight[arc[found]]
            left[at[found]] = False
            total[failed] += self.back[state[failed]]
            state[failed] = self.fail[state[failed]]

        deep = np.flatnonzero(state > self.begin)
        step(deep, self._arc(state[deep], words[deep]))
        shallow = np.flatnonzero(left & (state > 0))
        step(shallow, arc[shallow])
        total[left] += self.root[words[left]]
        return np.add.reduceat(total, first[:-1])


def _by_shard(spread: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by shard, and where each shard begins in it. It is told by other bits than those ``Index`` looks at first."""
    low = spread.view(np.uint64) & np.uint64(0xFFFFFFFF)
    shard_of = (low * np.uint64(shards) >> np.uint64(32)).astype(np.uint16 if shards <= 1 << 16 else np.int64)
    return np.argsort(shard_of, kind="stable"), np.append(0, np.cumsum(np.bincount(shard_of, minlength=shards)))


def _narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs; the first byte says how many."""
    kind = np.min_scalar_type(x.max())
    return bytes([kind.itemsize]) + x.astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _counted(docs: DataFrame, tokens) -> DataFrame:
    """How often each of the long values occurs that ``tokens`` gives for a slice of texts: key, n."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def combined(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        order, cuts = _by_shard(mixed(keys.view(np.uint64)), shards)
        own = [(k, order[cuts[k] : cuts[k + 1]]) for k in np.flatnonzero(np.diff(cuts)).tolist()]
        columns = [pa.array([k for k, _ in own], pa.int32()), pa.array([keys[x].tobytes() for _, x in own], pa.binary())]
        columns.append(pa.array([_narrow(n[x]) for _, x in own], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=["shard", "keys", "n"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for part in slices(batch, "text"):
                held.append(tokens(part.column("text")).astype(np.int64, copy=False))
                if sum(map(len, held)) >= COMBINED:
                    yield combined(held)
                    held = []
        if held:
            yield combined(held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            (np.frombuffer(keys, np.int64), _wide(n))
            for batch in batches
            for keys, n in zip(batch.column("keys").to_pylist(), batch.column("n").to_pylist(), strict=True)
        ]
        if held:
            keys, n = map(np.concatenate, zip(*held, strict=True))
            order = np.argsort(keys)
            keys = keys[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(keys[starts]), pa.array(np.add.reduceat(n[order], starts))], names=["key", "n"])

    blocks = docs.select("text").mapInArrow(tidy(scan), "shard int, keys binary, n binary")
    return blocks.repartitionById(shards, "shard").mapInArrow(tidy(summed), "key long, n long")


def _arrays(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their counts. Only for what has passed a relative threshold."""
    found = counts.toArrow()
    key, n = (found.column(name).to_numpy() for name in ("key", "n"))
    order = np.argsort(key)
    return key[order], n[order]


def learn(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model and all base counts (key: a word's hash, n)."""
    counts = stored(_counted(training, lambda texts: _with_ends(texts)[0]), "words")
    tokens, kinds, texts = counts.agg(F.sum("n"), F.count("*"), F.max(F.when(F.col("key") == _END, F.col("n")))).first()
    tokens, texts = tokens or 0, texts or 0
    words, n = _arrays(counts.where(F.col("n") * WORDS >= tokens))
    model = Model(tokens, kinds, texts, words, n, np.flatnonzero(n * ARCS >= tokens))
    spark = training.sparkSession
    enough = (F.col("n") >= 2) & (F.col("n") * ARCS >= tokens)
    for keys, sizes, seen in (("pairs", "pair_counts", Model.seen_pairs), ("triples", "triple_counts", Model.seen_triples)):
        shared = spark.sparkContext.broadcast(model)
        found = _arrays(_counted(training, lambda texts, shared=shared, seen=seen: seen(shared.value, texts)).where(enough))
        setattr(model, keys, found[0])
        setattr(model, sizes, found[1])
    return model, counts


def _cuts(sorted_keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the keys of each shard begin: a shard has an equal range of all 64-bit keys."""
    bounds = np.arange(1, shards, dtype=np.uint64) * np.uint64((1 << 64) // shards if shards > 1 else 0)
    bounds = (bounds ^ np.uint64(1 << 63)).view(np.int64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, bounds), [len(sorted_keys)]])


def _packed(x: np.ndarray) -> bytes:
    """Longs as bytes, their lowest bytes first, so that small ones compress to about a byte each."""
    return x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


_BLOCK = "shard int, a binary, b binary, n binary"
_COUNTED = "key long, a long, b long, n long"


def _as_rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "a", "b", "n"])


def _counted_grams(docs: DataFrame, size: int, least: int, parts_seen: np.ndarray | Broadcast, shards: int, given=_as_rows, schema: str = _COUNTED) -> DataFrame:
    """Pairs of tokens (size 2) or of pairs' keys (size 3) that occur ``least`` times: key, a, b, n, or what
    ``given`` makes of these for each shard.

    Those with a part that is not in the bitmap ``parts_seen`` occur less often and aren't moved.
    The others are combined in a task and move in blocks, one for each shard of keys.
    """
    shared = parts_seen if isinstance(parts_seen, Broadcast) else docs.sparkSession.sparkContext.broadcast(parts_seen)

    def combined(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        keys, a, b = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        one = np.argsort(keys)
        keys = keys[one]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.diff(np.append(starts, len(keys)))
        keys, one = keys[starts], one[starts]
        cuts = _cuts(keys, shards)
        blocks: list[tuple] = []
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            own = one[cuts[shard] : cuts[shard + 1]]
            order = np.argsort(a[own])  # equal ones side by side compress
            own = own[order]
            blocks.append((shard, a[own].tobytes(), b[own].tobytes(), _packed(n[cuts[shard] : cuts[shard + 1]][order])))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*blocks, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)], names=["shard", "a", "b", "n"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, first, pairs, triples = _grams(part.column("text"), size)
                parts, keys = (tokens, pairs) if size == 2 else (pairs, triples)
                seen = may_hold_spread(shared.value, parts)
                at = np.flatnonzero(_within(first, size) & seen[:-1] & seen[1:])
                if len(at):
                    held.append((keys[at], parts[at], parts[at + 1]))
                if sum(len(x[0]) for x in held) >= COMBINED:
                    yield combined(held)
        if held:
            yield combined(held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            (np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), _unpacked(n))
            for batch in batches
            for a, b, n in zip(*(batch.column(name).to_pylist() for name in ("a", "b", "n")), strict=True)
        ]
        if not held:
            return
        a, b, n = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        keys = _joint(a, b)
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.add.reduceat(n[order], starts)
        often = n >= least
        one = order[starts[often]]
        if len(one):
            yield given(keys[starts[often]], a[one], b[one], n[often])

    blocks = docs.select("text").mapInArrow(tidy(scan), _BLOCK)
    return blocks.repartitionById(shards, "shard").mapInArrow(tidy(summed), schema)


_cached: dict[str, object] = {}


def _once(name: str, make):
    """What a worker has made under that name, or else makes now; it keeps one thing alone."""
    if name not in _cached:
        _cached.clear()
        _cached[name] = make()
    return _cached[name]


def _counted_pairs(docs: DataFrame, least: int, words_seen: Broadcast, shards: int, model: Model) -> DataFrame:
    """Pairs with the counts of their words where those are frequent: n_a, n_b."""
    shared, name = docs.sparkSession.sparkContext.broadcast((model.words, model.counts, model.texts)), uuid.uuid4().hex

    def given(keys: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        words, counts, texts = shared.value
        index, counts = _once(name, lambda: Index(words)), np.append(counts, 0)
        at, to, begin = index.place(a), index.place(b), a == _BEGIN
        more = [pa.array(np.where(begin, texts, counts[at]), mask=(at < 0) & ~begin), pa.array(counts[to], mask=to < 0)]
        return pa.RecordBatch.from_arrays([*map(pa.array, (keys, a, b, n)), *more], names=["key", "a", "b", "n", "n_a", "n_b"])

    return _counted_grams(docs, 2, least, words_seen, shards, given, _COUNTED + ", n_a long, n_b long")


_ARCS = "shard int, kind int, a binary, b binary, n binary, x binary"
_LOWER, _PAIR, _TRIPLE = range(3)  # kinds of arcs' blocks


def _arc_blocks(kind: int, of: np.ndarray, shards: int, a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None, x: np.ndarray | None) -> pa.RecordBatch:
    """Blocks of arcs, dealt by the keys ``of``, equal ones side by side."""
    first = np.argsort(of)
    order, cuts = _by_shard(of[first], shards)
    order, blocks = first[order], []
    for shard in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[shard] : cuts[shard + 1]]
        of_n = None if n is None else _packed(n[own])
        blocks.append((shard, kind, a[own].tobytes(), None if b is None else b[own].tobytes(), of_n, None if x is None else x[own].tobytes()))
    types = {"shard": pa.int32(), "kind": pa.int32(), "a": pa.binary(), "b": pa.binary(), "n": pa.binary(), "x": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(y, t) for y, t in zip(zip(*blocks, strict=True), types.values(), strict=True)], names=list(types))


def _arcs_in(batches: Iterator[pa.RecordBatch], *kinds: int) -> list[list[np.ndarray]]:
    """The columns a, b, n and x of the blocks of each kind."""
    none = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.float64)]
    held: dict[int, list] = {kind: [none] for kind in kinds}
    for batch in batches:
        for kind, a, b, n, x in zip(*(batch.column(name).to_pylist() for name in ("kind", "a", "b", "n", "x")), strict=True):
            held[kind].append([np.frombuffer(a, np.int64), np.frombuffer(b or b"", np.int64), _unpacked(n or b""), np.frombuffer(x or b"")])
    return [[np.concatenate(x) for x in zip(*held[kind], strict=True)] for kind in kinds]


def _joined_triples(pairs: DataFrame, weighed: DataFrame, triples: DataFrame, shards: int, often: int) -> DataFrame:
    """Gains of pairs and triples: kind, key, n, gain. Those that occur ``often`` have their a, b and, if pairs, failure
    weights too (back, nan without arcs).

    ``pairs``: key, p; ``weighed``: key, a, b, n, gain without the pair's own failure weight; ``triples``: blocks of
    counted ones, dealt by their second pairs. They meet the second pairs' probabilities, then their first pairs.
    """

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, p = (batch.column(name).to_numpy() for name in ("key", "p"))
                yield _arc_blocks(_LOWER, key, shards, key, None, None, p)

    def lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (key, _, _, p), (a, b, n, _) = _arcs_in(batches, _LOWER, _TRIPLE)
        if len(a):
            order = np.argsort(key)
            at = Index(key[order]).place(b)
            own = at >= 0
            yield _arc_blocks(_TRIPLE, a[own], shards, a[own], b[own], n[own], p[order][at[own]])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, a, b, n, gain = (batch.column(name).to_numpy() for name in ("key", "a", "b", "n", "gain"))
                yield _arc_blocks(_PAIR, key, shards, np.stack([a, b], 1), key, n, gain)

    def gained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ends, key, count, gain), (a, b, n, lower) = _arcs_in(batches, _PAIR, _TRIPLE)
        order = np.argsort(key)
        ends, key, count, gain = ends.reshape(-1, 2)[order], key[order], count[order], gain[order]
        at = Index(key).place(a)
        own = at >= 0
        at, a, b, n, lower = at[own], a[own], b[own], n[own], lower[own]
        p = (n - DISCOUNT) / count[at]
        kept, below = (np.bincount(at, weights=x, minlength=len(key)) for x in (p, lower))
        back = np.log10(np.maximum(1 - kept, 1e-12) / np.maximum(1 - below, 1e-12))
        arcs = kept > 0
        few = n < often
        of_triples = _joint(a, b), np.where(few, 0, a), np.where(few, 0, b), n, np.log10(p) - np.log10(lower) - back[at], np.zeros(len(a))
        weight = np.where(count < often, 0.0, np.where(arcs, back, np.nan))
        of_pairs = key, ends[:, 0], ends[:, 1], count, gain + np.where(arcs, back, 0.0), weight
        for kind, columns in ((_PAIR, of_pairs), (_TRIPLE, of_triples)):
            if len(columns[0]):
                kinds = np.full(len(columns[0]), kind, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kinds, *columns)], names=["kind", "key", "a", "b", "n", "gain", "back"])

    met = triples.union(pairs.select("key", "p").mapInArrow(tidy(second), _ARCS))
    met = met.repartitionById(shards, "shard").mapInArrow(tidy(lowered), _ARCS)
    met = met.union(weighed.mapInArrow(tidy(first), _ARCS))
    return met.repartitionById(shards, "shard").mapInArrow(tidy(gained), "kind int, key long, a long, b long, n long, gain double, back double")


def _failures(arcs: DataFrame, context: str) -> DataFrame:
    """log10 failure weights of the contexts of arcs with their probability ``p`` and a ``lower`` one."""
    sums = arcs.groupBy(F.col(context).alias("of")).agg(F.sum("p").alias("kept"), F.sum("lower").alias("below"))
    rest = [F.greatest(1 - F.col(name), F.lit(1e-12)) for name in ("kept", "below")]
    return sums.select("of", F.log10(rest[0] / rest[1]).alias("back"))


def learn_whole(training: DataFrame, least: int) -> tuple[Model, DataFrame, DataFrame]:
    """The model, all base counts, and the gains (key, gain) of what is not in the automaton."""
    counts = stored(_counted(training, lambda texts: _with_ends(texts)[0]), "words")
    tokens, kinds, texts = counts.agg(F.sum("n"), F.count("*"), F.max(F.when(F.col("key") == _END, F.col("n")))).first()
    tokens, texts = tokens or 0, texts or 0
    words, n = _arrays(counts.where(F.col("n") * WORDS >= tokens))
    model = Model(tokens, kinds, texts, words, n, np.flatnonzero(n * ARCS >= tokens))
    frequent = F.col("n") * ARCS >= tokens

    spark = training.sparkSession
    context = counts.select(F.col("key").alias("a"), F.col("n").alias("n_a"))
    context = context.union(spark.range(1).select(F.lit(_BEGIN).alias("a"), F.lit(texts).cast("long").alias("n_a")))
    second = counts.select(F.col("key").alias("b"), ((F.col("n") + 0.5) / F.lit(model.whole)).alias("lower"))
    seen = context.where((F.col("n_a") >= least) | (F.col("a") == _BEGIN)).withColumnRenamed("a", "key")
    seen = spark.sparkContext.broadcast(spread_bitmap_of(seen, SEEN))
    shards = 1 + tokens // SHARE
    # The words are read again only for what becomes an arc.
    slim = ["key", "a", F.when(frequent, F.col("b")).alias("b"), "n", ((F.col("n") - DISCOUNT) / F.col("n_a")).alias("p"), "lower"]
    counted = stored(_counted_pairs(training, least, seen, shards, model), "pair-counts")
    seen.destroy()
    both = F.col("n_a").isNotNull() & F.col("n_b").isNotNull()
    lower = (F.col("n_b") + 0.5) / F.lit(model.whole)
    rest = counted.where(~both).drop("n_a", "n_b").join(context, "a").join(second, "b")
    pairs = stored(counted.where(both).withColumn("lower", lower).select(slim).union(rest.select(slim)), "pairs")
    discard(counted)
    of_words = stored(_failures(pairs, "a").join(context.withColumnRenamed("a", "of"), "of"), "word-failures")

    seen = spark.sparkContext.broadcast(spread_bitmap_of(pairs, SEEN))
    wide = 1 + shards // 4

    def by_second(key: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return _arc_blocks(_TRIPLE, b, wide, a, b, n, None)

    triples = stored(_counted_grams(training, 3, least, seen, shards, by_second, _ARCS), "triple-counts")
    seen.destroy()
    added = F.log10("p") - F.log10("lower") - F.col("back")
    ends = [F.when(frequent, F.col(name)).otherwise(F.lit(0)).alias(name) for name in ("a", "b")]
    weighed = pairs.join(of_words.select(F.col("of").alias("a"), "back"), "a").select("key", *ends, "n", added.alias("gain"))
    arcs = stored(_joined_triples(pairs, weighed, triples, wide, -(-tokens // ARCS)), "arcs")
    discard(triples, pairs)
    gains = of_words.where((F.col("n_a") * ARCS < tokens) & (F.col("of") != _BEGIN)).select(F.col("of").alias("key"), F.col("n_a").alias("n"), F.col("back").alias("gain"))
    gains = gains.union(arcs.where(~frequent).select("key", "n", "gain"))

    def arrays(df: DataFrame) -> list[np.ndarray]:
        with dropping_shuffles(spark):
            return [column.to_numpy(zero_copy_only=False) for column in df.toArrow().combine_chunks().columns]

    grams, size = model.words[model.grams], len(model.grams)
    of, back = arrays(of_words.where((F.col("n_a") * ARCS >= tokens) | (F.col("of") == _BEGIN)).select("of", "back"))
    model.gram_back = np.full(size + 1, np.nan)
    model.gram_back[np.where(of == _BEGIN, size, _place(grams, of))] = back
    key, a, b, n, back = arrays(arcs.where(frequent & (F.col("kind") == _PAIR)).select("key", "a", "b", "n", "back"))
    numbers = np.where(a == _BEGIN, size, _place(grams, a)) * (size + 1) + _place(grams, b)
    order = np.argsort(numbers)
    model.pairs, model.pair_counts, model.pair_back = numbers[order], n[order], back[order].astype(np.float64)
    by_key = np.argsort(key[order])
    key3, a, b, n = arrays(arcs.where(frequent & (F.col("kind") == _TRIPLE)).select("key", "a", "b", "n"))
    place = [by_key[_place(key[order][by_key], x)] if len(x) else np.zeros(0, np.int64) for x in (a, b)]
    numbers = place[0] * size + model.pairs[place[1]] % (size + 1)
    order = np.argsort(numbers)
    model.triples, model.triple_counts = numbers[order], n[order]
    own = np.unique(np.concatenate([grams, key, key3, [_BEGIN, _END]]))
    # At most GAINS of words, of pairs and of triples are as frequent as that.
    near = F.col("n") * GAINS >= tokens
    key, gain = arrays(gains.where(near).select("key", "gain"))
    key, gain = np.append(own, key), np.append(np.zeros(len(own)), gain.astype(np.float64))
    order = np.argsort(key)
    model.gain_keys, model.gain_values = key[order], gain[order]
    gains = gains.where(~near).drop("n")
    model.gains = spread_bitmap_of(gains, SEEN)
    return model, counts, gains


def _asked(model: Model, automaton: Automaton, hashes: np.ndarray, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the sum of the broadcast gains; keys and texts of all words (numbered ``at``), pairs and
    triples that may have another gain. A triple has one only where both of its pairs are in the model."""
    tokens, first, pairs, triples = _grams_of(hashes, starts)
    texts = len(first) - 1
    row = np.repeat(np.arange(texts), np.diff(first))
    total = np.bincount(np.repeat(np.arange(texts), np.diff(starts)), weights=automaton.word_gain[at], minlength=texts)
    inside = np.zeros(len(pairs), bool)
    keys, rows = [], []
    for size, own in enumerate((tokens, pairs, triples), 1):
        if size == 1:
            left = np.flatnonzero(np.insert((at < 0) | automaton.word_ask[at], starts[:-1], False))
        elif size == 2:
            left = np.flatnonzero(_within(first, 2))
        else:
            left = np.flatnonzero(_within(first, 3) & inside[:-1] & inside[1:])
        near = automaton.near.place(own[left])
        found = near >= 0
        total += np.bincount(row[left[found]], weights=model.gain_values[near[found]], minlength=texts)
        other = left[~found]
        other = other[may_hold_spread(model.gains, own[other])]
        if size == 2:
            inside[left[found]] = inside[other] = True
        keys.append(own[other])
        rows.append(row[other])
    return total, np.concatenate(keys), np.concatenate(rows)


_MET = "shard int, kind int, block long, keys binary, more binary"
_GAINS, _WORD_GAINS, _ASKED, _WORDS_ASKED, _TEXTS = range(5)  # kinds of what meets


def _dealt(keys: np.ndarray, more: np.ndarray, shards: int, kind: int, block: int | None, pack) -> list[tuple]:
    """Blocks of keys and what goes with them, one for each shard."""
    order, cuts = _by_shard(keys, shards)
    keys, more = keys[order], more[order]
    return [
        (shard, kind, block, keys[cuts[shard] : cuts[shard + 1]].tobytes(), pack(more[cuts[shard] : cuts[shard + 1]]))
        for shard in np.flatnonzero(np.diff(cuts)).tolist()
    ]


def _met(blocks: list[tuple]) -> pa.RecordBatch:
    types = {"shard": pa.int32(), "kind": pa.int32(), "block": pa.int64(), "keys": pa.binary(), "more": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*blocks, strict=True), types.values(), strict=True)], names=list(types))


def _home(block: int, homes: int) -> int:
    """Where a block of texts meets its sums."""
    return int(mixed(np.array([block], np.uint64))[0] % np.uint64(homes))


def _requests(docs: DataFrame, model: Model, shards: int) -> DataFrame:
    """Texts in blocks of rows with what frequent words and broadcast gains add, and the keys they ask for.

    A block's number is that of its task and place and of its words in their order: where a lost task runs again and
    gets its rows in another order, no sum meets the wrong row.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def flushed(block: int, texts: list[pa.RecordBatch], grams: list, words: list) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(texts)
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        blocks = [(_home(block, shards), _TEXTS, block, None, sink.getvalue().to_pybytes())]
        for kind, held in ((_ASKED, grams), (_WORDS_ASKED, words)):
            keys, rows = map(np.concatenate, zip(*held, strict=True))
            order = np.argsort(rows.astype(np.uint16) if rows.max(initial=0) < 1 << 16 else rows, kind="stable") if kind == _ASKED else slice(None)
            blocks += _dealt(keys[order], rows[order], shards, kind, block, lambda r: _narrow(np.diff(r, prepend=0)))
            held.clear()
        texts.clear()
        return _met(blocks)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _once(name, lambda: Automaton(shared.value))
        number, mark, rows = TaskContext.get().partitionId() << 24, np.uint64(0), 0
        texts, grams, words = [], [], []

        def block() -> int:
            return int(mixed(mark[None] + np.uint64(number))[0] >> np.uint64(1))

        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first = _with_ends(part.column("text"))
                with np.errstate(over="ignore"):
                    mark = mixed(mark[None] + mixed(hashes.view(np.uint64) + np.arange(len(hashes), dtype=np.uint64)).sum())[0]
                at = automaton.words.place(hashes)
                known = at >= 0
                rare = np.flatnonzero(~known)
                score = automaton.scores(at, first)
                words.append((hashes[rare], rows + np.searchsorted(first, rare, side="right") - 1))
                keys, asking = hashes[:0], rare[:0]
                if shared.value.gains is not None:
                    gained, keys, asking = _asked(shared.value, automaton, hashes, at, first)
                    score += gained
                grams.append((keys, rows + asking))
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(np.diff(first), pa.int64())]
                columns.append(pa.array(np.add.reduceat(known.astype(np.int64), first[:-1])))
                columns += [pa.array(np.add.reduceat(automaton.root[at], first[:-1])), pa.array(score)]
                texts.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_frequent", "base", "score"]))
                rows += part.num_rows
                if rows >= COMBINED or sum(len(x[0]) for x in (*grams, *words)) >= COMBINED:
                    yield flushed(block(), texts, grams, words)
                    number, rows = number + 1, 0
        if texts:
            yield flushed(block(), texts, grams, words)

    return docs.mapInArrow(tidy(scan), _MET)


def _table(gains: DataFrame, shards: int, kind: int) -> DataFrame:
    """Gains (key, gain) in blocks, one for each buffer and shard of keys."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            keys, values = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            return _met(_dealt(keys, values, shards, kind, None, lambda v: v.tobytes()))

        for batch in batches:
            held.append((batch.column("key").to_numpy(), batch.column("gain").to_numpy()))
            if sum(len(x[0]) for x in held) >= COMBINED:
                yield block()
        if sum(len(x[0]) for x in held):
            yield block()

    return gains.select("key", "gain").mapInArrow(tidy(scan), _MET)


def _scored(docs: DataFrame, model: Model, tables: dict[int, DataFrame]) -> DataFrame:
    """The rows of ``score_texts``. Keys meet the gains of ``tables`` by shards, sums meet the texts' blocks."""
    shards, homes = 1 + model.tokens // (4 * SHARE), 1 + model.tokens // SHARE
    # A rare word that was never seen costs 0.5 / whole; the others gain what they cost less.
    unseen, tokens = float(np.log10(0.5 / model.whole)), model.tokens
    of = T.StructType([docs.schema["doc_id"], docs.schema["held_out"]])
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double")):
        of = of.add(name, kind)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[tuple[int, int, bytes, bytes]] = []
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {_GAINS: [], _WORD_GAINS: []}
        for batch in batches:
            for _, kind, block, keys, more in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if kind == _TEXTS:
                    yield answered([(_home(block, homes), kind, block, None, None, more)])
                elif kind in held:
                    held[kind].append((np.frombuffer(keys, np.int64), np.frombuffer(more, np.float64)))
                else:
                    asked.append((kind, block, keys, more))
        found: list[tuple] = []
        for table, kind in ((_GAINS, _ASKED), (_WORD_GAINS, _WORDS_ASKED)):
            if not held[table]:
                continue
            keys, values = map(np.concatenate, zip(*held.pop(table), strict=True))
            order = np.argsort(keys)
            index, values = Index(keys[order]), values[order]
            for _, block, own, rows in (x for x in asked if x[0] == kind):
                at = index.place(np.frombuffer(own, np.int64))
                met = np.flatnonzero(at >= 0)
                if not len(met):
                    continue
                rows = np.cumsum(_wide(rows))[met]
                starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                sums, n = np.add.reduceat(values[at[met]], starts), np.diff(np.append(starts, len(rows)))
                found.append((_home(block, homes), kind, block, _narrow(np.diff(rows[starts], prepend=0)), _narrow(n), sums.tobytes()))
        if found:
            yield answered(found)

    def answered(blocks: list[tuple]) -> pa.RecordBatch:
        types = {"home": pa.int32(), "kind": pa.int32(), "block": pa.int64(), "rows": pa.binary(), "n": pa.binary(), "more": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*blocks, strict=True), types.values(), strict=True)], names=list(types))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, bytes] = {}
        sums: dict[int, list[tuple]] = {}
        for batch in batches:
            for _, kind, block, rows, n, more in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if kind == _TEXTS:
                    texts[block] = more
                else:
                    sums.setdefault(block, []).append((kind, rows, n, more))
        for block, raw in texts.items():
            own = pa.ipc.open_stream(raw).read_all().combine_chunks()
            n_tokens, known, base, score = (own.column(name).to_numpy() for name in ("n_tokens", "n_frequent", "base", "score"))
            more = (n_tokens - known) * unseen
            known, gained = known.copy(), np.zeros(len(score))
            for kind, rows, n, values in sums.pop(block, []):
                rows, values = np.cumsum(_wide(rows)), np.frombuffer(values, np.float64)
                if kind == _ASKED:
                    gained[rows] += values
                else:
                    more[rows] += values
                    known[rows] += _wide(n)
            columns = [pa.array(x) for x in (n_tokens, known, np.full(len(score), tokens), base + more, score + more + gained)]
            yield from pa.table([own.column("doc_id"), own.column("held_out"), *columns], names=of.names).to_batches()
        if sums:
            raise RuntimeError("a lost task got its texts in another order; store them before they are scored")

    met = reduce(DataFrame.union, [_requests(docs, model, shards), *(_table(gains, shards, kind) for kind, gains in tables.items())])
    sums = met.repartitionById(shards, "shard").mapInArrow(tidy(answers), "home int, kind int, block long, rows binary, n binary, more binary")
    return sums.repartitionById(homes, "home").mapInArrow(tidy(added), of)


def score_texts(docs: DataFrame, held_out: Column, *, least: int | None = None) -> DataFrame:
    """Learn from the rows that aren't held out and score all of them.

    With ``least`` (two or more) the model has all pairs and triples that occur so often.

    Gives doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    """
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    training = docs.where(~F.col("held_out"))
    model, counts, *gains = learn(training) if least is None else learn_whole(training, least)
    rare = counts.where(F.col("n") * WORDS < model.tokens).select("key", F.log10((F.col("n") + 0.5) / 0.5).alias("gain"))
    scored = stored(_scored(docs, model, {_WORD_GAINS: rare, **{_GAINS: table for table in gains}}), "scores")
    discard(counts, *gains)
    return scored
