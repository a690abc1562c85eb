"""Plain Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\f\r"


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sign_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for item_id, text in items:
        words = sign_words(text)
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])] |= {item_id} - {None}
    out = []
    for doc_id, text in docs:
        words, hit, ids = sign_words(text), set(), set()
        for n in {len(window) for window in windows}:
            for k in range(len(words) - n + 1):
                found = windows.get(tuple(words[k : k + n]))
                if found is not None:
                    ids |= found
                    hit |= {*range(k, k + n)}
        out.append((doc_id, len(words), len(hit), sorted(map(str, ids))))
    return out


def line_report(docs):
    def key(line):
        return line.strip(SPACES).translate(LOWER)

    holders = defaultdict(set)
    low = -(1 << 63)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(low if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        lines, own = (text or "").split("\n"), low if doc_id is None else doc_id
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and own != max(holders[key(x)]))]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_set(text, size):
    words = space_words((text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def near_duplicates(docs, size=2):
    """Rows with ids only."""
    sets = [shingle_set(text, size) for _, text in docs]
    of = list(range(len(docs)))

    def root(k):
        while of[k] != k:
            k = of[k]
        return k

    for a, one in enumerate(sets):
        for b, other in enumerate(sets[:a]):
            if one and other:
                both = len(one & other)
                if 100 * both >= 80 * (len(one) + len(other) - both):
                    of[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return [(doc_id, len(sets[k]), least[root(k)], doc_id == least[root(k)]) for k, (doc_id, _) in enumerate(docs)]


def without_repeats(docs, size=35):
    words_of = [(doc_id, space_words(text)) for doc_id, text in docs]
    times = Counter(tuple(words[k : k + size]) for _, words in words_of for k in range(len(words) - size + 1))
    out = []
    for doc_id, words in words_of:
        gone = {k + j for k in range(len(words) - size + 1) if times[tuple(words[k : k + size])] > 1 for j in range(size)}
        out.append((doc_id, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def measures(text):
    words = space_words(text)
    lines = [line for line in (text or "").split("\n") if space_words(line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed
