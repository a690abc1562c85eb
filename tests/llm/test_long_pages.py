"""Pages that are hard on a scanner: time and memory in proportion to their length; Viterbi against all paths."""

import itertools
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from fieldnorm.llm import main_text
from fieldnorm.llm.dom import blocks_of

SIZE = 2_000_000
FIELD = main_text.Field({"in:div": 0.2, "is:x": 0.1, "tag:div": 0.3}, np.array([[0.1, -0.1], [-0.1, 0.1]]), np.array([0.0, 0.1]))
HARD = {
    "declarations without end": "<!",
    "tags without end": "<a ",
    "quotes without end": '<a b="',
    "quotes that close behind the tag": '"<b ">',
    "names without end": "<a",
    "comments without end": "<!--",
    "end tags of a script without end": "<script>" + "</script ",
    "unclosed spans": '<span class="x y">word<div>a</div>',
    "unclosed spans of many names": None,
    "nested blocks": "<div>",
    "nested blocks with text": "<div>a",
    "end tags of what is not open": "<span>x</b>",
    "rows outside tables": "<tr><td>a",
    "references": "&amp&lt",
}


def page_of(part: str | None) -> str:
    if part is None:
        return "".join(f'<span class="{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}">w<div>a</div>' for k in range(SIZE // 35))
    return part * (SIZE // len(part))


@pytest.mark.parametrize("kind", HARD)
def test_two_megabytes_in_seconds_and_little_memory(kind):
    code = (
        "import resource, time; from tests.llm.test_long_pages import *\n"
        f"page = page_of(HARD[{kind!r}]); began = time.process_time(); main_text.main_text(page, FIELD)\n"
        "print(time.process_time() - began, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)"
    )
    root = Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120, check=True)
    seconds, megabytes = map(float, done.stdout.split())
    assert seconds < 25 and megabytes < 600, (seconds, megabytes)


def test_what_hard_pages_say():
    assert [block.text for block in blocks_of("<p>a <!b <c d")] == ["a <!b <c d"]
    assert [block.text for block in blocks_of("<p>a<!-- b > c")] == ["a"]
    assert [block.text for block in blocks_of("""<p title="a > b">c</p><p title='>'>d""")] == ["c", "d"]
    assert [block.text for block in blocks_of("""<p title=">c</p><i x='>'>d""")] == ["c", "d"]
    assert [block.text for block in blocks_of("<p>a<script>b</script c</p>d>e")] == ["ad>e"]
    assert [sorted(block.context) for block in blocks_of("<div id=a><b>x</div>y")] == [["in:b", "in:div", "is:a"], []]
    assert blocks_of("<ul>" * 300 + "x", deepest=200) == []
    (block,) = blocks_of("<nav class='menu own'>x", known={"in:nav", "is:own"})
    assert block.context == {"in:nav", "is:own"}


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_against_all_paths(seed):
    r = np.random.default_rng(seed)
    field = main_text.Field({}, r.normal(size=(2, 2)), r.normal(size=2))
    for n in range(9):
        scores = r.normal(size=n).tolist()

        def value(labels, scores=scores):
            own = sum(score for score, label in zip(scores, labels, strict=True) if label)
            return own + field.start[labels[0]] + sum(field.link[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product([0, 1], repeat=n), key=value) if n else ()
        assert field.best_path(iter(scores)) == [bool(label) for label in best]


def test_training_climbs_to_where_the_likelihood_is_flat():
    """No small change of a weight makes labelled pages more probable (all label paths summed up by hand)."""
    r = random.Random(4)
    pages = [([[r.choice("abc")] for _ in range(4)], [r.random() < 0.5 for _ in range(4)]) for _ in range(12)]
    field = main_text.train(pages)

    def value(weights, link, start):
        total = 0.0
        for features, labels in pages:

            def path(labels, features=features):
                own = sum(weights[name] for names, label in zip(features, labels, strict=True) if label for name in names)
                return own + start[int(labels[0])] + sum(link[int(a), int(b)] for a, b in itertools.pairwise(labels))

            total += path(labels) - np.logaddexp.reduce([path(one) for one in itertools.product([0, 1], repeat=len(labels))])
        pull = sum(w * w for w in weights.values()) + (link**2).sum() + (start**2).sum()
        return total / len(pages) - main_text._PULL / 2 * pull

    here = value(field.weights, field.link, field.start)
    for step in (-0.3, 0.3):
        for name in field.weights:
            assert value({**field.weights, name: field.weights[name] + step}, field.link, field.start) < here
        for at in np.ndindex(2, 2):
            moved = field.link.copy()
            moved[at] += step
            assert value(field.weights, moved, field.start) < here


def test_every_match_of_a_telling_pattern_passes_its_gate():
    """Of each alternative, with and without its optional parts, and of random texts of the gates' words."""
    r = random.Random(7)
    words = [word for gate in main_text.GATES.values() for word in gate] + ["s", "ement", "re", "aire", "comment", "log", "in", "up", "sign", "reads"]
    for name, pattern in main_text.TELLING.items():
        alone = 0
        for _ in range(4000):
            text = "".join(r.choice(words) + r.choice(["", " ", "."]) for _ in range(r.randint(1, 3)))
            matched = re.search(pattern, text) is not None
            alone += matched
            assert (f"says:{name}" in main_text.telling(text)) == matched, (name, text)
        assert alone
