"""License rules on phrases, and the suppression of overlapping detections against plain comparison of all pairs."""

import random

import pytest

from fieldnorm.llm import licenses


@pytest.mark.parametrize(
    "text, labels",
    [
        ("under gpl 2", "gpl-2"),
        ("gnu gpl v2 or later", "gpl-2-or-later"),
        ("gpl version 3 0", "gpl-3.0"),
        ("lgpl 2 1 only", "lgpl-2.1"),
        ("agplv3", "agpl-3"),
        ("mpl 2 0", "mpl-2.0"),
        ("redistribution and use in source and binary forms", "bsd"),
        ("the apache helicopter landed", ""),
        ("apache 2 0", "apache-2.0"),
        ("the apache software license", "apache"),
        ("the blue oak model license", "blueoak"),
        ("the ample 2 0 sampling gpl", ""),
        ("the server side public license", "sspl"),
        ("", ""),
    ],
)
def test_labels(text, labels):
    assert licenses.scan_text(text)[4] == labels


def plain(text):
    """All detections of all rules without keywords, each one compared with each other."""
    found = [(m.start(), m.end(), k, rule) for k, rule in enumerate(licenses.rules()) for m in rule.pattern.finditer(text)]

    def beaten(a, b):
        inside = b[0] <= a[0] and a[1] <= b[1]
        return inside and (b[3].priority, b[1] - b[0], -b[2], -b[0]) > (a[3].priority, a[1] - a[0], -a[2], -a[0])

    return sorted((a[0], a[1], a[3].label) for a in found if not any(beaten(a, b) for b in found))


@pytest.mark.parametrize("seed", range(12))
def test_suppression_against_all_pairs(seed):
    r = random.Random(seed)
    phrases = [
        "gnu general public license version 3", "gpl 2 0 or any later version", "cc by nc sa 4 0", "creative commons attribution share alike 4 0",
        "licensed under the apache license version 2 0", "the mit license", "new bsd license", "affero gpl", "spdx license identifier mpl 2 0",
        "public domain", "copyright c 2019", "as is without", "word", "license", "version 2", "all rights reserved",
    ]
    text = " ".join(r.choice(phrases) for _ in range(60))
    assert sorted((a, b, rule.label) for a, b, rule in licenses._detections(text)) == plain(text)
