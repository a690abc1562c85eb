"""License scans: ordered signature rules behind a keyword prefilter.

Texts are read as words (letters, digits and non-ASCII characters, A-Z lower-cased) joined by
one blank; rules are regular expressions over that, at word borders. A rule runs only on
texts that hold its keyword, which is part of whatever the rule matches. Of two detections,
one that lies inside the other's words goes if it has the lower priority, or the same priority
and fewer characters, or else a later rule.
What is left names the labels. The three base phrases are counted apart and always stay.

Defined cases: a null or text without words has no labels and scores 0; repeated rows are
scanned each; an empty table gives an empty result. Overlapping places of a phrase all count.

Scale: one narrow pass where the documents are read, no shuffle, nothing but a row in memory.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fieldnorm.llm.words import LOWER, slices, text_bytes, tidy, words_of

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Families as (label, keyword, name as a pattern, address, versions).
FAMILIES = [
    ("apache", "apache", "apache(?: software)?(?: public)?(?: license)?", "apache org licenses license", ["1 0", "1 1", "2 0"]),
    ("agpl", "affero", "(?:gnu )?affero (?:general public license|gpl)", "gnu org licenses agpl", ["1 0", "3 0", "3"]),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public license", "gnu org licenses lgpl", ["2 1", "3 0", "3"]),
    ("lgpl", "library general", "(?:gnu )?library general public license", "gnu org licenses old licenses lgpl", ["2 0", "2"]),
    ("gpl", "general public", "(?:gnu )?general public license", "gnu org licenses gpl", ["1 0", "2 0", "3 0", "1", "2", "3"]),
    ("gfdl", "free documentation", "(?:gnu )?free documentation license", "gnu org licenses fdl", ["1 1", "1 2", "1 3"]),
    ("mpl", "mozilla", "mozilla public license", "mozilla org mpl", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", "eclipse public license", "eclipse org legal epl", ["1 0", "2 0"]),
    ("cddl", "development and distribution", "common development and distribution license", "opensource org licenses cddl", ["1 0", "1 1"]),
    ("eupl", "european union", "european union public licen[cs]e", "joinup ec europa eu eupl", ["1 0", "1 1", "1 2"]),
    ("cpl", "common public", "common public license", "opensource org licenses cpl", ["0 5", "1 0"]),
    ("artistic", "artistic", "(?:perl )?artistic license", "perlfoundation org artistic license", ["1 0", "2 0"]),
    ("bsl", "boost", "boost software license", "boost org license", ["1 0"]),
    ("afl", "academic free", "academic free license", "opensource org licenses afl", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("osl", "open software", "open software license", "opensource org licenses osl", ["1 0", "1 1", "2 0", "2 1", "3 0"]),
    ("cecill", "cecill", "cecill(?: free software license)?", "cecill info licences licence cecill", ["1 0", "1 1", "2 0", "2 1"]),
    ("ofl", "open font", "(?:sil )?open font license", "scripts sil org ofl", ["1 0", "1 1"]),
    ("ms-pl", "microsoft public", "microsoft public license", "opensource org licenses ms pl", ["1 0"]),
    ("odbl", "open database", "open (?:data commons )?open database license|open database license", "opendatacommons org licenses odbl", ["1 0"]),
    ("odc-by", "open data commons", "open data commons attribution license", "opendatacommons org licenses by", ["1 0"]),
    ("psf", "python software", "python software foundation license", "docs python org license", ["2"]),
    ("php", "php license", "php license", "php net license", ["3 0", "3 01"]),
    ("zpl", "zope", "zope public license", "zope org resources zpl", ["1 1", "2 0", "2 1"]),
    ("qpl", "q public", "q public license", "opensource org licenses qpl", ["1 0"]),
    ("lppl", "latex project", "latex project public license", "latex project org lppl", ["1 0", "1 1", "1 2", "1 3", "1 3c"]),
    ("ipl", "ibm public", "ibm public license", "opensource org licenses ipl", ["1 0"]),
    ("cc-by-nc-nd", "deriv", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?", "creativecommons org licenses by nc nd", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "share", "attribution non ?commercial share ?alike", "creativecommons org licenses by nc sa", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "commercial", "attribution non ?commercial", "creativecommons org licenses by nc", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "deriv", "attribution no ?deriv(?:ative)?s?(?: works)?", "creativecommons org licenses by nd", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "share", "attribution share ?alike", "creativecommons org licenses by sa", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "attribution", "creative commons attribution", "creativecommons org licenses by", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
]

#: Short names that stand with a version, as (label, short name, versions).
SHORT_NAMES = [
    ("agpl", "agpl", ["1 0", "3 0", "3"]),
    ("lgpl", "lgpl", ["2 0", "2 1", "3 0", "2", "3"]),
    ("gpl", "gpl", ["1 0", "2 0", "3 0", "1", "2", "3"]),
    ("gfdl", "gfdl", ["1 1", "1 2", "1 3"]),
    ("mpl", "mpl", ["1 0", "1 1", "2 0", "2"]),
    ("epl", "epl", ["1 0", "2 0"]),
    ("cddl", "cddl", ["1 0", "1 1"]),
    ("eupl", "eupl", ["1 0", "1 1", "1 2"]),
    ("bsl", "bsl", ["1 0"]),
    ("afl", "afl", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("osl", "osl", ["1 0", "1 1", "2 0", "2 1", "3 0"]),
    ("ofl", "ofl", ["1 0", "1 1"]),
    ("lppl", "lppl", ["1 0", "1 1", "1 2", "1 3", "1 3c"]),
    ("zpl", "zpl", ["1 1", "2 0", "2 1"]),
    ("odbl", "odbl", ["1 0"]),
    ("sspl", "sspl", ["1"]),
]

#: Families whose version is often followed by "or later".
OR_LATER = ("agpl", "lgpl", "gpl")

#: Families whose bare name is an everyday word, told by other rules.
EVERYDAY = ("apache",)

#: Short forms of the Creative Commons family, after "cc ".
CC_SHORT = ["by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by", "zero", "0"]

#: Single signatures as (label, keyword, pattern, priority, weight).
SIGNATURES = [
    ("mit", "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software", 95, 0.99),
    ("mit", "mit license", "(?:the )?mit license", 70, 0.8),
    ("mit", "mit licensed", "mit licensed", 65, 0.7),
    ("mit", "mit licence", "(?:the )?mit licence", 70, 0.8),
    ("x11", "x11 license", "x11 license", 75, 0.8),
    ("bsd-2-clause", "redistributions", "redistributions of source code must retain the above copyright notice.{0,400}?redistributions in binary form must reproduce", 92, 0.95),
    ("bsd-3-clause", "endorse or promote", "neither the name of .{1,120}? may be used to endorse or promote products", 94, 0.97),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display", 96, 0.97),
    ("bsd", "bsd license", "(?:(?:new|modified|simplified|revised|original) )?bsd license", 70, 0.8),
    ("bsd-3-clause", "bsd 3 clause", "bsd 3 clause(?: license)?", 80, 0.9),
    ("bsd-2-clause", "bsd 2 clause", "bsd 2 clause(?: license)?", 80, 0.9),
    ("bsd-3-clause", "clause bsd", "(?:3|three) clause bsd(?: license)?", 80, 0.9),
    ("bsd-2-clause", "clause bsd", "(?:2|two) clause bsd(?: license)?", 80, 0.9),
    ("0bsd", "zero clause", "zero clause bsd(?: license)?", 85, 0.9),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee", 95, 0.97),
    ("isc", "isc license", "(?:the )?isc license", 70, 0.8),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such", 93, 0.95),
    ("zlib", "zlib", "zlib(?: libpng)? license", 70, 0.8),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain", 95, 0.98),
    ("unlicense", "the unlicense", "the unlicense", 70, 0.8),
    ("wtfpl", "what the fuck", "do what the fuck you want to public license", 90, 0.97),
    ("wtfpl", "wtfpl", "wtfpl", 60, 0.7),
    ("beerware", "beer ware", "the beer ware license", 90, 0.9),
    ("cc0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", 82, 0.9),
    ("cc0", "publicdomain zero", "creativecommons org publicdomain zero 1 0", 90, 0.95),
    ("pdm", "publicdomain mark", "creativecommons org publicdomain mark 1 0", 90, 0.95),
    ("public-domain", "public domain", "(?:released|placed|dedicated|is|are) (?:in|into|to)(?: the)? public domain", 60, 0.8),
    ("public-domain", "public domain", "(?:the )?public domain", 40, 0.5),
    ("gpl-or-later", "any later version", "either version (?:2|3) of the license or (?:at your option )?any later version", 85, 0.95),
    ("gpl", "gnu gpl", "(?:the )?gnu gpl(?: ?v? ?(?:1|2|3))?(?: 0)?", 72, 0.85),
    ("gpl", "gplv", "gplv(?:1|2|3)", 72, 0.85),
    ("lgpl", "lgplv", "lgplv(?:2|2 1|3)", 73, 0.85),
    ("agpl", "agplv", "agplv3", 74, 0.85),
    ("free-software", "free software", "this (?:program|library) is free software", 50, 0.6),
    ("apache", "apache", "apache (?:software |public )?licen[cs]e", 60, 0.8),
    ("apache", "agreements", "licensed to the apache software foundation asf under one or more contributor license agreements", 92, 0.97),
    ("apache", "applicable law or agreed", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 91, 0.95),
    ("mit", "this permission notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 90, 0.9),
    ("mit-0", "mit no attribution", "mit no attribution(?: license)?", 85, 0.9),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms(?: with or without modification are permitted)?", 88, 0.9),
    ("bsd-3-clause-clear", "clear bsd", "(?:the )?clear bsd license", 85, 0.9),
    ("bsl", "any person or organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", 95, 0.97),
    ("gpl-family", "in the hope that it will be useful", "is distributed in the hope that it will be useful but without any warranty", 60, 0.7),
    ("gpl-family", "redistribute it and or modify", "you can redistribute it and or modify it under the terms of the gnu", 65, 0.8),
    ("perl", "same terms as perl", "under the same terms as perl(?: itself)?", 85, 0.9),
    ("mpl", "source code form", "this source code form is subject to the terms of the mozilla public license", 88, 0.95),
    ("mpl", "contents of this file are subject", "the contents of this file are subject to the mozilla public license", 88, 0.95),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse", 85, 0.95),
    ("unlicense", "anyone is free to copy", "anyone is free to copy modify publish use compile sell or distribute this software", 94, 0.95),
    ("ofl", "font software", "this font software is licensed under the sil open font license", 88, 0.95),
    ("cc0", "waived all copyright", "has waived all copyright and related or neighboring rights", 88, 0.95),
    ("creative-commons", "creative commons", "this work is licensed under a creative commons", 50, 0.8),
    ("postgresql", "without a written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", 94, 0.95),
    ("postgresql", "postgresql license", "(?:the )?postgresql license", 70, 0.8),
    ("ncsa", "ncsa open source", "(?:university of illinois )?ncsa open source license", 85, 0.9),
    ("openssl", "openssl", "this product includes software developed by the openssl project", 88, 0.9),
    ("json", "good not evil", "the software shall be used for good not evil", 94, 0.95),
    ("w3c", "w3c software", "w3c software (?:and document )?(?:notice and )?license", 80, 0.9),
    ("unicode", "unicode license", "unicode license(?: agreement)?", 75, 0.8),
    ("upl", "universal permissive", "universal permissive license", 80, 0.9),
    ("blueoak", "blue oak", "blue oak model license", 85, 0.9),
    ("mulan", "mulan", "mulan (?:permissive software license|psl)", 80, 0.9),
    ("vim", "vim license", "(?:the )?vim license", 75, 0.8),
    ("ruby", "ruby license", "(?:the )?ruby license", 70, 0.7),
    ("openldap", "openldap public", "openldap public license", 80, 0.9),
    ("cpal", "common public attribution", "common public attribution license", 82, 0.9),
    ("rpl", "reciprocal public", "reciprocal public license", 80, 0.9),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal license", 80, 0.9),
    ("sspl", "server side public", "server side public license", 82, 0.95),
    ("busl", "business source", "business source license(?: 1 1)?", 82, 0.95),
    ("elastic", "elastic license", "elastic license(?: 2 0)?", 78, 0.85),
    ("commons-clause", "commons clause", "commons clause(?: license condition)?", 80, 0.9),
    ("polyform", "polyform", "polyform (?:noncommercial|shield|strict|small business|perimeter)(?: license)?", 82, 0.95),
    ("openrail", "openrail", "(?:creativeml |bigscience |bigcode )?openrail(?: ?m)?(?: license)?", 75, 0.85),
    ("hippocratic", "hippocratic", "hippocratic license", 80, 0.9),
    ("pddl", "public domain dedication", "public domain dedication and license", 82, 0.9),
    ("cc0", "public domain dedication", "cc0 public domain dedication", 84, 0.95),
    ("reserved-some", "some rights reserved", "some rights reserved", 45, 0.6),
    ("reserved-none", "no rights reserved", "no rights reserved", 45, 0.6),
    ("apache", "you may not use this file", "you may not use this file except in compliance with the license", 90, 0.95),
    ("warranty-disclaimer", "as is", "provided (?:by .{1,60}? )?as is(?: and)?(?: without| any)", 30, 0.3),
    ("creative-commons", "creative commons", "creative commons(?: license)?", 45, 0.6),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", 60, 0.8),
    ("proprietary", "unauthorized", "unauthorized (?:copying|reproduction|distribution|use) .{0,80}?(?:strictly )?prohibited", 62, 0.8),
    ("proprietary", "end user", "end user license agreement", 60, 0.7),
    ("proprietary", "not be reproduced", "(?:may|must|shall) not be reproduced .{0,80}?without .{0,40}?permission", 62, 0.8),
    ("no-commercial", "commercial use", "for non ?commercial use only", 55, 0.6),
    ("copyright", "copyright", "copyright (?:c )?(?:by )?(?:19|20)[0-9]{2}", 20, 0.3),
    ("copyright", "copyrighted", "copyrighted (?:material|work|by)", 20, 0.3),
]

#: Forms in which a family's name and version appear: (pattern, priority, weight); {n} name, {v} version, {a} address.
FORMS = [
    ("(?:licensed|released|distributed|available|published|provided) under (?:a |the )?(?:terms of (?:a |the )?)?{n}(?: license)?(?: version| v)? ?{v}", 90, 0.98),
    ("{n}(?: license)?(?: version| v)? ?{v}", 80, 0.95),
    ("{a} {v}", 85, 0.97),
]


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int
    weight: float


def _rule(label: str, keyword: str, pattern: str, priority: int, weight: float) -> Rule:
    return Rule(label, keyword, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])"), priority, weight)


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules in order: each family's forms with and without version, short names and forms, single signatures."""
    out = []
    for label, keyword, name, address, versions in FAMILIES:
        for form, priority, weight in FORMS:
            needed = keyword if "{n}" in form else address.split(" org ")[0].split(" ")[0]
            for version in versions:
                full = f"{label}-{version.replace(' ', '.')}"
                out.append(_rule(full, needed, form.format(n=f"(?:{name})", v=version, a=address), priority, weight))
        if label not in EVERYDAY:
            out.append(_rule(label, keyword, name, 60, 0.8))
        out.append(_rule(label, "spdx license", f"spdx license identifier {label.replace('-', ' ')}(?: [0-9]+)*(?: only| or later)?", 99, 0.99))
    for label, short, versions in SHORT_NAMES:
        for version in versions:
            full, name = f"{label}-{version.replace(' ', '.')}", rf"(?:gnu )?{short}(?: licen[cs]e)?(?: version)? ?v?{version}"
            out.append(_rule(full, short, name, 80, 0.9))
            if label in OR_LATER:
                out.append(_rule(f"{full}-or-later", short, f"{name} or (?:any )?later(?: version)?", 82, 0.95))
    for short in CC_SHORT:
        label = "cc0" if short in ("zero", "0") else f"cc-{short.replace(' ', '-')}"
        out.append(_rule(label, f"cc {short}", f"cc {short}", 70 + len(short), 0.9))
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            out.append(_rule(f"{label}-{version.replace(' ', '.')}", f"cc {short}", f"cc {short} {version}", 75 + len(short), 0.97))
    out.extend(_rule(*signature) for signature in SIGNATURES)
    return tuple(out)


@functools.cache
def _by_keyword() -> dict[str, list[tuple[int, Rule]]]:
    out: dict[str, list[tuple[int, Rule]]] = {}
    for order, rule in enumerate(rules()):
        out.setdefault(rule.keyword, []).append((order, rule))
    return out


def _detections(text: str) -> list[tuple[int, int, Rule]]:
    """Places (in characters) of what the rules find, without those inside a better one."""
    found = []
    for keyword, own in _by_keyword().items():
        if keyword in text:
            for order, rule in own:
                found += [(m.start(), m.end(), order, rule) for m in rule.pattern.finditer(text)]
    # Better ones first; a place that starts later can only lie inside one that reaches as far.
    found.sort(key=lambda x: (-x[3].priority, x[0] - x[1], x[2], x[0]))
    kept: list[tuple[int, int, Rule]] = []
    by_start: dict[int, int] = {}
    reach = _Reach(len(text))
    for start, end, _, rule in found:
        if reach.most(start) < end:
            kept.append((start, end, rule))
            if by_start.get(start, -1) < end:
                by_start[start] = end
                reach.put(start, end)
    return kept


class _Reach:
    """The farthest end among places put so far that start at or before a position."""

    def __init__(self, size: int):
        self.size, self.tree = size + 1, {}

    def put(self, start: int, end: int) -> None:
        at = start + 1
        while at <= self.size:
            if self.tree.get(at, -1) < end:
                self.tree[at] = end
            at += at & -at

    def most(self, start: int) -> int:
        at, out = start + 1, -1
        while at:
            out = max(out, self.tree.get(at, -1))
            at -= at & -at
        return out


def _places(text: str, phrase: str) -> list[int]:
    """Where a phrase's words stand in the text, in characters."""
    out, at = [], text.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or text[at - 1] == " ") and (end == len(text) or text[end] == " "):
            out.append(at)
        at = text.find(phrase, at + 1)
    return out


_SCANNED = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField(name, T.StringType()) for name in ("base_labels", "labels")]
    + [T.StructField("score", T.DoubleType())]
)


def scan_text(text: str) -> tuple[int, int | None, int | None, str, str, float]:
    """What one normalised text holds: n_base, first_word, last_word, base_labels, labels, score."""
    base = {phrase: places for phrase in BASE if (places := _places(text, phrase))}
    starts = sorted(at for places in base.values() for at in places)
    detections = _detections(text)
    own = {BASE[phrase] for phrase in base}
    labels = own | {rule.label for _, _, rule in detections}
    doubt = 1.0
    for label in sorted(labels):
        doubt *= 1 - max([0.5 * (label in own), *(rule.weight for _, _, rule in detections if rule.label == label)])
    first, last = (text.count(" ", 0, at) for at in (starts[0], starts[-1])) if starts else (None, None)
    return len(starts), first, last, ",".join(sorted(own)), ",".join(sorted(labels)), 1 - doubt


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    schema = T.StructType([docs.schema["doc_id"], *_SCANNED.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.where(words_mask(), LOWER, np.uint8(0x20)).astype(np.uint8).tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                data, row = text_bytes(part.column("text"))
                flat, n_words, out = data.tobytes().translate(table), [], []
                for at, to in zip(row[:-1].tolist(), row[1:].tolist(), strict=True):
                    words = flat[at:to].split()
                    n_words.append(len(words))
                    out.append(scan_text(b" ".join(words).decode()))
                columns = [pa.array(n_words, pa.int64())]
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64()]
                columns += [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(tidy(scan), schema)


def words_mask() -> np.ndarray:
    """Which bytes belong to words."""
    every = pa.array([bytes([byte]).decode("latin-1") for byte in range(128)])
    inside = np.ones(256, bool)
    inside[:128] = np.diff(words_of(every, signs=True, lower=False, hashes=False).first) > 0
    return inside
