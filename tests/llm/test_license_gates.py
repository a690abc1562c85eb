"""No license rule is kept from a text it matches: its keyword is in every form of its pattern."""

import re._parser as parser

import pytest

from fieldnorm.llm import licenses


def forms(tree):
    """Texts that a parsed pattern matches: every branch, every character of a class, fewest repeats and one more."""
    out = [""]
    for op, arg in tree:
        match str(op):
            case "LITERAL":
                own = [chr(arg)]
            case "IN":
                own = [chr(value if str(kind) == "LITERAL" else value[0]) for kind, value in arg]
            case "ANY":
                own = ["x"]
            case "SUBPATTERN":
                own = forms(arg[-1])
            case "BRANCH":
                own = [text for branch in arg[1] for text in forms(branch)]
            case "MAX_REPEAT" | "MIN_REPEAT":
                own = [text * n for text in forms(arg[2]) for n in {arg[0], min(arg[1], arg[0] + 1)}]
            case "ASSERT_NOT":
                own = [""]
        out = [a + b for a in out for b in dict.fromkeys(own)]
    return out


def test_keywords_are_in_all_forms():
    for rule in licenses.rules():
        whole = [text for text in forms(parser.parse(rule.pattern.pattern)) if rule.pattern.fullmatch(text)]
        assert whole and all(rule.keyword in text for text in whole), (rule.label, rule.keyword)


@pytest.mark.parametrize(
    "text, labels",
    [
        ("attribution noncommercial no derivative works 3 0", "cc-by-nc-nd-3.0"),
        ("attribution non commercial noderivs", "cc-by-nc-nd"),
        ("the zlib libpng license", "zlib"),
        ("for noncommercial use only", "no-commercial"),
    ],
)
def test_optional_forms_pass_the_gate(text, labels):
    assert licenses.scan_text(text)[4] == labels
