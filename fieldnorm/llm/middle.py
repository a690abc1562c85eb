r"""Fill-in-the-middle by regular expressions with counted quantifiers.

A text is ``n`` units, counted by ``regexp_count``. Two cuts ``a <= b`` come from a hash of
the document's id. One pattern for each row, ``\A(unit{a}+)(unit{b-a}+)(.*)\z``, possessive so
that it never steps back, captures prefix, middle and suffix in a single match, and that match
is replaced by the groups in their new order between the markers. The way back is one match
too: a marker cannot occur in what stands before it, since texts that hold one stay plain.

A unit is by default one code point; another pattern (``(?s:.{4})``, a word with the blanks
behind it) must match from where the last unit ended, and what the last unit leaves at the end
of a text belongs to the suffix. It may not have capturing groups, nor match nothing.

Counting builds an array of all matches, so units are counted in runs of ``RUN`` first and
singly only in what remains: one array entry for ``RUN`` units.

Defined cases: a null or empty text has no units and stays plain; a null id is hashed as no
digits; repeated rows get the same cuts, as cuts depend on id and n alone; cuts may coincide
with each other or with an end (empty parts); very long texts are matched whole, the matcher
runs in loops and not in recursion; an empty table gives an empty result; columns named like
those added are replaced.

Scale: every step is a column function on one row: no shuffle, no Python, nothing held.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnorm.llm.decontaminate import free_name

CODE_POINT = "(?s:.)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RUN = 256


def _literal(marker: str) -> str:
    return rf"\Q{marker}\E"


def count_units(text: Column, unit: str = CODE_POINT) -> Column:
    """The number of units that follow one another from the beginning of a text."""
    run = f"(?:{unit}){{{RUN}}}+"
    tail = F.regexp_replace(text, rf"\A(?:{run})*+", "")
    runs = F.regexp_count(text, F.lit(rf"\G{run}"))
    return (runs.cast("long") * RUN + F.regexp_count(tail, F.lit(rf"\G(?:{unit})"))).alias("n")


def draws(seed: Column) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``1:`` and the seed."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(seed.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _replaced(text: Column, pattern: Column | str, replacement: str) -> Column:
    return F.regexp_replace(text, pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(replacement))


def fill_in_middle(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", unit: str = CODE_POINT, percent: int = 90, spm_percent: int = 20
) -> DataFrame:
    """Adds n, form (plain, psm or spm), prefix_units, middle_units (null if plain) and output.

    ``percent`` of the texts are rearranged, ``spm_percent`` of these with the suffix in front.
    """
    whole, *h = (free_name(docs, name) for name in ("whole", "h1", "h2", "h3", "h4"))
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({whole: body, "n": count_units(body, unit), **dict(zip(h, draws(F.col(doc_id)), strict=True))})
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole, F.lit(marker))
    plain = (F.col("n") == 0) | marked | (F.col(h[2]) % 100 >= percent)
    cuts = [F.col(x) % (F.col("n") + 1) for x in h[:2]]
    out = out.withColumns({"form": F.when(plain, "plain").when(F.col(h[3]) % 100 < spm_percent, "spm").otherwise("psm")})
    shown = F.col("form") != "plain"
    out = out.withColumns(
        {
            "prefix_units": F.when(shown, F.least(*cuts)),
            "middle_units": F.when(shown, F.greatest(*cuts) - F.least(*cuts)),
        }
    )
    counted = [F.format_string(f"((?:{unit.replace('%', '%%')}){{%d}}+)", F.col(x)) for x in ("prefix_units", "middle_units")]
    pattern = F.concat(F.lit(r"(?s)\A"), *counted, F.lit(r"(.*)\z"))
    psm = _replaced(F.col(whole), pattern, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    spm = _replaced(F.col(whole), pattern, f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col(whole))
    return out.withColumn("output", output).drop(whole, *h)


def restored(output: Column, form: Column) -> Column:
    """The text that was rearranged."""
    p, s, m = map(_literal, (PREFIX, SUFFIX, MIDDLE))
    psm = _replaced(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z", "$1$3$2")
    spm = _replaced(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
