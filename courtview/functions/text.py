"""Column -> Column text functions.  All of them stay inside the JVM."""

from __future__ import annotations

import html.entities
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtview.params import PRIORITY_ORDER, PRIORITY_SHORT, PRIORITY_SHORT_DEFAULT, Rule

# Whitespace as the reference's squish sees it: tab, LF, FF, CR and every
# Unicode separator (spaces, line and paragraph separators) - not VT or NEL.
SQUISH_CLASS = r"[\t\n\f\r\p{Z}]+"
NEWLINE_RUN = r"[\r\n]+"


def _c(col: "Column | str") -> Column:
    return F.col(col) if isinstance(col, str) else col


def squish(col: "Column | str") -> Column:
    """Trim both ends and collapse every inner whitespace run to one space."""
    return F.trim(F.regexp_replace(_c(col), SQUISH_CLASS, " "))


def lower(col: "Column | str") -> Column:
    return F.lower(_c(col))


def strip_newlines(col: "Column | str") -> Column:
    """Replace each run of CR/LF by one space (the safe-export rule)."""
    return F.regexp_replace(_c(col), NEWLINE_RUN, " ")


def regex_detect(col: "Column | str", pattern: str) -> Column:
    """Unanchored regex find; NULL input gives NULL."""
    return _c(col).rlike(pattern)


# ---------------------------------------------------------------------------
# HTML entity decoding.
# Named entities come from Python's HTML 5 table (names that end in a semicolon);
# numeric entities (decimal and hex) are decoded arithmetically.  The text is
# cut at entities once, so ``&amp;lt;`` becomes ``&lt;`` and nothing is decoded
# twice.  Rows without ``&`` skip the work entirely.
# ---------------------------------------------------------------------------
ENTITY_PATTERN = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def named_entities() -> dict[str, str]:
    return {name[:-1]: text for name, text in html.entities.html5.items() if name.endswith(";")}


def _entity_map() -> Column:
    names, texts = zip(*sorted(named_entities().items()), strict=True)
    return F.map_from_arrays(F.lit(list(names)), F.lit(list(texts)))


def _code_point_char(cp: Column) -> Column:
    valid = cp.between(1, 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32"))


def html_decode(col: "Column | str") -> Column:
    s = _c(col)
    entities = _entity_map()

    def one(e: Column) -> Column:
        digits = F.regexp_replace(e, "^#[xX]?0*", "")  # the code point is tested, not the number of digits
        hex_cp = F.when(F.length(digits) <= 8, F.conv(digits, 16, 10).try_cast("bigint"))
        dec_cp = digits.try_cast("bigint")
        numeric = F.when(e.rlike("^#[xX]"), _code_point_char(hex_cp)).otherwise(_code_point_char(dec_cp))
        value = F.when(e.startswith("#"), numeric).otherwise(F.try_element_at(entities, e))
        return F.coalesce(value, F.concat(F.lit("&"), e, F.lit(";")))

    pieces = F.split(s, ENTITY_PATTERN, -1)
    found = F.regexp_extract_all(s, F.lit(ENTITY_PATTERN), 1)
    decoded = F.transform(found, one)
    joined = F.array_join(
        F.zip_with(pieces, decoded, lambda p, d: F.concat(F.coalesce(p, F.lit("")), F.coalesce(d, F.lit("")))),
        "",
    )
    return F.when(F.instr(s, "&") > 0, joined).otherwise(s)


# ---------------------------------------------------------------------------
# Rules and labels.
# ---------------------------------------------------------------------------
PATTERN_SIGNS = frozenset("\\^$.[](){}*+?")


def _found(text: Column, pattern: str) -> Column:
    """Whether ``pattern`` is found in ``text``; plain words (``recap|full season``) are looked up without a regex engine."""
    if PATTERN_SIGNS & set(pattern):
        return text.rlike(pattern)
    hit = None
    for word in pattern.split("|"):
        one = text.contains(word)
        hit = one if hit is None else hit | one
    return hit


def rules_first_match(title: "Column | str", duration: "Column | str | None", rules: Sequence[Rule],
                      default: str) -> Column:
    """One CASE WHEN: the first rule whose title or duration pattern is found wins."""
    t = _c(title)
    d = _c(duration) if duration is not None else None
    expr = None
    for label, title_pattern, duration_pattern in rules:
        cond = None
        if title_pattern:
            cond = _found(t, title_pattern)
        if duration_pattern and d is not None:
            hit = d.rlike(duration_pattern)
            cond = hit if cond is None else (cond | hit)
        if cond is None:
            continue
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def label_3way(score: "Column | str", threshold) -> Column:
    """Positive above +t, Negative below -t (strict), Neutral otherwise (NULL included)."""
    s = _c(score)
    t = F.lit(threshold)
    return (F.when(s > t, F.lit("Positive"))
            .when(s < -t, F.lit("Negative"))
            .otherwise(F.lit("Neutral")))


def recode(col: "Column | str", mapping: dict[str, str], default: str | None = None) -> Column:
    """Label -> short label; unlisted values become ``default`` (or pass through when it is None)."""
    c = _c(col)
    other = c if default is None else F.lit(default)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return other if expr is None else expr.otherwise(other)


def priority_short(col: "Column | str") -> Column:
    return recode(col, PRIORITY_SHORT, PRIORITY_SHORT_DEFAULT)


def manual_order_key(col: "Column | str", members: Sequence[str]) -> Column:
    """1-based position in a fixed member list; unlisted members get NULL (sort them last)."""
    arr = F.array(*[F.lit(m) for m in members])
    return F.nullif(F.array_position(arr, _c(col)), F.lit(0))


def priority_rank(col: "Column | str") -> Column:
    """The reference's CASE rank of monitoring priorities (unlisted -> 4)."""
    c = _c(col)
    return (F.when(c == PRIORITY_ORDER[0], 1).when(c == PRIORITY_ORDER[1], 2)
            .when(c == PRIORITY_ORDER[2], 3).otherwise(4))
