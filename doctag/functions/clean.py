"""Text cleaning as one chain of built-in string expressions.

Each step is a function ``Column -> Column`` without shuffle or UDF, so a full
clean is a single narrow projection. Steps run in the order of :func:`clean`.

Three profiles exist:

* ``parity`` keeps the observable results of the classic cleaner, where the
  markers written by the bullet and full-stop steps are removed again by the
  legal-character filter and only lower-to-upper merges leave a boundary;
* ``sentence`` lets every boundary marker survive to the tokenizer;
* ``legacy`` is the older cleaner: illegal characters become spaces and the
  full stop stays as a token.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from doctag.functions.text import MARKER, SPACE, THAI, has_thai, let

# The legal characters, as first and last code point of each range.
LEGAL_RANGES = (
    (0x20, 0x20),  # space
    (0x23, 0x23),  # number sign
    (0x2B, 0x2B),  # plus
    (0x2D, 0x2E),  # hyphen, full stop
    (0x30, 0x39),  # digits
    (0x40, 0x5A),  # at sign, A to Z
    (0x61, 0x7A),  # a to z
    (0x0E01, 0x0E3A),  # Thai letters and vowels
    (0x0E3F, 0x0E5D),  # Thai currency sign, vowels, tone marks, digits
)
LEGAL = frozenset(chr(c) for first, last in LEGAL_RANGES for c in range(first, last + 1))
# Thai digits zero to nine.
THAI_DIGITS = "๐๑๒๓๔๕๖๗๘๙"
# Fixed value: the Thai repeat mark.
REPEAT_MARK = "ๆ"

# Stands for a boundary while the sentence profile filters characters.
_HOLD = "\ue000"
# SPACE again, through Java's faster Unicode property lookup.
_JAVA_SPACE = r"(?U)[\s\x1C-\x1F]"
_JAVA_MARKER = " " + MARKER.replace("\\", "\\\\") + " "


@dataclass(frozen=True)
class CleanOptions:
    """Choices of the cleaner. The switches that are off have no effect in the
    classic cleaner although it spells them out; turn them on to get the intent."""

    profile: str = "parity"
    thai_digits: bool = False
    phones: bool = False
    lower_keywords: tuple[str, ...] = ()
    legal: frozenset[str] = LEGAL

    def __post_init__(self):
        if self.profile not in ("parity", "sentence", "legacy"):
            raise ValueError(f"unknown cleaning profile {self.profile!r}")


def expand_thai_digits(text: Column) -> Column:
    """Thai digits become Arabic digits with a space on both sides."""
    return reduce(
        lambda t, pair: F.replace(t, F.lit(pair[1]), F.lit(f" {pair[0]} ")),
        enumerate(THAI_DIGITS),
        text,
    )


def blank_repeat_mark(text: Column) -> Column:
    return F.replace(text, F.lit(REPEAT_MARK), F.lit(" "))


def squeeze_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_JAVA_SPACE}+", " ")


def _where(text: Column, found: Callable[[Column], Column], step: Callable[[Column], Column]) -> Column:
    """``step`` for the texts that have what it looks for. Most have not, and a literal is
    found much faster than a pattern."""
    return let(text, lambda t: F.when(found(t), step(t)).otherwise(t))


def blank_emails(text: Column) -> Column:
    # The lookbehind and the possessive run keep this linear on long unbroken
    # runs; a leftmost match always starts where its run of characters starts.
    run = r"[a-zA-Z._\-0-9]"
    pattern = f"(?<!{run}){run}++@{run}+"
    return _where(text, lambda t: t.contains("@"), lambda t: F.regexp_replace(t, pattern, " "))


def blank_urls(text: Column) -> Column:
    pattern = rf"(https://|www[^\n])[a-zA-Z0-9]+[^\n][a-z]+[^{SPACE}]*"
    start = lambda t: t.contains("https://") | t.contains("www")
    return _where(text, start, lambda t: F.regexp_replace(t, pattern, " "))


def blank_phones(text: Column) -> Column:
    return F.regexp_replace(text, r"[0-9\-]{9,12}", " ")


def blank_dashed_phones(text: Column) -> Column:
    return F.regexp_replace(text, r"[0-9]+-[0-9]+-[0-9]+", " ")


def blank_thai_names(text: Column) -> Column:
    """An honorific, the Thai run after it and the spaces behind it."""
    pattern = rf"\x{{0E04}}\x{{0E38}}\x{{0E13}}[{SPACE}]*+[{THAI}]++[{SPACE}]++"
    honorific = lambda t: t.contains("\u0e04\u0e38\u0e13")
    return _where(text, honorific, lambda t: F.regexp_replace(t, pattern, " "))


def mark_lone_bullet(text: Column, marker: str = r" \\ ") -> Column:
    """A text that is nothing but a numbered bullet becomes a marker."""
    return F.regexp_replace(text, r"^[0-9]+[).]*$", marker)


def lower_keywords(text: Column, keywords) -> Column:
    return reduce(lambda t, k: F.regexp_replace(t, k, k.lower()), keywords, text)


def space_thai_boundaries(text: Column) -> Column:
    """A space between Thai and other characters, in either order. The pair made
    of the last two characters stays joined."""
    t, o = f"[{THAI}]", f"[^{THAI}]"

    def spaced(text: Column) -> Column:
        text = F.regexp_replace(text, f"(?s){t}(?<={o}{t})(?=.)", " $0")
        return F.regexp_replace(text, f"(?s){t}(?={o}.)", "$0 ")

    return _where(text, has_thai, spaced)


def mark_inner_bullets(text: Column, marker: str = r" \\ ") -> Column:
    """A full stop followed by a numbered bullet starts a new sentence."""
    return F.regexp_replace(text, rf"\.[0-9]+[).][{SPACE}]", marker)


def mark_full_stops(text: Column, marker: str = f" {MARKER} ") -> Column:
    return F.replace(text, F.lit("."), F.lit(marker))


def merge_markers(text: Column, mark: str = r"\\\\", marker: str = r" \\ ") -> Column:
    """Two markers at most two characters apart become one."""
    return F.regexp_replace(text, f"{mark}.{{0,2}}{mark}", marker)


def blank_entities(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&amp;"), F.lit(" ")), F.lit("&nbsp;"), F.lit(" "))


def illegal_class(legal: frozenset[str]) -> str:
    """A character class of everything outside ``legal``. It lists the ranges in
    between, because Java matches a negated union of ranges far more slowly, and the
    code points below 256 one by one, which Java looks up in one table."""
    ranges, start = [], 0
    for code in sorted(map(ord, legal)):
        if code > start:
            ranges.append((start, code - 1))
        start = code + 1
    ranges.append((start, 0x10FFFF))
    low = [code for a, b in ranges for code in range(a, min(b, 0xFF) + 1)]
    high = [(max(a, 0x100), b) for a, b in ranges if b > 0xFF]
    return "[" + "".join([rf"\x{code:02X}" for code in low] + [rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in high]) + "]"


def drop_illegal(text: Column, legal: frozenset[str] = LEGAL) -> Column:
    return F.regexp_replace(text, illegal_class(legal) + "+", "")


def blank_illegal(text: Column, legal: frozenset[str] = LEGAL) -> Column:
    return F.regexp_replace(text, illegal_class(legal), " ")


def blank_leading_garbage(text: Column) -> Column:
    return F.regexp_replace(text, r"^(-|\||\.|#{1,2})", " ")


def squeeze_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def split_merged_words(text: Column) -> Column:
    """A marker at every lower-to-upper change, as in two merged sentences."""
    # It looks for the capital, which is rarer, first.
    return F.regexp_replace(text, "[A-Z](?<=[a-z].)", f"{_JAVA_MARKER}$0")


def clean(text: Column, options: CleanOptions = CleanOptions()) -> Column:
    """The cleaned text of ``text``; sentences are separated by ``MARKER``."""
    if options.profile == "legacy":
        return _clean_legacy(text, options)
    holds = options.profile == "sentence"
    stop = f" {_HOLD} " if holds else r" \\ "
    if holds:
        text = F.replace(text, F.lit(_HOLD), F.lit(""))
    if options.thai_digits:
        text = expand_thai_digits(text)
    # The repeat mark and runs of whitespace in one pass.
    # A single space, the most common of them, is no match.
    space = r"[\s\x1C-\x1F\x{0E46}]"
    text = F.regexp_replace(text, rf"(?U){space}{{2,}}|[\s\x1C-\x1F\x{{0E46}}&&[^ ]]", " ")
    text = blank_urls(blank_emails(text))
    if options.phones:
        text = blank_phones(text)
    text = mark_lone_bullet(blank_thai_names(text), stop)
    text = lower_keywords(text, options.lower_keywords)
    text = mark_inner_bullets(space_thai_boundaries(text), stop)
    if holds:
        text = merge_markers(mark_full_stops(text, stop), _HOLD, stop)
    else:
        text = merge_markers(mark_full_stops(text))
    text = drop_illegal(blank_entities(text), options.legal | {_HOLD} if holds else options.legal)
    text = squeeze_spaces(blank_leading_garbage(text))
    if holds:
        text = F.replace(text, F.lit(_HOLD), F.lit(MARKER))
    return split_merged_words(text)


def _clean_legacy(text: Column, options: CleanOptions) -> Column:
    text = blank_urls(blank_emails(blank_repeat_mark(text)))
    text = blank_thai_names(blank_dashed_phones(text))
    text = space_thai_boundaries(text)
    text = F.regexp_replace(text, r"\.[0-9]+[).] ", " . ")
    text = F.replace(text, F.lit("."), F.lit(" . "))
    return squeeze_spaces(blank_illegal(blank_entities(text), options.legal))
