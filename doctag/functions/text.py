"""Small Column helpers shared by the text functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character ranges, spelled so that both Java regexes and RE2 accept them.
THAI = r"\x{0E00}-\x{0E7F}"
# Every Unicode whitespace character; Java's own \s covers only ASCII.
SPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The sentence boundary token: two backslashes.
MARKER = "\\\\"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strings(values) -> Column:
    """Literal ``ARRAY<STRING>``, also for an empty list."""
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def has_thai(text: Column) -> Column:
    return text.rlike(f"[{THAI}]")
