"""Word segmentation of Thai tokens.

The default works on a word list with the longest match at each position. A
segmenter of the user's own, a function from one string to a list of words, is
wrapped as an Arrow UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def word_pattern(words: Iterable[str]) -> str:
    """A pattern for the longest of ``words`` at a place. The words share their
    beginnings, so that a list of any length is a short walk from letter to letter."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        branches = [
            (letter if letter.isalnum() else f"\\x{{{ord(letter):x}}}") + pattern(below)
            for letter, below in sorted(node.items())
            if letter
        ]
        if not branches:
            return ""
        # What ends here may also go on, and the longer word is tried first.
        return "(?:" + "|".join(branches) + ")" + ("?" if "" in node else "")

    return pattern(tree)


def dictionary_segmenter(words: Iterable[str]) -> Callable[[Column], Column]:
    """Longest match over ``words``; characters in no word stand alone."""
    known = {w for w in words if w}
    if not known:
        return lambda token: F.array(token)
    pattern = f"(?s)({word_pattern(known)}|.)"
    return lambda token: F.regexp_extract_all(token, F.lit(pattern), F.lit(1))


def longest_match(words: Iterable[str]) -> Callable[[str], list[str]]:
    """The same rule as a plain function."""
    known = frozenset(w for w in words if w)
    longest = max(map(len, known), default=1)

    def split(token: str) -> list[str]:
        out, at = [], 0
        while at < len(token):
            size = next(
                (n for n in range(min(longest, len(token) - at), 1, -1) if token[at : at + n] in known),
                1,
            )
            out.append(token[at : at + size])
            at += size
        return out

    return split


def segment_tokens(tokens: Column, segmenter: Callable[[str], list[str]]) -> Column:
    """Apply a Python segmenter to the Thai tokens of ``ARRAY<STRING>``. Each
    batch asks for a distinct token only once; segment and sentence tags that
    some segmenters emit are removed and their pipes split."""

    @F.pandas_udf("array<string>")
    def run(batch: pd.Series) -> pd.Series:
        seen: dict[str, list[str]] = {}

        def pieces(token):
            if not any("฀" <= c <= "๿" for c in token):
                return [token]
            if token not in seen:
                raw = (w.replace("<u/>", "").replace("<s/>", "") for w in segmenter(token))
                seen[token] = [p for w in raw for p in w.split("|") if p]
            return seen[token]

        return batch.map(
            lambda row: None if row is None else [p for token in row for p in pieces(token)]
        )

    return run(tokens)
