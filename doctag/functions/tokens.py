"""Tokens and n-grams as array expressions."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field, is_dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from doctag.functions.clean import CleanOptions, clean
from doctag.functions.segment import segment_tokens
from doctag.functions.text import has_thai, let, strings

# A lemma mapping up to this many entries is a literal in the expression. A map in an
# expression is searched from end to end, so a longer mapping is looked up in batches
# outside of it, with equal results; tables are joined, see doctag.operators.lemmas.
LITERAL_LEMMAS = 500


@dataclass(frozen=True)
class TokenOptions:
    """How to turn a text into tokens.

    ``cleaner`` replaces the default cleaner, ``segmenter`` splits one Thai
    token into words; both map a Column to a Column. ``th_tokenizer`` does the
    same as a Python function from a string to a list of words. ``lemmas`` maps
    a token to its base form.
    """

    ngram: int = 3
    cleaning: CleanOptions = CleanOptions()
    stop_en: tuple[str, ...] = ()
    stop_th: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    lemmas: Mapping[str, str] = field(default_factory=dict)
    lemma_skips_z: bool = True
    cleaner: Callable[[Column], Column] | None = None
    segmenter: Callable[[Column], Column] | None = None
    th_tokenizer: Callable[[str], list[str]] | None = None


def token_record(options: TokenOptions) -> str:
    """A digest of the options; functions count by their names."""

    def plain(value):
        if is_dataclass(value):
            return plain(asdict(value))
        if isinstance(value, Mapping):
            return sorted([plain(k), plain(v)] for k, v in value.items())
        if isinstance(value, (set, frozenset)):
            return sorted(map(plain, value))
        if isinstance(value, (list, tuple)):
            return [plain(v) for v in value]
        return f"{value.__module__}.{value.__qualname__}" if callable(value) else value

    text = json.dumps({name: plain(value) for name, value in vars(options).items()}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: Column, options: TokenOptions = TokenOptions()) -> Column:
    """Cleaned words in text order, without n-grams: ``ARRAY<STRING>``."""
    cleaned = options.cleaner(text) if options.cleaner else clean(text, options.cleaning)
    return cleaned_words(cleaned, options)


def cleaned_words(cleaned: Column, options: TokenOptions = TokenOptions()) -> Column:
    """Words of a text that is clean already."""
    out = drop_words(F.split(cleaned, " "), ("",) + tuple(options.stop_en))
    out = F.transform(out, F.lower)
    if options.lemmas:
        out = lemmatize(out, options.lemmas, options.keywords, options.lemma_skips_z)
    if options.segmenter:
        out = segment(out, options.segmenter)
    if options.th_tokenizer:
        out = segment_tokens(out, options.th_tokenizer)
    if options.stop_th:
        out = drop_words(out, tuple(options.stop_th))
    return out


def drop_words(tokens: Column, stops: tuple[str, ...]) -> Column:
    """Tokens that are not in ``stops``; the comparison is case-sensitive. Long
    lists become a hash set lookup in the plan."""
    return F.filter(tokens, lambda t: ~t.isin(*stops)) if stops else tokens


def lemmatize(
    tokens: Column, lemmas: Mapping[str, str], keywords=(), skip_z: bool = True
) -> Column:
    """Base forms of the all-English tokens that are not keywords. With
    ``skip_z`` a token with a z is left alone."""
    if len(lemmas) > LITERAL_LEMMAS:
        return _lemmatize_in_batches(tokens, dict(lemmas), keywords, skip_z)
    table = F.create_map(*[F.lit(x) for pair in lemmas.items() for x in pair])

    def one(token):
        known = F.coalesce(F.element_at(table, token), token)
        return F.when(lemma_candidate(token, keywords, skip_z), known).otherwise(token)

    return F.transform(tokens, one)


def _lemmatize_in_batches(tokens: Column, lemmas: dict[str, str], keywords, skip_z: bool) -> Column:
    plain = re.compile("[A-Ya-y]*" if skip_z else "[A-Za-z]*")
    kept = frozenset(keywords)
    wanted = {t: l for t, l in lemmas.items() if plain.fullmatch(t) and t not in kept}

    @F.pandas_udf("array<string>")
    def look_up(batch: pd.Series) -> pd.Series:
        return batch.map(lambda row: None if row is None else [wanted.get(t, t) for t in row])

    return look_up(tokens)


def lemma_candidate(token: Column, keywords=(), skip_z: bool = True) -> Column:
    plain = token.rlike("^[A-Ya-y]*$" if skip_z else "^[A-Za-z]*$")
    return plain & ~token.isin(*keywords) if keywords else plain


def segment(tokens: Column, segmenter: Callable[[Column], Column]) -> Column:
    """Replace every token with Thai characters by its words, in place."""
    pieces = F.transform(
        tokens, lambda t: F.when(has_thai(t), segmenter(t)).otherwise(F.array(t))
    )
    return F.filter(F.flatten(pieces), lambda t: t != "")


def sentences(tokens: Column) -> Column:
    """Sentence strings (tokens joined by a pipe), cut at inner markers. Of two
    adjacent markers the second stays with the sentence after it."""
    return F.split(F.array_join(tokens, "|"), r"\|\\\\\|")


def ngrams_of(tokens: Column, n: int, separator: Column) -> Column:
    """All ``n``-grams of one sentence; none when it has fewer than n tokens."""
    last = F.size(tokens) - (n - 1)
    grams = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.call_function("array_join", F.slice(tokens, i, n), separator),
    )
    return F.when(last >= 1, grams).otherwise(strings([]))


def ngrams_up_to(tokens: Column, ngram: int, separator: Column) -> Column:
    """All 2-grams, 3-grams and so on of one sentence; none of more tokens than it has.
    Each n-gram is the one before, of the same start, and one token more."""

    def longer(shorter, n):
        grams = F.transform(
            F.slice(shorter, 1, F.greatest(F.size(shorter) - 1, F.lit(0))),
            lambda gram, i: F.concat(gram, separator, F.get(tokens, i + (n - 1))),
        )
        if n == ngram:
            return grams
        return let(grams, lambda g: F.concat(g, longer(g, n + 1)))

    return longer(tokens, 2)


def sentence_ngrams(sentence: Column, ngram: int) -> Column:
    """2-grams to ``ngram``-grams of a sentence string. Words are joined without
    a space when the sentence has any Thai character."""
    separator = F.when(has_thai(sentence), "").otherwise(" ")
    return let(
        F.filter(F.split(sentence, r"\|"), lambda t: t != ""),
        lambda tokens: let(separator, lambda sep: ngrams_up_to(tokens, ngram, sep)),
    )


def with_ngrams(tokens: Column, ngram: int) -> Column:
    """The tokens, then the n-grams sentence by sentence; duplicates are kept."""
    if ngram < 2:
        return tokens
    return let(
        tokens,
        lambda t: F.concat(
            t, F.flatten(F.transform(sentences(t), lambda s: sentence_ngrams(s, ngram)))
        ),
    )


def tokenize(text: Column, options: TokenOptions = TokenOptions()) -> Column:
    """Words and n-grams of ``text``: ``ARRAY<STRING>``."""
    return with_ngrams(words(text, options), options.ngram)


def token_text(tokens: Column) -> Column:
    """The tokens as one string, separated by a pipe."""
    return F.array_join(tokens, "|")


def split_token_text(text: Column) -> Column:
    """The inverse of :func:`token_text`; an empty text has one empty token."""
    return F.split(text, r"\|")


def as_terms(tokens: Column) -> Column:
    """Tokens as the counting operators see them: a document without tokens has
    one empty term, as its token text does."""
    return let(tokens, lambda t: F.when(F.size(t) == 0, strings([""])).otherwise(t))


def distinct_terms(tokens: Column) -> Column:
    return F.array_distinct(as_terms(tokens))


def term_counts(tokens: Column) -> Column:
    """``ARRAY<STRUCT<term, tf>>`` of one document, without a shuffle: the terms
    are sorted in place and each run of equal terms is measured."""

    def runs(terms):
        starts = F.filter(
            F.sequence(F.lit(1), F.size(terms)),
            lambda i: (i == 1) | (F.get(terms, i - 1) != F.get(terms, i - 2)),
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(terms, p - 1).alias("term"),
                    (F.coalesce(F.get(st, j + 1), F.size(terms) + 1) - p)
                    .cast("long")
                    .alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(as_terms(tokens)), runs)


def legacy_tokens(text: Column, options: TokenOptions) -> Column:
    """Distinct tokens of the older tokenizer: bullets are dropped, the full stop
    is a token, and n-grams exist only over runs of Thai words longer than one
    character. ``stop_th`` holds phrases cut from the text before splitting."""
    cleaned = clean(text, CleanOptions(profile="legacy", legal=options.cleaning.legal))
    if options.stop_th:
        cleaned = cut_phrases(cleaned, options.stop_th)
    kept = F.filter(
        drop_words(F.split(cleaned, " "), tuple(options.stop_en)),
        lambda t: ~t.rlike(r"^[0-9]+[).]*$"),
    )
    if options.lemmas:
        kept = lemmatize(kept, options.lemmas, options.keywords, skip_z=False)
    kept = F.flatten(
        F.transform(
            kept,
            lambda t: F.when(
                has_thai(t) & (F.length(t) > 1),
                options.segmenter(t) if options.segmenter else F.array(t),
            ).otherwise(split_merged(t, options.keywords)),
        )
    )
    return F.array_distinct(legacy_ngrams(kept, options.ngram))


def split_merged(token: Column, keywords=()) -> Column:
    """Lower-cased parts of a token, cut once at its first lower-to-upper change."""
    cut = F.regexp_replace(token, r"^(.*?[a-z])([A-Z].*)$", "$1|$2")
    parts = F.split(F.lower(cut), r"\|")
    if keywords:
        return F.when(token.isin(*keywords), F.array(F.lower(token))).otherwise(parts)
    return parts


def legacy_ngrams(tokens: Column, ngram: int) -> Column:
    """The tokens, then every run of 2 to ``ngram`` Thai words joined together."""

    def thai_word(t):
        return has_thai(t) & (F.length(t) > 1)

    def grams(tokens, n):
        last = F.size(tokens) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(
            F.filter(starts, lambda i: F.forall(F.slice(tokens, i, n), thai_word)),
            lambda i: F.array_join(F.slice(tokens, i, n), ""),
        )

    if ngram < 2:
        return tokens
    return let(tokens, lambda t: F.concat(t, *[grams(t, n) for n in range(2, ngram + 1)]))


def cut_phrases(text: Column, phrases) -> Column:
    """Stop phrases become a space, the rest of the text is kept. At one position
    the shortest phrase counts."""
    ordered = sorted((p for p in phrases if p), key=lambda p: (len(p), p))
    quoted = "|".join("\\Q" + p + "\\E" for p in ordered)
    return F.regexp_replace(text, quoted, " ") if ordered else text
