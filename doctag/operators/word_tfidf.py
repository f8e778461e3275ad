"""TF-IDF over stored words, whose n-grams are never made as a whole.

A row has its words as one text, and its terms are those of
:func:`doctag.functions.tokens.with_ngrams`. An n-gram is in at most as many documents as the
shorter ones it is made of. So the words are counted first, and n-grams then length by length:
a pass counts only those whose two parts of one word less reach the lower limit. Words are
numbers in these passes, and an n-gram is the number of its beginning and that of its last word.

Sentences with Thai letters are joined without a space, so that an n-gram may spell another
one or a word. Their n-grams are made and counted as the words are. All others have a space
and can be no word, nor another n-gram.

The frequent terms are at most as many as the terms of a document divided by the lower limit as
a share; they are sent along with every task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.functions.text import has_thai
from doctag.functions.tokens import sentence_ngrams, sentences, split_token_text
from doctag.operators.tfidf import MIN_SHARE, FittedTfidf, _between, _limit, frequent_document_frequency, smooth_idf
from doctag.session import by_key, durable

MARK = "|\\\\|"
# Stands for an end of a sentence among its words; cleaned words have no such character.
END = "\x00"
# A token that is no term: a word has no space, and an n-gram neither begins nor ends with one.
NO_TERM = " "
# Counted n-grams that a task holds.
HELD = 1 << 20
_THAI = re.compile("[฀-๿]")


def unspaced_terms(text: Column, ngram: int) -> Column:
    """The words, and the n-grams of sentences with Thai letters."""
    words = split_token_text(text)
    thai = F.filter(sentences(words), has_thai)
    if ngram < 2:
        return words
    joined = F.flatten(F.transform(thai, lambda s: sentence_ngrams(s, ngram)))
    return F.when(has_thai(text), F.concat(words, joined)).otherwise(words)


def _spaced_texts(texts: pa.Array) -> pa.Array:
    """Texts with the ends of sentences as words, without the sentences that have Thai letters."""
    thai = pc.match_substring_regex(texts, "[฀-๿]")
    out = pc.replace_substring(texts, MARK, f"|{END}|")
    if pc.any(thai).as_py():
        own = [f"|{END}|".join(END if _THAI.search(s) else s for s in t.split(MARK)) if x else None for t, x in zip(texts.to_pylist(), thai.to_pylist())]
        out = pc.if_else(pc.fill_null(thai, False), pa.array(own, out.type), out)
    return out


def _ids(texts: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row of each word of texts and its number, -1 for an end or a word that is not listed."""
    lists = pc.split_pattern(pc.fill_null(_spaced_texts(texts), ""), "|")
    flat = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    ids = pc.fill_null(pc.index_in(flat, value_set=words), -1).to_numpy(zero_copy_only=False).astype("int64")
    some = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    return (rows, ids) if some.all() else (rows[some], ids[some])


def _found(codes: np.ndarray, wanted: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The places of ``wanted`` in sorted codes, -1 where there is none or ``where`` is false."""
    out = np.full(len(wanted), -1)
    if len(codes):
        at = np.searchsorted(codes, wanted[where]).clip(max=len(codes) - 1)
        out[where] = np.where(codes[at] == wanted[where], at, -1)
    return out


def _step(rows: np.ndarray, ids: np.ndarray, nodes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For n-grams of each start whose beginnings are ``nodes``: the numbers of their last
    words, and whether there are both."""
    last = np.full(len(ids), -1)
    if len(ids) >= n:
        k = n - 1
        last[:-k] = np.where(rows[:-k] == rows[k:], ids[k:], -1)
    return last, (nodes >= 0) & (last >= 0)


def _frequent_ngrams(ids: DataFrame, ngrams: list[int], words: list[list[str]], low: list[float]) -> list[tuple[int, str, int]]:
    """``field, term, df`` of the n-grams that reach the lower limit of their field."""
    sc = ids.sparkSession.sparkContext
    codes: list[list[np.ndarray]] = [[] for _ in ngrams]
    terms = [list(w) for w in words]
    out = []
    for n in range(2, max(ngrams) + 1):
        open_ = [i for i, last in enumerate(ngrams) if n <= last and terms[i]]
        if not open_:
            break
        shared = sc.broadcast((n, open_, [len(w) for w in words], codes))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, open_, sizes, codes = shared.value
            held: dict[int, list] = {i: [] for i in open_}

            def rows_of(i):
                each, places = np.unique(np.concatenate([c for c, _ in held[i]]), return_inverse=True)
                sums = np.bincount(places, np.concatenate([k for _, k in held[i]])).astype("int64")
                held[i] = []
                return pa.RecordBatch.from_pydict({"field": pa.array(np.full(len(each), i), pa.int32()), "code": each, "n": sums})

            for batch in batches:
                for i in open_:
                    lists = batch.column(i)
                    ids = lists.flatten().to_numpy(zero_copy_only=False).astype("int64")
                    rows = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                    nodes = ids
                    for k, known in enumerate(codes[i], 2):
                        last, both = _step(rows, ids, nodes, k)
                        nodes = _found(known, nodes * sizes[i] + last, both)
                    last, both = _step(rows, ids, nodes, n)
                    # The n-gram without its first word must be frequent too.
                    both[:-1] &= nodes[1:] >= 0
                    grams = np.stack([rows[both], (nodes * sizes[i] + last)[both]])
                    if grams.size:
                        order = np.lexsort(grams[::-1])
                        grams = grams[:, order]
                        first = np.append(True, (grams[:, 1:] != grams[:, :-1]).any(0))
                        each, k = np.unique(grams[1, first], return_counts=True)
                        held[i].append((each, k))
                    if sum(len(c) for c, _ in held[i]) > HELD:
                        yield rows_of(i)
            for i in open_:
                if held[i]:
                    yield rows_of(i)

        counted = ids.mapInArrow(count, "field int, code long, n long").groupBy("field", "code").agg(F.sum("n").alias("n"))
        least = F.element_at(F.array(*[F.lit(float(x)) for x in low]), F.col("field") + 1)
        found = sorted((r.field, r.code, r.n) for r in counted.filter(F.col("n") >= least).collect())
        shared.unpersist()
        for i in range(len(ngrams)):
            mine = [(c, k) for f, c, k in found if f == i]
            codes[i].append(np.array([c for c, _ in mine], "int64"))
            size = len(words[i])
            terms[i] = [f"{terms[i][c // size]} {words[i][c % size]}" for c, _ in mine]
            out += [(i, t, k) for t, (_, k) in zip(terms[i], mine)]
    return out


def fit_words(
    df: DataFrame,
    fields: Mapping[str, tuple[str, int]],
    max_df: float | int = 1.0,
    min_df: float | int = 1,
) -> FittedTfidf:
    """:func:`doctag.operators.tfidf.fit_tfidf` of the words and n-grams of rows; ``fields`` maps
    a name to a column of words and the length of its longest n-grams. The lower limit must be
    a share of the documents that keeps the frequent terms few, see :func:`can_fit_words`."""
    n_docs, names = df.count(), list(fields)
    low = {name: _limit(n_docs, min_df) for name in names}
    rows = df.select(*[unspaced_terms(F.col(c), n).alias(name) for name, (c, n) in fields.items()])
    unspaced = durable(frequent_document_frequency(rows, {n: n for n in names}, low, n_docs).filter(F.col("df") >= low[names[0]]))
    words: dict[str, list[str]] = {name: [] for name in names}
    for r in unspaced.filter("term <> ''").select("field", "term").collect():
        words[r.field].append(r.term)
    listed = [sorted(words[name]) for name in names]
    columns = [c for c, _ in fields.values()]
    shared = df.sparkSession.sparkContext.broadcast(listed)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = [pa.array(w, pa.string()) for w in shared.value]
        for batch in batches:
            out = []
            for texts, known in zip(batch.columns, values):
                rows, ids = _ids(texts, known)
                ends = np.searchsorted(rows, np.arange(len(texts) + 1))
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(out, [f"_{i}" for i in range(len(out))])

    schema = ", ".join(f"_{i} array<int>" for i in range(len(names)))
    ids = durable(df.select(*columns).mapInArrow(number, schema), "zstd")
    spaced = _frequent_ngrams(ids, [n for _, n in fields.values()], listed, [low[n] for n in names])
    more = df.sparkSession.createDataFrame(
        pa.table({"field": pa.array([names[i] for i, _, _ in spaced], pa.string()), "term": pa.array([t for _, t, _ in spaced], pa.string()), "df": pa.array([k for _, _, k in spaced], pa.int64())})
    )
    counts = unspaced.select("field", "term", "df").unionByName(more)
    terms = durable(counts.filter(_between(n_docs, max_df, min_df)).withColumn("idf", smooth_idf(n_docs)))
    return FittedTfidf(terms, n_docs, tuple(names), {name: (max_df, min_df) for name in names})


def can_fit_words(n_docs: int, min_df: float | int) -> bool:
    """Whether the lower limit drops enough for the passes over n-grams."""
    return _limit(n_docs, min_df) >= max(MIN_SHARE * n_docs, 2)


def _thai_ngrams(text: str, ngram: int) -> list[str]:
    out = []
    for s in text.split(MARK):
        if _THAI.search(s):
            tokens = [t for t in s.split("|") if t]
            out += ["".join(tokens[i : i + n]) for n in range(2, ngram + 1) for i in range(len(tokens) - n + 1)]
    return out


def _tries(fitted: FittedTfidf, fields: Mapping[str, tuple[str, int]]) -> list:
    """For each field the terms without a space, the words of the others, the sorted numbers of
    their beginnings by length, and the terms that end there."""
    listed = {name: [] for name in fields}
    for r in fitted.terms.select("field", "term").collect():
        listed[r.field].append(r.term)
    tries = []
    for terms in listed.values():
        unspaced = sorted(t for t in terms if " " not in t)
        spaced = [t.split(" ") for t in sorted(terms) if " " in t]
        words = sorted({w for t in spaced for w in t})
        number = {w: i for i, w in enumerate(words)}
        nodes = {(w,): i for w, i in number.items()}
        codes, places = [], []
        for n in range(2, max(map(len, spaced), default=1) + 1):
            starts = {tuple(t[:n]) for t in spaced if len(t) >= n}
            level = sorted((nodes[s[:-1]] * len(words) + number[s[-1]], s) for s in starts)
            nodes = {s: i for i, (_, s) in enumerate(level)}
            codes.append(np.array([c for c, _ in level], "int64"))
            ends = {tuple(t): " ".join(t) for t in spaced if len(t) == n}
            places.append([ends.get(s) for _, s in level])
        tries.append((unspaced, words, codes, places))
    return tries


def _numbered(trie) -> list[str]:
    """The terms of a field in the order of their numbers."""
    unspaced, _, _, places = trie
    return unspaced + [t for level in places for t in level if t is not None]


class _Field:
    """Finds the terms of a field in batches of texts."""

    def __init__(self, trie, ngram: int):
        unspaced, self.words, self.codes, places = trie
        self.ngram, self.terms = ngram, _numbered(trie)
        at = {t: i for i, t in enumerate(self.terms)}
        self.unspaced = {t: at[t] for t in unspaced}
        self.listed = pa.array(unspaced, pa.string())
        self.places = [np.array([-1 if t is None else at[t] for t in level], "int64") for level in places]

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The row and the number of each occurrence of a term."""
        some = pc.fill_null(texts, "")
        lists = pc.split_pattern(some, "|")
        rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        ids = pc.fill_null(pc.index_in(lists.flatten(), value_set=self.listed), -1).to_numpy(zero_copy_only=False)
        found = [(rows[ids >= 0], ids[ids >= 0])]
        for i in np.flatnonzero(pc.match_substring_regex(some, "[฀-๿]").to_numpy(zero_copy_only=False)):
            own = [self.unspaced[t] for t in _thai_ngrams(some[i].as_py(), self.ngram) if t in self.unspaced]
            found.append((np.full(len(own), i), np.array(own, "int64")))
        rows, ids = _ids(texts, pa.array(self.words, pa.string()))
        nodes = ids
        for n, (known, place) in enumerate(zip(self.codes, self.places), 2):
            last, both = _step(rows, ids, nodes, n)
            nodes = _found(known, nodes * len(self.words) + last, both)
            hit = nodes >= 0
            index = place[nodes[hit]]
            found.append((rows[hit][index >= 0], index[index >= 0]))
        rows, index = (np.concatenate(x).astype("int64") for x in zip(*found))
        valid = pc.is_valid(texts).to_numpy(zero_copy_only=False)[rows]
        return rows[valid], index[valid]


def _offsets(rows: np.ndarray, n: int) -> pa.Array:
    return pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32())


def known_tokens(df: DataFrame, fitted: FittedTfidf, key: str, fields: Mapping[str, tuple[str, int]], out: Mapping[str, str]) -> DataFrame:
    """``key`` and the tokens of each row that are terms, as arrays named by ``out``, repeats
    included. A row with tokens of which none is a term has one that never is."""
    columns, ngrams = zip(*fields.values())
    shared = df.sparkSession.sparkContext.broadcast(_tries(fitted, fields))

    def of_field(texts: pa.Array, field: _Field, terms: pa.Array) -> pa.Array:
        rows, index = field.find(texts)
        # Rows without a term, but with tokens, which every row has that is not null.
        none = np.setdiff1d(np.arange(len(texts)), rows)
        rows, index = np.append(rows, none), np.append(index, np.full(len(none), len(terms) - 1))
        order = np.argsort(rows, kind="stable")
        lists = pa.ListArray.from_arrays(_offsets(rows[order], len(texts)), terms.take(pa.array(index[order])))
        return pc.if_else(pc.is_valid(texts), lists, pa.scalar(None, lists.type))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [_Field(trie, n) for trie, n in zip(shared.value, ngrams)]
        terms = [pa.array([*field.terms, NO_TERM], pa.string()) for field in made]
        for batch in batches:
            lists = list(map(of_field, batch.columns[1:], made, terms))
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], [key, *out.values()])

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"`{out[name]}` array<string>" for name in fields)
    return df.select(key, *columns).mapInArrow(keep, schema)


def weights_of_words(df: DataFrame, fitted: FittedTfidf, key: str, fields: Mapping[str, tuple[str, int]]) -> DataFrame:
    """:func:`doctag.operators.tfidf.transform_tfidf` of stored words, hashed by the key. A row
    is moved as the numbers of its terms and their counts, and has one sum of squares a field;
    as there, rows of one key are brought to unit length together."""
    names, columns, ngrams = list(fields), *zip(*fields.values())
    spark = df.sparkSession
    tries = _tries(fitted, fields)
    idf = {(r.field, r.term): r.idf for r in fitted.terms.select("field", "term", "idf").collect()}
    rows = [(name, t, idf[name, t]) for name, trie in zip(names, tries) for t in _numbered(trie)]
    scale = np.array([x for *_, x in rows], "float64")
    terms = spark.createDataFrame(
        pa.table({
            "_term": pa.array(np.arange(len(rows)), pa.int32()), "field": pa.array([f for f, *_ in rows], pa.string()),
            "term": pa.array([t for _, t, _ in rows], pa.string()), "idf": pa.array(scale),
        })
    )
    shared = spark.sparkContext.broadcast((tries, scale))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries, scale = shared.value
        made = [_Field(trie, n) for trie, n in zip(tries, ngrams)]
        firsts = np.cumsum([0, *[len(field.terms) for field in made]])
        for batch in batches:
            n = batch.num_rows
            # As in term_frequency, a row without one of its texts has no terms.
            whole = np.logical_and.reduce([pc.is_valid(c).to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            found = [(r, i + first) for (r, i), first in zip(map(_Field.find, made, batch.columns[1:]), firsts)]
            rows, index = (np.concatenate(x) for x in zip(*found))
            size = max(len(scale), 1)
            each, tf = np.unique((rows * size + index)[whole[rows]], return_counts=True)
            rows, index = each // size, each % size
            squares = (tf * scale[index]) ** 2 if len(each) else np.zeros(0)
            sums = [np.bincount(rows[own], squares[own], n) for own in ((index >= a) & (index < b) for a, b in zip(firsts, firsts[1:]))]
            offsets = _offsets(rows, n)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (index, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists, *map(pa.array, sums)], [key, "_terms", "_tf", *squared])

    squared = [f"_square{i}" for i in range(len(names))]
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, _terms array<int>, _tf array<int>, " + ", ".join(f"{x} double" for x in squared)
    counted = by_key(df.select(key, *columns).mapInArrow(count, schema), key)
    norms = [F.sqrt(F.sum(x).over(W.partitionBy(key))).alias(x) for x in squared]
    normed = counted.select(key, "_terms", "_tf", *norms)
    each = normed.select(key, *squared, F.inline_outer(F.arrays_zip("_terms", "_tf")))
    norm = F.coalesce(*[F.when(F.col("field") == name, F.col(x)) for name, x in zip(names, squared)])
    weight = F.col("_tf").cast("long") * F.col("idf") / norm
    return each.join(F.broadcast(terms), F.col("_terms") == F.col("_term")).select(key, "field", "term", weight.alias("weight"))
