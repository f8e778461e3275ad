"""Golden rows and properties of cleaning and tokenizing."""

import random

import pytest
from pyspark.sql import functions as F

from doctag.functions import clean as C
from doctag.functions import tokens as T
from doctag.functions.segment import dictionary_segmenter, longest_match, segment_tokens

M = "\\\\"

CLEAN = [
    ("foo,Bar", f"foo {M} Bar"),
    ("foo. Bar", "foo Bar"),
    ("- C# และJava x", " C# และ Java x"),
    ("ขายB", "ขายB"),
    ("JavaScript dev", f"Java {M} Script dev"),
    ("mail a.b@c.com or www.site.com/x now", "mail or now"),
    ("R&amp;D team", "R D team"),
    ("https://abc.com/q?x=1 end", " end"),
    ("http://abc.com", "httpabc com"),
    ("คุณสมชาย ใจดี", " ใจดี"),
    ("12)", ""),
    ("12", ""),
    ("## head", " head"),
    ("a\tb\n c", "a b c"),
    ("กๆข", "ก ข"),
    ("", ""),
    ("๕ ab", "๕ ab"),
]


def test_clean_golden(column):
    got = column([a for a, _ in CLEAN], C.clean)
    # A bare bullet leaves the blanks around its removed marker.
    want = [b if a not in ("12)", "12") else " " for a, b in CLEAN]
    assert got == want


def test_sentence_profile_keeps_stops(column):
    options = C.CleanOptions(profile="sentence")
    got = column(["foo. Bar", "a.1) b", "x", "7)."], lambda c: C.clean(c, options))
    assert got == [f"foo {M} Bar", f"a {M} b", "x", f" {M} "]


def test_switches(column):
    on = C.CleanOptions(thai_digits=True, phones=True, lower_keywords=("SQL",))
    assert column(["๕ SQL 081-234567"], lambda c: C.clean(c, on)) == [" 5 sql "]
    assert column(["๕ SQL 081-234567"], C.clean) == ["๕ SQL 081-234567"]
    with pytest.raises(ValueError):
        C.CleanOptions(profile="other")


def test_repeated_markers_take_the_text_between(column):
    assert column([f"x{M}ab{M}y"], C.clean) == ["x y"]
    assert column([f"x{M}abc{M}y"], C.clean) == ["xabcy"]


def test_boundaries_equal_the_pairwise_rule(column):
    rng = random.Random(5)
    alphabet = "กขคab1 .😀\n"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(4000)]

    def thai(c):
        return "฀" <= c <= "๿"

    def spaced(t):
        cuts = {i + 1 for i in range(len(t) - 2) if thai(t[i]) != thai(t[i + 1])}
        return "".join((" " if i in cuts else "") + c for i, c in enumerate(t))

    assert column(texts, C.space_thai_boundaries) == [spaced(t) for t in texts]


def test_whitespace_is_unicode(column):
    every = [c for c in map(chr, range(0x3100)) if c.isspace()]
    assert column([f"a{c}b" for c in every], C.squeeze_whitespace) == ["a b"] * len(every)
    assert len(every) == 29


def test_illegal_characters_match_the_set(column):
    chars = [chr(c) for c in range(1, 0x3000)] + ["😀"]
    got = column(chars, C.drop_illegal)
    assert [g != "" for g in got] == [c in C.LEGAL for c in chars]


def test_emails_equal_the_plain_pattern(column):
    import re

    rng = random.Random(6)
    texts = ["".join(rng.choices("ab.@ -", k=rng.randint(0, 14))) for _ in range(3000)]
    plain = re.compile(r"[a-zA-Z._\-0-9]+@[a-zA-Z._\-0-9]+")
    assert column(texts, C.blank_emails) == [plain.sub(" ", t) for t in texts]


def test_tokenize_golden(column):
    two = T.TokenOptions(ngram=2)
    assert column(["JavaScript dev"], lambda c: T.tokenize(c, two)) == [
        ["java", M, "script", "dev", "script dev"]
    ]
    stops = T.TokenOptions(ngram=2, stop_en=("the",))
    assert column(["The dev", "the dev"], lambda c: T.tokenize(c, stops)) == [
        ["the", "dev", "the dev"],
        ["dev"],
    ]
    assert column(["a b"], lambda c: T.tokenize(c, T.TokenOptions(ngram=1))) == [["a", "b"]]


def test_thai_sentences_join_without_space(column):
    got = column(["งาน ขาย ab", "one two"], lambda c: T.tokenize(c, T.TokenOptions(ngram=3)))
    assert got[0] == ["งาน", "ขาย", "ab", "งานขาย", "ขายab", "งานขายab"]
    assert got[1] == ["one", "two", "one two"]


def test_adjacent_markers_share_a_pipe(spark):
    df = spark.createDataFrame([(["a", M, M, "b"],), ([M, "a"],)], "t array<string>")
    rows = [r.x for r in df.select(T.sentences(F.col("t")).alias("x")).collect()]
    assert rows == [["a", f"{M}|b"], [f"{M}|a"]]


def test_ngram_count(column):
    texts = [" ".join("x" * (i + 1) for i in range(n)) for n in range(0, 9)]
    got = column(texts, lambda c: T.tokenize(c, T.TokenOptions(ngram=4)))
    for n, toks in enumerate(got):
        assert len(toks) == n + sum(max(n - k + 1, 0) for k in (2, 3, 4))


def test_term_counts(spark):
    from collections import Counter

    rng = random.Random(1)
    rows = [(["".join(rng.choices("abc", k=2)) for _ in range(rng.randint(0, 30))],) for _ in range(50)]
    df = spark.createDataFrame(rows, "t array<string>")
    got = [r.x for r in df.select(T.term_counts(F.col("t")).alias("x")).collect()]
    for (toks,), counts in zip(rows, got):
        assert {c.term: c.tf for c in counts} == dict(Counter(toks or [""]))


def test_lemmas(column):
    table = {"zebras": "zebra", "jobs": "job", "apps": "app"}
    options = T.TokenOptions(ngram=1, lemmas=table, keywords=("apps",))
    assert column(["zebras Jobs apps"], lambda c: T.tokenize(c, options)) == [
        ["zebras", "job", "apps"]
    ]
    full = T.TokenOptions(ngram=1, lemmas=table, lemma_skips_z=False)
    assert column(["zebras"], lambda c: T.tokenize(c, full)) == [["zebra"]]
    many = table | {"no" + "abcdefghij"[i % 10] * (i // 10 + 1): "x" for i in range(T.LITERAL_LEMMAS)}
    for skip_z in (True, False):
        few = T.TokenOptions(ngram=2, lemmas=table, keywords=("apps",), lemma_skips_z=skip_z)
        long = T.TokenOptions(ngram=2, lemmas=many, keywords=("apps",), lemma_skips_z=skip_z)
        texts = ["zebras Jobs apps", "", "noa jobs2"]
        got = column(texts[:2], lambda c: T.tokenize(c, long))  # noqa: B023
        assert got == column(texts[:2], lambda c: T.tokenize(c, few))  # noqa: B023
    assert column(["noa jobs2"], lambda c: T.words(c, long)) == [["x", "jobs2"]]


def test_segmenters_agree(column):
    words = ["กข", "กขค", "ง"]
    cut = T.TokenOptions(ngram=1, segmenter=dictionary_segmenter(words), stop_th=("ง",))
    assert column(["กขคกขงจ abc"], lambda c: T.words(c, cut)) == [["กขค", "กข", "จ", "abc"]]
    by_function = lambda c: segment_tokens(T.words(c), longest_match(words))
    assert column(["กขคกขงจ abc"], by_function) == [["กขค", "กข", "ง", "จ", "abc"]]
    tagged = lambda c: segment_tokens(T.words(c), lambda t: [f"{t[0]}<u/>|{t[1:]}<s/>"])
    assert column(["กข ab"], tagged) == [["ก", "ข", "ab"]]


def test_long_word_lists(column):
    rng = random.Random(4)
    words = {"".join(rng.choice("กขคงจฉชซ") for _ in range(rng.randint(1, 6))) for _ in range(3000)}
    texts = ["".join(rng.choice("กขคงจฉชซญ") for _ in range(30)) for _ in range(40)]
    cut = T.TokenOptions(ngram=1, segmenter=dictionary_segmenter(words))
    assert column(texts, lambda c: T.words(c, cut)) == [longest_match(words)(t) for t in texts]


def test_python_tokenizer_in_the_whole_chain(column):
    words = ["กข", "กขค", "ง"]
    a = T.TokenOptions(ngram=3, segmenter=dictionary_segmenter(words), stop_th=("จ",))
    b = T.TokenOptions(ngram=3, th_tokenizer=longest_match(words), stop_th=("จ",))
    texts = ["กขคกขงจ abcDef กข", "", "plain words", "ง"]
    assert column(texts, lambda c: T.tokenize(c, a)) == column(texts, lambda c: T.tokenize(c, b))


def test_legacy_tokens(column):
    options = T.TokenOptions(ngram=2, stop_th=("xx",), segmenter=dictionary_segmenter(["งาน", "ขาย"]))
    got = column(["1) งานขาย DevOps. axxb"], lambda c: T.legacy_tokens(c, options))
    assert set(got[0]) - {""} == {"งาน", "ขาย", "งานขาย", "dev", "ops", ".", "a", "b"}


def test_token_text_round_trip(column):
    assert column(["a|b c|", ""], T.split_token_text) == [["a", "b c", ""], [""]]


def test_ngrams_grow_from_shorter_ones(column):
    from doctag.functions import tokens as T

    def want(words, n, sep):
        return [sep.join(words[i : i + k]) for k in range(2, n + 1) for i in range(len(words) - k + 1)]

    texts = ["", "a", "a b", "a b c d e f g h i j k l", "ก b ข d"]
    for n in (2, 3, 10):
        got = column(texts, lambda t: T.sentence_ngrams(F.replace(t, F.lit(" "), F.lit("|")), n))
        assert got == [want(t.split(), n, "" if "ก" in t else " ") for t in texts]
    # Each n-gram takes one token more; none is joined anew from a slice of its own.
    plan = str(T.sentence_ngrams(F.col("t"), 5))
    assert "array_join" not in plan and column([None], lambda t: T.tokenize(t)) == [None]


def test_faster_patterns_match_what_the_plain_ones_do(spark):
    rows = ["aB cD", "xYz", "ıA", "a​B", "a  b \t　ๆ c\x1cd", " \n", "คุณ กข ค", "กa ขb", "a", "", "é[^]\\-|~\x7f\xffĀ\U0001f600", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    t = F.col("t")
    pairs = [
        (C.split_merged_words(t), F.regexp_replace(t, "([a-z])([A-Z])", "$1 \\\\\\\\ $2")),
        (C.drop_illegal(t), F.regexp_replace(t, r"[^ #+\-.0-9@A-Za-z\x{0E01}-\x{0E3A}\x{0E3F}-\x{0E5D}]+", "")),
        (C.drop_illegal(t, frozenset("a^]éĀ")), F.regexp_replace(t, "[^a\\^\\]éĀ]+", "")),
    ]
    for got, want in pairs:
        assert df.filter(~got.eqNullSafe(want)).isEmpty()
    # The code points of one table are listed one by one, and no text without Thai letters is searched twice.
    assert r"\x22" in C.illegal_class(C.LEGAL) and r"\x{21}" not in C.illegal_class(C.LEGAL)
