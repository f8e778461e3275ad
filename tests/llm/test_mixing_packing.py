"""Mixing and packing against plain Python."""

import random
import zlib

import numpy as np
import pytest
from doctag.llm.mixing import mix, mix_plan, source_targets
from doctag.llm.packing import WordIds, first_fit_decreasing, pack, packed_sequences, token_pieces
from pyspark.sql import functions as F

DOC = "doc_id long, text string, source string"


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    """Targets by repeated resharing of what is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(cap * sizes[s] for s in full)
        level = rest / sum(w[s] for s in free) if free else 0
        above = {s for s in free if level * w[s] > cap * sizes[s]}
        if not above:
            return {s: cap * sizes[s] if s in full else level * w[s] for s in names}
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 4000]) for i in range(rng.randint(1, 12))}
    sizes[None] = 30
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(water_fill(sizes))


def test_mix_takes_what_the_plan_says(spark):
    rows = [(i, "a b c " * (i % 7), f"s{i % 3}") for i in range(60)]
    rows += [(None, None, None), (None, "x y", None), (5, "a b c", "s0"), (5, "a b c", "s0")]
    docs = spark.createDataFrame(rows, DOC).withColumn("size", F.lit("mine")).withColumn("copies", F.lit(1))
    plan = mix_plan(docs).collect()
    assert len(plan) == len(rows)
    for r in plan:
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= int(rate) + 1 and r.copies <= 3
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in plan)
    assert sorted(map(str, mix(docs).collect())) == sorted(map(str, mixed.collect()))


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 20).alias("text"), F.when(F.col("id") < 1500, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source")
    )
    got = mix_plan(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n"))
    assert all(abs(r.n - r.t) < 0.15 * r.t + 100 for r in got.collect())


def test_empty_mix_and_pack(spark):
    none = spark.createDataFrame([], DOC)
    assert mix_plan(none).count() == mix(none).count() == pack(token_pieces(none)).count() == 0


def vocabulary():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    text = vocabulary()
    words, whole = WordIds(text), Tokenizer.from_str(text)
    rng = random.Random(1)
    parts = ["a", "B", "é", "é", "'", "'s", "'LL", " ", "\n", "\t", "\x0b", "\xa0", ",", "..", "1", "½", "İ", "Σ", "中", "<|endoftext|>", "<|", "ﬁ", "🙂", "\x00", "É", "ÿ", "ß", "ª", "ñandú", "ç", "K", "\u0301", "."]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(words.of_text(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_signs_at_the_end_are_looked_up_alone():
    """The whole tokenizer is asked for each run of signs once, not for each word before it."""
    from tokenizers import Tokenizer

    text = vocabulary()
    words, whole = WordIds(text), Tokenizer.from_str(text)
    asked, encode = [], words.encode
    words.encode = lambda part, **options: (asked.append(part), encode(part, **options))[1]
    parts = [f"{w}{s}" for w in ("word", "Été", "x", "AND", "naïve") for s in (",%%%", "***", ".", "!?_~", "...")]
    assert [words.of_text(p) for p in parts] == [
        np.array(whole.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in parts
    ]
    assert sorted(asked) == sorted((",%%%", "***", ".", "!?_~", "..."))
    for p in ("a<|endoftext|>", "<|endoftext|>,", "a|>", "it's,", "'s%", "'%s", "é\u0301,", "1,%", "中,", "%%,a,%", "don't!"):
        assert words.of_text(p) == np.array(whole.encode(p, add_special_tokens=False).ids, "<u4").tobytes()


def test_remembered_words_are_bounded(monkeypatch):
    """Words may be forgotten at any time, long ones are never kept, and ids stay right."""
    from doctag.llm import packing

    monkeypatch.setattr(packing, "CACHE_BYTES", 4000)
    words, whole = WordIds(vocabulary()), WordIds(vocabulary())
    rng = random.Random(4)
    for i in range(400):
        text = " ".join(f"{rng.choice(['ab', 'Été', 'x,'])}{rng.randrange(60)}" for _ in range(9)) + " " + "long" * 9 + str(i)
        assert words.of_text(text) == b"".join(whole.of_text(w) for w in text.split(" "))
        assert len(words) + len(words.older) < 60 and not any(len(w) > 32 for w in (*words, *words.older))


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets = first_fit_decreasing(sizes, 100)
        free: list[int] = []
        for i in np.argsort(-sizes, kind="stable"):
            b = next((b for b, room in enumerate(free) if room >= sizes[i]), len(free))
            if b == len(free):
                free.append(100)
            assert (bins[i], offsets[i]) == (b, 100 - free[b])
            free[b] -= sizes[i]


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(vocabulary())
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice(["the", "of", "Word,", "x1", "é."]) for _ in range(rng.randint(0, 90))) for i in range(60)}
    texts |= {100: None, 101: "", None: "no id"}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()] + [(0, texts[0], 1)], "doc_id long, text string, length int")
    packed = pack(token_pieces(docs, sequence=64), sequence=64, group_pieces=40).cache()
    rows = packed.collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, {})[r.start] = bytes(r.ids)
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) >= 0
    for i, t in texts.items():
        ids = np.frombuffer(b"".join(b for _, b in sorted(pieces[i].items())), "<u4").tolist()
        assert ids == whole.encode(t or "", add_special_tokens=False).ids + [1]
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(len(r.ids) // 4 for r in packed_sequences(packed).collect()) == sum(r.length for r in rows)
