"""JSON lists that are read by several tasks."""

import json
import random

import pytest
from doctag.sources import documents as D
from doctag.sources import json_lists as J


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "96")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def records(seed, n):
    rng = random.Random(seed)
    odd = ["}", "{", "[", "]", '"', "\\", "\\\"", "},{", "ก", "😀", "\n", "plain text ", ",", "é"]
    text = lambda k: "".join(rng.choices(odd, k=rng.randrange(k)))
    return [{"title": text(6), "desc": text(60 if rng.random() < 0.2 else 12), "tag": rng.choice(["a", None])} for _ in range(n)]


def rows(df):
    return sorted((r.title, r.desc, str(r.tag)) for r in df.collect())


def wanted(docs):
    return sorted((d["title"], d["desc"], str(d["tag"])) for d in docs)


@pytest.mark.parametrize("indent", [None, 2])
def test_one_file_in_many_splits(spark, tmp_path, small_splits, indent):
    docs = records(1, 150)
    (tmp_path / "a.json").write_text(json.dumps(docs, ensure_ascii=indent is None, indent=indent) + "\n", "utf-8")
    df = D.read_json_array(spark, str(tmp_path / "a.json"))
    assert rows(df) == wanted(docs)
    states = J.split_states(spark, str(tmp_path / "a.json"))
    assert states.count() > 12 and states.filter("open").count() > 5
    assert states.filter("inside = 1").count() > 0


def test_folder_of_files_and_nested_records(spark, tmp_path, small_splits):
    want = []
    for i in range(4):
        docs = records(i + 10, 9 * i)
        want += docs
        # More fields, with braces at any depth, and one record longer than several splits.
        more = [{**d, "more": {"x": [{"y": {"z": "}" * j}}] * 3, "n": 1.5}} for j, d in enumerate(docs)]
        if i == 3:
            long = {"title": "long", "desc": "x}" * 400, "tag": None}
            want.append(long)
            more.insert(7, long)
        (tmp_path / f"a b+{i}.json").write_text(json.dumps(more), "utf-8")
    assert rows(D.read_json_array(spark, str(tmp_path))) == wanted(want)


def test_mark_at_the_start_and_white_space(spark, tmp_path):
    docs = records(5, 4)
    (tmp_path / "a.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(docs).encode())
    (tmp_path / "b.json").write_text(" \n[ ] \n")
    # Files without a byte are not listed by the engine.
    (tmp_path / "d.json").write_text("")
    (tmp_path / "c.json").write_text("\n [ " + " ,\n ".join(map(json.dumps, docs)) + "\n]\n\n")
    assert rows(D.read_json_array(spark, str(tmp_path))) == wanted(docs + docs)


BROKEN = [
    "  ", "{}", '[{"title": "a"', '[{"title": "a"}', '[{"title": "a"}}]', '{"title": "a"}]', '[{"title": "a"}] x',
    '[{"title": "a"}] [{"title": "b"}]', '[{"title": "a"} {"title": "b"}]', '[{"title": "a"},]', "[1]", '["a"]', '[1, {"title": "a"}]',
    '[[{"title": "a"}]]', '[{"title": "a}]', '[{"title": "a"}, null]', '[{"title": "a"}]}', '[{"title": a}]', "null",
]


@pytest.mark.parametrize("text", BROKEN)
def test_broken_files(spark, tmp_path, text):
    (tmp_path / "good.json").write_text('[{"title": "g"}]')
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        D.read_json_array(spark, str(tmp_path), required=["title"]).collect()


def test_every_cut_of_a_file_is_an_error(spark, tmp_path):
    text = json.dumps(records(2, 2))
    for n in range(1, len(text) - 1, 23):
        (tmp_path / "a.json").write_text(text[:n])
        with pytest.raises(Exception):
            D.read_json_array(spark, str(tmp_path / "a.json")).collect()
