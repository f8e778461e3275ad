"""Stored stages and their release."""

from pathlib import Path

import pytest
from doctag import session


def folder(df):
    return Path(df.inputFiles()[0].removeprefix("file://")).parent


def test_stages_are_released(spark, tmp_path):
    kept = session.durable(spark.range(3))
    with session.stages_released(spark):
        first = session.durable(spark.range(5))
        second = session.durable(first.filter("id > 1"))
        places = [folder(first), folder(second)]
        assert all(p.exists() for p in places)
        second.write.parquet(str(tmp_path / "out"))
    assert not any(p.exists() for p in places)
    assert kept.count() == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_stages_are_released_after_an_error(spark):
    with pytest.raises(RuntimeError):
        with session.stages_released(spark):
            place = folder(session.durable(spark.range(2)))
            raise RuntimeError
    assert not place.exists()
