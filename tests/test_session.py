"""Scratch folders and settings."""

import pytest
from pyspark.sql import functions as F

from eventmart import session
from eventmart.sources.bronze import replace_by_file


class FakeSession:
    """Only what ``scratch_dir`` asks of a session."""

    def __init__(self, shared, checkpoints=None):
        self.shared = shared
        self.checkpoints = checkpoints
        self.conf = self.sparkContext = self

    def getCheckpointDir(self):
        return self.checkpoints

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.shared or default


def test_scratch_lies_in_the_shared_folder():
    first, second = (session.scratch_dir(FakeSession("hdfs://shared/x/"), "t") for _ in range(2))
    assert first != second
    assert first.startswith("hdfs://shared/x/t-")


def test_scratch_without_a_shared_folder():
    assert session.scratch_dir(FakeSession(None, "hdfs://c/d"), "t").startswith("hdfs://c/d/t-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(FakeSession(None), "t")


def test_settings_reach_a_given_session(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_materialized_rows_are_the_same(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) AS nothing")
    stored = session.materialize(df, "test")
    assert stored.dtypes == df.dtypes
    assert sorted(map(tuple, stored.collect())) == [(n, None) for n in range(5)]
    assert session.materialize(df.limit(0), "test").count() == 0


def test_a_task_of_a_write_by_folder_gets_a_bounded_part_of_a_day(spark, tmp_path):
    """40 MB of one day: a sort of all of it would spill, had its rows shrunk as lines do."""
    noise = F.concat(*(F.sha2(F.concat("id", F.lit(f"-{n}")), 512) for n in range(8)))
    day = spark.range(40_000).select("id", noise.alias("raw_line"), F.lit("d").alias("source_file"))
    replace_by_file(day.hint("rebalance", "source_file"), str(tmp_path))
    assert len(list(tmp_path.glob("source_file=d/*.parquet"))) >= 2
    assert spark.read.parquet(str(tmp_path)).select("id").distinct().count() == 40_000
